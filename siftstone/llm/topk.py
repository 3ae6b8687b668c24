"""Exact top-k search by inner product with a vector-approximation file.

The file holds a cell number of BITS bits for each component: each place's
range is cut into equal cells.  A search scans the cells, never the vectors: a
cell's centre and half width bound a component, so centre products plus and
minus a term of the query alone bound each score.  The kth best lower bound of
a block, and the kth exact score so far, tell which rows can still be among the
best k.  Only those vectors are read, in the order of their bounds, until the
next bound is below the kth exact score; then the result is certain.

Tasks search shards of the file, each with its own kth score, and the best k
of each (query, shard) meet in a window.  A query's result does not depend on
how the rows are dealt.

Defined results: rows with a null id, a null vector, or a null or non-finite
component take no part; a shorter vector ends in zeros; rows that share the
query's id are no candidates for it; repeated rows are candidates (and queries)
one by one; ties go to the smaller id; an empty table gives an empty one;
inner products beyond 53 bits are a ValueError; texts do not occur; extra
columns, of any name, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftstone.llm.runtime import table, tidy, work_dir, written
from siftstone.llm.vectors import BLOCK, HELD, PAIRS, QUERY_BLOCK, Best, compact, grid, matrices, one_row, ranges, rows_of

BITS = 6
#: Vectors that are read at once, in the order of their bounds.
READ = 64


def cell_widths(lo: np.ndarray, hi: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Width of a place's cells: 2**bits of them cover lo to hi."""
    return (hi - lo) // (1 << bits) + 1


def approximations(rows: DataFrame, lo: np.ndarray, hi: np.ndarray, bits: int = BITS) -> DataFrame:
    """A row for each block: part, at, n, ids, cells (a byte each) and exact components."""
    width, kind = cell_widths(lo, hi, bits), compact(lo, hi)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for at, (ids, x, _) in enumerate(matrices(batches, len(lo), BLOCK)):
            cells = ((x - lo) // width).astype(np.uint8)
            yield one_row(part=part, at=at, n=len(ids), ids=ids.tobytes(), cells=cells.tobytes(), exact=x.astype(kind).tobytes())

    return rows.mapInArrow(tidy(work), "part int, at int, n int, ids binary, cells binary, exact binary")


def query_blocks(queries: DataFrame, lo: np.ndarray, hi: np.ndarray) -> DataFrame:
    """A row for each block of queries: qpart, qat, qids, qexact."""
    kind = compact(lo, hi)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for at, (ids, x, _) in enumerate(matrices(batches, len(lo), QUERY_BLOCK)):
            yield one_row(qpart=part, qat=at, qids=ids.tobytes(), qexact=x.astype(kind).tobytes())

    return queries.mapInArrow(tidy(work), "qpart int, qat int, qids binary, qexact binary")


def search_block(queries: np.ndarray, qids: np.ndarray, ids: np.ndarray, cells: np.ndarray, exact: np.ndarray, lo: np.ndarray, width: np.ndarray, best: Best) -> int:
    """Offers a block's rows to the queries' best lists; how many vectors were read."""
    half = (width - 1) / 2
    centres = lo + half + cells * width
    about = queries.astype(np.float64) @ centres.T
    slack = np.abs(queries) @ half
    order = np.argsort(ids, kind="stable")
    left, right = (np.searchsorted(ids[order], qids, side) for side in ("left", "right"))
    for q in np.flatnonzero(left < right):
        about[q, order[left[q] : right[q]]] = -np.inf
    least, k = best.least(), best.k
    fresh = np.flatnonzero(np.isneginf(least))
    if len(fresh) and len(ids) >= k:  # the kth best lower bound
        least[fresh] = np.partition(about[fresh], len(ids) - k, axis=1)[:, len(ids) - k] - slack[fresh]
    bound = least - slack
    q_at, at = np.nonzero((about >= bound[:, None]) & np.isfinite(about))
    edge = np.flatnonzero(np.diff(q_at, prepend=-1))
    read = 0
    for a, b in zip(edge, np.append(edge[1:], len(q_at))):
        q, some = q_at[a], at[a:b]
        some = some[np.lexsort((ids[some], -about[q, some]))]
        for i in range(0, len(some), READ):
            chunk = some[i : i + READ]
            kth = best.scores[q, -1] if best.count[q] == k else -np.inf
            if about[q, chunk[0]] + slack[q] < kth:
                break
            read += len(chunk)
            best.add(np.full(len(chunk), q), exact[chunk].astype(np.int64) @ queries[q], ids[chunk])
    return read


def top_k(df: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding", bits: int = BITS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of queries the k rows of df with the highest integer inner product."""
    spark = df.sparkSession
    path, rows = work_dir(spark, "topk"), rows_of(df, vec_id, vector)
    asked = rows_of(queries, vec_id, vector)
    lo, hi = ranges(rows.unionAll(asked))
    width, kind, dim = cell_widths(lo, hi, bits), compact(lo, hi), len(lo)
    file = written(approximations(rows, lo, hi, bits), f"{path}/file")
    blocks = written(query_blocks(asked, lo, hi), f"{path}/queries")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, Best]] = {}

        def out(key: tuple[int, int]) -> pa.RecordBatch:
            qids, _, best = held.pop(key)
            at, scores, ids = best.rows()
            n = len(at)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, key[0], np.int32)), pa.array(np.full(n, key[1], np.int32)), pa.array(at.astype(np.int32)), pa.array(qids[at]), pa.array(ids), pa.array(scores)], ["qpart", "qat", "place", "query_id", "vec_id", "score"])

        for batch in batches:
            for r in batch.to_pylist():
                key = (r["qpart"], r["qat"])
                if key not in held:
                    qids = np.frombuffer(r["qids"], np.int64)
                    held[key] = qids, np.frombuffer(r["qexact"], kind).reshape(len(qids), dim).astype(np.int64), Best(len(qids), k)
                held[key] = held.pop(key)
                qids, queries, best = held[key]
                ids, cells, exact = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["cells"], np.uint8).reshape(r["n"], dim), np.frombuffer(r["exact"], kind).reshape(r["n"], dim)
                search_block(queries, qids, ids, cells, exact, lo, width, best)
                if len(held) > HELD:  # the one that was used longest ago; what it finds later is merged below
                    yield out(next(iter(held)))
        for key in list(held):
            yield out(key)

    pairs = grid(file, blocks, file.count())
    found = written(pairs.mapInArrow(tidy(search), "qpart int, qat int, place int, query_id long, vec_id long, score long"), f"{path}/found", rows=PAIRS)
    rank = F.row_number().over(Window.partitionBy("qpart", "qat", "place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_vector_file_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.filter("vec_id % 50 = 0"), 5)


OP11_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
