"""Vectors as integer matrices in blocks, grids of blocks, and running best lists; shared by the searches.

A search holds a stated set of query rows against all rows.  Both are kept as
blocks, a table row for each, and each query block is sent to each *shard* of
the data blocks by an equality join on the shard's number.  So a task holds two
blocks and the best lists of a bounded number of query blocks, and nothing of
the tables passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a data block and of a query block.
BLOCK, QUERY_BLOCK = 2048, 1024
#: Pairs of blocks that go to Python at once, and query blocks whose best lists a task holds.
PAIRS, HELD = 16, 64


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def rows_of(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id long, vec array<double>) of the rows with an id and a usable vector."""
    vec = F.col(vector).cast("array<double>")
    return df.filter(F.col(vec_id).isNotNull() & usable(vec)).select(F.col(vec_id).cast("long").alias("id"), vec.alias("vec"))


def matrices(batches: Iterator[pa.RecordBatch], dim: int, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """(ids, floor(256 * x) as int64 rows of dim components, the batch's slice); shorter vectors end in zeros."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            b = batch.slice(at, rows)
            lengths = b.column(1).value_lengths().to_numpy()
            flat = np.floor(b.column(1).flatten().to_numpy(zero_copy_only=False) * 256)
            flat = np.clip(flat, -(2.0**62), 2.0**62).astype(np.int64)  # what is cut here is too large for any score
            x = np.zeros((b.num_rows, dim), np.int64)
            x[np.arange(dim) < lengths[:, None]] = flat
            yield b.column(0).to_numpy(), x, b


def one_row(**values: int | bytes) -> pa.RecordBatch:
    """A batch of one row of int and binary columns."""
    return pa.RecordBatch.from_arrays([pa.array([v], pa.int32() if isinstance(v, int) else pa.binary()) for v in values.values()], list(values))


def ranges(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest floor(256 * x) by place; as many as the longest vector has components."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dim = int(b.column(1).value_lengths().to_numpy().max()) if b.num_rows else 0
            for _, x, _ in matrices([b], dim, b.num_rows) if dim else ():
                yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(x.min(0)), pa.array(x.max(0))], ["place", "lo", "hi"])

    found = rows.mapInArrow(work, "place int, lo long, hi long").groupBy("place").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("place").collect()
    lo, hi = (np.array([r[c] for r in found], np.int64) for c in ("lo", "hi"))
    most = float(max(np.abs(lo).max(initial=0), np.abs(hi).max(initial=0)))
    if most * most * max(1, len(lo)) >= 2.0**53:
        raise ValueError("inner products of these vectors do not fit 53 bits")
    return lo, hi


def compact(lo: np.ndarray, hi: np.ndarray) -> np.dtype:
    """The smallest signed integers that hold lo to hi."""
    least, most = int(min(lo.min(initial=0), 0)), int(max(hi.max(initial=0), 0))
    return next(np.dtype(t) for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= least and most <= np.iinfo(t).max)


def grid(data: DataFrame, queries: DataFrame, blocks: int) -> DataFrame:
    """Each row of queries beside each row of data, dealt by shards of data; blocks: the rows of data.

    data has columns part and at, the task that made a block and the block's number in it.
    Blocks are shuffled, never broadcast: files of few bytes hold more, and each shard gets a copy of the queries.
    The copies take no more rows than data has, but there is a shard for each core.
    """
    spark = data.sparkSession
    copies = blocks * BLOCK // (max(1, queries.count()) * QUERY_BLOCK)
    shards = max(1, min(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")), max(copies, spark.sparkContext.defaultParallelism)))
    ours = data.withColumn("shard", F.pmod(F.col("part") * 31 + F.col("at"), F.lit(shards)).cast("int")).drop("part", "at")
    return ours.join(queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).hint("merge"), "shard")


class Best:
    """The k best (score descending, id ascending) of each of n lists."""

    def __init__(self, n: int, k: int):
        self.k, self.scores, self.ids = k, np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.count = np.zeros(n, np.int64)

    def least(self) -> np.ndarray:
        """The kth score of each list, -inf while it has fewer."""
        return np.where(self.count == self.k, self.scores[:, -1].astype(np.float64), -np.inf)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offer (list, score, id) triples."""
        if not len(at):
            return
        lists = np.unique(at)
        old, place = np.nonzero(np.arange(self.k) < self.count[lists][:, None])
        old = lists[old]
        at, scores, ids = np.concatenate([old, at]), np.concatenate([self.scores[old, place], scores]), np.concatenate([self.ids[old, place], ids])
        order = np.lexsort((ids, -scores, at))
        at, scores, ids = at[order], scores[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        keep = rank < self.k
        self.scores[at[keep], rank[keep]], self.ids[at[keep], rank[keep]] = scores[keep], ids[keep]
        self.count[lists] = np.minimum(np.diff(np.append(first, len(at))), self.k)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, score, id) of all that is held."""
        at, place = np.nonzero(np.arange(self.k) < self.count[:, None])
        return at, self.scores[at, place], self.ids[at, place]
