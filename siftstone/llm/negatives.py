"""Hard negatives: rows of another label whose score with an anchor lies just below that of a positive.

Vectors are turned by an orthogonal matrix of principal components (of the
second moments about the origin, summed over all rows), so that the leading
components carry most of an inner product.  A block of anchors meets a block of
rows: products of the leading components are accumulated group by group, and
what is left is at most the product of the two residual norms, plus a slack for
rounding.  Pairs whose bound shows that they cannot count are discarded before
the next group; survivors are verified with integer products of the untouched
components, and only those decide.

Two passes: first the positives of each anchor (rows of its label), then for
each positive the rows within the window that its score opens.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; a shorter vector ends in zeros; rows that share the
anchor's id are neither its positives nor its negatives; repeated rows count
one by one; ties go to the smaller id; a negative positive score opens no
window, a score of zero that of zero; an empty table gives an empty one; inner
products beyond 53 bits are a ValueError; texts do not occur; extra columns, of
any name, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftstone.llm.runtime import table, tidy, work_dir, written
from siftstone.llm.vectors import BLOCK, HELD, PAIRS, QUERY_BLOCK, Best, compact, grid, matrices, one_row, ranges, usable

#: Shares of the components after which bounds are taken, and of pairs below which the rest goes on pair by pair.
CUTS, SPARSE = (0.125, 0.25, 0.5, 1.0), 0.1
#: Pairs that are verified at once.
VERIFY = 1 << 16


def second_moments(rows: DataFrame, dim: int) -> np.ndarray:
    """Sums of x_i * x_j over all rows; the driver gets dim * (dim + 1) / 2 numbers."""
    i, j = np.triu_indices(dim)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for _, x, _ in matrices(batches, dim, BLOCK):
            total += x.T.astype(np.float64) @ x
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "s"])

    out = np.zeros((dim, dim))
    for r in rows.mapInArrow(tidy(work), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"]
    return out


def rotation(moments: np.ndarray) -> np.ndarray:
    """Orthogonal columns, those of the largest share first."""
    _, vectors = np.linalg.eigh(moments) if len(moments) else (None, np.zeros((0, 0)))
    return vectors[:, ::-1]


@dataclass
class Turned:
    """Rows after the rotation: components, the norm of what follows each cut, whole norms."""

    x: np.ndarray  # float32
    rest: np.ndarray  # float32, a column for each cut
    norm: np.ndarray  # float32

    @classmethod
    def of(cls, exact: np.ndarray, turn: np.ndarray) -> Turned:
        y = exact.astype(np.float64) @ turn
        up = lambda v: np.nextafter((v * (1 + 1e-9)).astype(np.float32), np.float32(np.inf))
        tail = np.sqrt(np.cumsum((y * y)[:, ::-1], axis=1))[:, ::-1]
        rest = np.stack([tail[:, c] if c < y.shape[1] else np.zeros(len(y)) for c in cuts(y.shape[1])], axis=1)
        return cls(y.astype(np.float32), up(rest), up(np.sqrt((y * y).sum(1))))


def cuts(dim: int) -> list[int]:
    return [max(1, round(dim * c)) for c in CUTS]


def survivors(a: Turned, v: Turned, low: np.ndarray, high: np.ndarray, allowed: np.ndarray | None = None, k: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the pairs whose score may lie in low[i] to high[i].

    k: of the pairs of a row that are still there at the end, the kth best lower bound raises low.
    """
    dim = a.x.shape[1]
    # Sums of dim float32 products and the rounding of the components: each at most a few units in the last place of |a| |v|.
    unit = np.float32(np.sqrt((2 * dim + 16) * 2.0**-23))
    low, high, ends = low.astype(np.float32), high.astype(np.float32), cuts(dim)
    low, high = np.nextafter(low, np.float32(-np.inf)), np.nextafter(high, np.float32(np.inf))
    part, i, j, begin = np.zeros((len(a.x), len(v.x)), np.float32), None, None, 0
    for c, end in enumerate(ends):
        if i is None:
            part += a.x[:, begin:end] @ v.x[:, begin:end].T
            margin = np.stack([a.rest[:, c], unit * a.norm], 1) @ np.stack([v.rest[:, c], unit * v.norm], 1).T
            if c == len(ends) - 1 and 0 < k <= part.shape[1]:
                under = part - margin if allowed is None else np.where(allowed, part - margin, -np.inf)
                low = np.maximum(low, np.partition(under, part.shape[1] - k, axis=1)[:, part.shape[1] - k])
            keep = (part + margin >= low[:, None]) & (part - margin <= high[:, None])
            if allowed is not None:
                keep &= allowed
            if c == len(ends) - 1 or np.count_nonzero(keep) < SPARSE * keep.size:
                i, j = np.nonzero(keep)
                part = part[i, j]
        else:
            part = part + np.einsum("ij,ij->i", a.x[i, begin:end], v.x[j, begin:end])
            margin = a.rest[i, c] * v.rest[j, c] + unit * unit * a.norm[i] * v.norm[j]
            keep = (part + margin >= low[i]) & (part - margin <= high[i])
            i, j, part = i[keep], j[keep], part[keep]
        begin = end
    return i, j


def verified(a: np.ndarray, v: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), VERIFY):
        s = slice(at, at + VERIFY)
        out[s] = np.einsum("ij,ij->i", a[i[s]], v[j[s]])
    return out


_ROWS = "part int, at int, n int, ids binary, labels binary, exact binary"


def _blocks(rows: DataFrame, dim: int, kind: np.dtype) -> DataFrame:
    """Blocks of (id, vec, label)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for at, (ids, x, b) in enumerate(matrices(batches, dim, BLOCK)):
            labels = b.column(2).to_numpy()
            order = np.argsort(labels, kind="stable")
            yield one_row(part=part, at=at, n=len(ids), ids=ids[order].tobytes(), labels=labels[order].tobytes(), exact=x[order].astype(kind).tobytes())

    return rows.mapInArrow(tidy(work), _ROWS)


_ANCHORS = "qpart int, qat int, keys binary, qids binary, qlabels binary, qexact binary, pids binary, pscores binary"


def _anchor_blocks(anchors: DataFrame, dim: int, kind: np.dtype, positives: int) -> DataFrame:
    """Blocks of (id, vec, label, key, pids, pscores); fewer positives than asked for are filled up with -1."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for at, (ids, x, b) in enumerate(matrices(batches, dim, QUERY_BLOCK)):
            filled = []
            for c in (4, 5):
                lengths = b.column(c).value_lengths().to_numpy()
                m = np.full((len(ids), positives), -1, np.int64)
                m[np.arange(positives) < lengths[:, None]] = b.column(c).flatten().to_numpy()
                filled.append(m.tobytes())
            keys, labels = (b.column(c).to_numpy().tobytes() for c in (3, 2))
            yield one_row(qpart=part, qat=at, keys=keys, qids=ids.tobytes(), qlabels=labels, qexact=x.astype(kind).tobytes(), pids=filled[0], pscores=filled[1])

    return anchors.mapInArrow(tidy(work), _ANCHORS)


@dataclass
class Group:
    """Anchors of one block and what a task has found for them."""

    keys: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    exact: np.ndarray
    turned: Turned
    pids: np.ndarray
    pscores: np.ndarray
    low: np.ndarray
    high: np.ndarray
    best: Best


def windows(pscores: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores s with least * p <= 100 * s <= most * p, as first and last; none for p < 0."""
    low, high = -((-least * pscores) // 100), (most * pscores) // 100
    return np.where(pscores >= 0, low, 1), np.where(pscores >= 0, high, 0)


def _offer_positives(g: Group, ids: np.ndarray, labels: np.ndarray, exact: np.ndarray, turned: Turned) -> None:
    for label in np.unique(g.labels):
        mine, first, last = np.flatnonzero(g.labels == label), *np.searchsorted(labels, [label, label + 1])
        if first == last:
            continue
        a, v = (Turned(t.x[s], t.rest[s], t.norm[s]) for t, s in ((g.turned, mine), (turned, slice(first, last))))
        others = g.ids[mine][:, None] != ids[first:last][None, :]
        least = g.best.least()[mine]
        i, j = survivors(a, v, least, np.full(len(mine), np.inf), others, g.best.k if np.isneginf(least).any() else 0)
        i, j = mine[i], first + j
        g.best.add(i, verified(g.exact, exact, i, j), ids[j])


def _offer_negatives(g: Group, ids: np.ndarray, labels: np.ndarray, exact: np.ndarray, turned: Turned) -> None:
    kth = g.best.least().reshape(g.low.shape)
    open_ = g.low <= g.high
    low = np.where(open_, np.maximum(kth, g.low), np.inf).min(1)
    high = np.where(open_, g.high, -np.inf).max(1)
    i, j = survivors(g.turned, turned, low, high)
    other = (g.labels[i] != labels[j]) & (g.ids[i] != ids[j])
    i, j = i[other], j[other]
    scores = verified(g.exact, exact, i, j)
    for p in range(g.low.shape[1]):
        fits = (scores >= np.maximum(kth[i, p], g.low[i, p])) & (scores <= g.high[i, p])
        g.best.add(i[fits] * g.low.shape[1] + p, scores[fits], ids[j[fits]])


def _search(pairs: DataFrame, turn: np.ndarray, kind: np.dtype, positives: int, k: int, offer, window: tuple[int, int]) -> DataFrame:
    """(key, place, anchor_id, positive_id, positive_score, vec_id, score): the k best of each anchor, or of each of its windows, by task."""
    dim = len(turn)
    # Without windows (offer is that of the positives) an anchor has one list.
    lists = positives if offer is _offer_negatives else 1

    def group(r: dict) -> Group:
        keys, ids, labels = np.frombuffer(r["keys"], np.int64), np.frombuffer(r["qids"], np.int64), np.frombuffer(r["qlabels"], np.int64)
        exact = np.frombuffer(r["qexact"], kind).reshape(len(ids), dim).astype(np.int64)
        pids, pscores = (np.frombuffer(r[c], np.int64).reshape(len(ids), positives) for c in ("pids", "pscores"))
        return Group(keys, ids, labels, exact, Turned.of(exact, turn), pids, pscores, *windows(pscores, *window), Best(len(ids) * lists, k))

    def out(g: Group) -> pa.RecordBatch:
        at, scores, ids = g.best.rows()
        anchor, place = at // lists, at % lists
        columns = (g.keys[anchor], place, g.ids[anchor], g.pids[anchor, place], g.pscores[anchor, place], ids, scores)
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["key", "place", "anchor_id", "positive_id", "positive_score", "vec_id", "score"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], Group] = {}
        last: tuple[bytes, tuple] | None = None
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["qpart"], r["qat"])
                g = held[key] = held.pop(key, None) or group(r)
                if last is None or last[0] != r["ids"]:  # blocks come several times in a row
                    exact = np.frombuffer(r["exact"], kind).reshape(r["n"], dim).astype(np.int64)
                    last = r["ids"], (np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64), exact, Turned.of(exact, turn))
                offer(g, *last[1])
                if len(held) > HELD:
                    yield out(held.pop(next(iter(held))))
        for g in held.values():
            yield out(g)

    return pairs.mapInArrow(tidy(work), "key long, place long, anchor_id long, positive_id long, positive_score long, vec_id long, score long")


def hard_negatives(
    df: DataFrame, anchor: Column, label: Column, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90), vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    anchor: which rows of df are anchors; label: their class (an integer);
    window: the least and most percent of the positive's score that a negative may have.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, "negatives")
    kept = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec"))
    columns = (F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = df.select(*columns).filter(kept)
    lo, hi = ranges(rows.select("id", "vec"))
    dim, kind = len(lo), compact(lo, hi)
    turn = rotation(second_moments(rows.select("id", "vec"), dim))
    data = written(_blocks(rows.select("id", "vec", "label"), dim, kind), f"{path}/rows")
    anchors = written(rows.filter("anchor").select("id", "vec", "label", F.monotonically_increasing_id().alias("key")), f"{path}/anchors")
    blocks, none = data.count(), F.array().cast("array<bigint>")

    def searched(asked: DataFrame, k: int, offer, name: str) -> DataFrame:
        asked = written(_anchor_blocks(asked.select("id", "vec", "label", "key", "pids", "pscores"), dim, kind, positives), f"{path}/{name}-anchors")
        found = written(_search(grid(data, asked, blocks), turn, kind, positives, k, offer, window), f"{path}/{name}", rows=PAIRS)
        rank = F.row_number().over(Window.partitionBy("key", "place").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).filter(F.col("rank") <= k)

    best = searched(anchors.withColumns({"pids": none, "pscores": none}), positives, _offer_positives, "positives")
    lists = best.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))
    asked = anchors.join(lists.hint("merge"), "key").withColumns({"pids": F.col("p.vec_id"), "pscores": F.col("p.score")})
    found = searched(asked, negatives, _offer_negatives, "negatives")
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 100 = 0"), label)


OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
 WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
 FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
