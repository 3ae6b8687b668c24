"""Exact top-k and hard negatives against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftstone.llm import negatives, topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, part int, score string"


def usable(rows):
    return [(i, [math.floor(256 * x) for x in v], y) for i, v, y, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))  # the shorter ends in zeros


def brute_top(rows, k, step):
    out = []
    for i, v, _ in usable(rows):
        if i % step == 0:
            found = sorted((-dot(v, w), j) for j, w, _ in usable(rows) if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(found, 1)]
    return sorted(out)


def brute_negatives(rows, step, positives=5, most=10):
    out, rows = [], [r for r in usable(rows) if r[2] is not None]
    for i, v, y in rows:
        if i % step:
            continue
        scored = sorted((-dot(v, w), j, z) for j, w, z in rows if j != i)
        for s, p, _ in [x for x in scored if x[2] == y][:positives]:
            fits = [x for x in scored if x[2] != y and 30 * -s <= 100 * -x[0] <= 90 * -s][:most]
            out += [(i, p, r, n, -s, -t) for r, (t, n, _) in enumerate(fits, 1)]
    return sorted(out)


def hard_rows(seed, n, dim=12, spread=1.0):
    """Clusters, copies, ties, repeated rows, nulls, infinities and short vectors."""
    r = random.Random(seed)
    centres = [[r.gauss(0, spread) for _ in range(dim)] for _ in range(4)]
    rows = []
    for i in range(n):
        v = [float(np.float32(c + r.gauss(0, 0.3))) for c in centres[i % 4]]
        if i % 9 == 4:
            v = list(map(float, np.float32(centres[0])))
        if i % 31 == 7:
            v = v[: r.randrange(dim)]
        if i % 37 == 5:
            v[0:1] = [r.choice([None, float("nan"), float("inf"), -float("inf")])]
        rows.append((None if i % 53 == 8 else i, None if i % 41 == 3 else v, None if i % 29 == 6 else r.randrange(3), 1, "x"))
    return rows + rows[40:60]


@pytest.mark.parametrize("bits", [1, 4, 6])
def test_top_k(spark, bits, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)  # ships with the closure: the tasks run on this machine
    rows = hard_rows(1, 260)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for k in (1, 5, 400):
        found = topk.top_k(df, df.filter("vec_id % 20 = 0"), k, bits=bits)
        assert sorted(map(tuple, found.collect())) == brute_top(rows, k, 20)


def test_empty_and_overflow(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, empty, 5).collect() == []
    assert negatives.hard_negatives(empty, F.expr("vec_id % 2 = 0"), F.col("label")).collect() == []
    none = spark.createDataFrame([(1, None, 1, 1, ""), (2, [float("nan")], 1, 1, ""), (3, [], 1, 1, "")], SCHEMA)
    assert [tuple(r) for r in topk.top_k(none, none, 5).collect()] == []
    huge = spark.createDataFrame([(1, [1e18], 1, 1, ""), (2, [1e18], 1, 1, "")], SCHEMA)
    with pytest.raises(ValueError, match="53 bits"):
        topk.top_k(huge, huge, 5)


def test_reads_few_vectors():
    """Cells rule out most rows, and the order of bounds lets the search stop."""
    r = np.random.default_rng(3)
    x = np.floor(r.normal(size=(4000, 24)) * 60).astype(np.int64)
    lo, hi = x.min(0), x.max(0)
    width, ids, best = topk.cell_widths(lo, hi), np.arange(4000), vectors.Best(20, 5)
    read = topk.search_block(x[:20], ids[:20], ids, ((x - lo) // width).astype(np.uint8), x, lo, width, best)
    assert read < 0.1 * 20 * 4000
    for q in range(20):
        scores = x @ x[q]
        expected = sorted((-scores[j], j) for j in range(4000) if j != q)[:5]
        assert list(zip(-best.scores[q], best.ids[q])) == expected


@pytest.mark.parametrize("seed,spread", [(1, 1.0), (2, 0.05), (3, 30.0)])
def test_hard_negatives(spark, seed, spread):
    rows = hard_rows(seed, 240, spread=spread)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = negatives.hard_negatives(df, F.expr("vec_id % 15 = 0"), F.col("label"))
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, 15)


def test_bounds_keep_every_pair():
    r = np.random.default_rng(5)
    a, v = (np.floor(r.normal(size=(n, 32)) * np.linspace(200, 1, 32)).astype(np.int64) for n in (30, 500))
    turn = negatives.rotation(v.T.astype(float) @ v)
    low, high = np.full(30, 60_000.0), np.full(30, 90_000.0)
    i, j = negatives.survivors(negatives.Turned.of(a, turn), negatives.Turned.of(v, turn), low, high)
    scores = a @ v.T
    needed = set(zip(*np.nonzero((scores >= 60_000) & (scores <= 90_000))))
    assert needed <= set(zip(i, j)) and len(i) < 1.2 * len(needed) + 50
    assert (negatives.verified(a, v, i, j) == scores[i, j]).all()


def test_windows():
    low, high = negatives.windows(np.array([10, 7, 0, -3]), 30, 90)
    assert low.tolist() == [3, 3, 0, 1] and high.tolist() == [9, 6, 0, 0]


def test_blocks_are_not_broadcast(spark, tmp_path):
    """The copies of the queries for all shards would be put together in the driver."""
    spark.createDataFrame([(0, k, bytearray(b"d")) for k in range(9)], "part int, at int, d binary").write.parquet(f"{tmp_path}/data")
    spark.createDataFrame([(k, bytearray(b"q")) for k in range(3)], "qat int, q binary").write.parquet(f"{tmp_path}/queries")
    pairs = vectors.grid(spark.read.parquet(f"{tmp_path}/data"), spark.read.parquet(f"{tmp_path}/queries"), 9)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert pairs.count() == 27


def test_copies_of_queries_follow_the_data(spark):
    """Shards times queries may not grow with the square of the rows."""
    asked = "spark.sql.shuffle.partitions"
    before = spark.conf.get(asked)
    spark.conf.set(asked, "1000")
    try:
        for blocks in (100, 400):
            data, queries = spark.range(blocks).selectExpr("0 AS part", "CAST(id AS int) AS at"), spark.range(blocks // 20).withColumnRenamed("id", "q")
            assert vectors.grid(data, queries, blocks).groupBy("shard").count().count() <= 2 * 20
    finally:
        spark.conf.set(asked, before)
