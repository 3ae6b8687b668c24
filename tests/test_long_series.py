"""Series in blocks against windows by series."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from siftstone.operators import long_series as L
from siftstone.operators import series as S


def rows_of(df, *columns):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def frames(spark):
    r, rows = random.Random(2), []
    for name, n in (("a", 900), ("b", 3), ("c", 1), (None, 140), ("d", 33)):
        for k in range(n):
            rows.append((name, k // 2, k, None if r.random() < 0.01 else r.choice([r.random() * 3, 5.0, 5.0, r.random() * 60])))
    r.shuffle(rows)
    return spark.createDataFrame(rows, "s string, ts int, id int, v double").repartition(3)


@pytest.mark.parametrize("block", [16, 50, 100_000])
def test_blocks(frames, monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK", block)
    d, long_d = S.differences(frames, "s", ["ts", "id"], "v"), L.differences(frames, "s", ["ts", "id"], "v")
    assert rows_of(long_d.na.fill({"s": "?"}), "s", "t", "d") == rows_of(d.na.fill({"s": "?"}), "s", "t", "d")
    d = d.na.fill({"s": "?"}).cache()
    for cut in (50.0, 3.0, 100.0):
        seg, long_seg = S.segments(d, "s", cut), L.segments(d, "s", cut)
        assert rows_of(long_seg, "s", "seg", "t", "d", "i") == rows_of(seg, "s", "seg", "t", "d", "i")
        assert rows_of(L.moving_average(seg, "s"), "s", "seg", "i", "n", "ma") == rows_of(S.moving_average(seg, "s"), "s", "seg", "i", "n", "ma")
        columns = ("s", "seg", "n", *[F.round(c, 6) for c in ("energy", "p2", "p8")])
        assert rows_of(L.lagged_products(seg, "s", 9, (2, 8)), *columns) == rows_of(S._lagged_products(seg, "s", 9, (2, 8)), *columns)
        assert rows_of(L.steps(seg, "s").groupBy("s", "seg").agg(F.sum("step").alias("x")), "s", "seg", F.round("x", 6)) == rows_of(S.statistics(seg, "s").withColumn("x", F.when(F.col("n") > 1, F.col("step") * (F.col("n") - 1))), "s", "seg", F.round("x", 6))
        assert rows_of(L.median(seg, ["s", "seg"], "d"), "s", "seg", "median") == rows_of(seg.groupBy("s", "seg").agg(F.median("d").alias("median")), "s", "seg", "median")
    d.unpersist()


def test_long_groups_go_by_blocks(frames, monkeypatch):
    seg = S.segments(S.differences(frames, "s", ["ts", "id"], "v").na.fill({"s": "?"}), "s", 50.0)
    plain = rows_of(S.verdicts(seg, "s", S.Limits(cut=50.0)), "s", "seg", "n", "verdict", F.round("median", 6), F.round("peak", 6))
    monkeypatch.setattr(S, "LONG", 10)
    monkeypatch.setattr(L, "BLOCK", 20)
    seg = S.segments(S.differences(frames, "s", ["ts", "id"], "v").na.fill({"s": "?"}), "s", 50.0)
    assert rows_of(S.verdicts(seg, "s", S.Limits(cut=50.0)), "s", "seg", "n", "verdict", F.round("median", 6), F.round("peak", 6)) == plain


def test_median_of_one_value_and_of_ties(spark):
    values = [1.0] * 500 + [2.0, None, 9.0]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", 7.0), ("n", None)], "g string, v double")
    assert rows_of(L.median(df, ["g"], "v"), "g", "median") == [("g", statistics.median([v for v in values if v])), ("h", 7.0)]
