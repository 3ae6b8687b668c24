"""Explicit lists of files, sets and documents of verdicts."""

import json

from pyspark.sql import functions as F

from siftstone.operators import sets, verdicts
from siftstone.sources import readers


def test_lists_of_files(spark, tmp_path):
    for name in ("口白腳本_a.txt", "other.txt", "口白腳本_b.txt"):
        (tmp_path / name).write_text(f"{name}\nx", encoding="utf-8")
    assert {tuple(r) for r in readers.read_narration(spark, str(tmp_path)).collect()} == {(n, f"{n}\nx") for n in ("口白腳本_a.txt", "口白腳本_b.txt")}
    assert {r.text for r in readers.read_narration(spark, [str(tmp_path / "other.txt"), str(tmp_path / "口白腳本_b.txt")]).collect()} == {"other.txt\nx", "口白腳本_b.txt\nx"}
    (tmp_path / "p").mkdir()
    for name in ("a.png", "p/b.jpg", "p/c.txt"):
        (tmp_path / name).write_bytes(b"x")
    found = readers.read_images(spark, [str(tmp_path / "a.png"), str(tmp_path / "p")]).select("path").collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in found) == ["a.png", "b.jpg"]


def test_sets(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, None)], "id int, name string"), spark.createDataFrame([("x", 9)], "name string, n int")
    both = sets.union_sources({"a": a, "b": b})
    assert {tuple(r) for r in both.select("source", "id", "name", "n").collect()} == {("a", 1, "x", None), ("a", 2, None, None), ("b", None, "x", 9)}
    assert {tuple(r) for r in sets.per_source(both, "source", F.count("n").alias("n")).collect()} == {("a", 2, 0), ("b", 1, 1)}
    assert [r.id for r in sets.unknown(a, b, "name").collect()] == [2]


def test_result_json(spark):
    df = spark.createDataFrame([("p/a.png", "收", [], 800, None)], "path string, verdict string, reasons array<struct<level:string,code:string>>, long_side int, solidity double")
    assert json.loads(verdicts.result_json(df, ["long_side", "solidity"]).first().json) == {"file": "p/a.png", "verdict": "收", "reasons": [], "measure": {"long_side": 800}}
