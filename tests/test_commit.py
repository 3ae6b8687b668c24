"""The committing sink: whole outputs or none."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from siftstone.sources import commit, sinks


def test_one_file_of_many_parts(spark, tmp_path):
    df = spark.range(1000).select("id", F.concat(F.lit('a "q", é|\n'), "id").alias("text"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("third")).repartitionByRange(7, "id").sortWithinPartitions("id")
    path = str(tmp_path / "new" / "out.csv")
    sinks.write_csv(df, path)
    assert os.listdir(tmp_path / "new") == ["out.csv"]
    with open(path, encoding="utf-8-sig", newline="") as f:
        rows = list(csv.reader(f))
    assert rows[0] == ["id", "text", "third"] and rows[1:] == [[str(k), f'a "q", é|\n{k}', str(k) if k % 3 == 0 else ""] for k in range(1000)]
    assert open(path, "rb").read().count(b"\xef\xbb\xbf") == 1
    sinks.write_markdown(df.limit(2), str(tmp_path / "out.md"), "T")
    assert (tmp_path / "out.md").read_text().splitlines()[:5] == ["# T", "", "| id | text | third |", "|---|---|---|", '| 0 | a "q", é｜ 0 | 0 |']
    sinks.write_csv(df.filter("id < 0"), path)
    assert open(path, encoding="utf-8-sig").read().strip() == "id,text,third"


def test_a_failed_task_leaves_what_stood_there(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    sinks.write_csv(spark.range(3), path)
    before = open(path, "rb").read()
    bad = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_csv(bad, path)
    assert open(path, "rb").read() == before and os.listdir(tmp_path) == ["out.csv"]


def test_packages(spark, tmp_path):
    files = spark.createDataFrame([(f"d{k % 3}/f{k}.txt", f"t{k}\né") for k in range(30)], "path string, text string").repartition(5)
    assert sinks.write_package(files, str(tmp_path / "p")) == 30
    assert sorted(os.listdir(tmp_path)) == ["p"] and (tmp_path / "p/d1/f4.txt").read_bytes() == "t4\né".encode()
    for name in ("../x.txt", "/etc/x", "a/../../x"):
        with pytest.raises(Exception, match="leads out of"):
            sinks.write_package(spark.createDataFrame([("ok.txt", "1"), (name, "2")], "path string, text string"), str(tmp_path / "q"))
    assert sorted(os.listdir(tmp_path)) == ["p"]
    with pytest.raises(ValueError, match="lies in"):
        sinks.write_package(files, str(tmp_path / "p" / "d0"), protected=str(tmp_path / "p"))
    assert commit.inside("/a", "b/c") == "/a/b/c"
