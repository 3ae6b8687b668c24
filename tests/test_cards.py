import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftstone.operators import cards as C
from siftstone.operators import series as S
from siftstone.operators import verdicts as V


def card():
    image = np.empty((1920, 1080, 3), np.uint8)
    image[:] = C.COLOUR
    image[1350:1430, 300:780] = 20  # the call for action
    image[262:368, 132:378] = 200  # the watermark
    return image


def test_frames():
    image = card()
    assert C.frame_gap(image)["status"] == "no product"
    image[500:1290, 200:900] = 90
    assert C.frame_gap(image) == {"status": "ok", "box": (200, 500, 900, 1290), "gap": 130.0}
    image[373:500, 390:900] = 90
    assert C.frame_gap(image)["gap"] == 3.0  # of the box of all its parts
    image[800:900, 0:300] = 90
    assert C.frame_gap(image)["status"] == "edge"
    assert C.frame_gap(image[:, :500])["status"] == "size" and C.frame_gap(image // 2)["status"] == "background"
    assert C.opaque(np.full((4, 5, 3), 255, np.uint8), None, True) is None and C.opaque(np.zeros((4, 5, 3), np.uint8), None, False) == (0, 0, 5, 4)


def test_layout(spark):
    box = lambda *v: F.struct(*[F.lit(x).cast("long").alias(n) for x, n in zip(v, ("x0", "y0", "x1", "y1"), strict=True)])
    rows = [(1, 900, 600), (2, 900, 905), (3, 900, 1000), (4, 400, 1000), (5, 10, 1000)]
    photos = spark.createDataFrame(rows, "id int, width int, height int").withColumn("opaque", F.struct(F.lit(0).cast("long").alias("x0"), F.lit(0).cast("long").alias("y0"), F.col("width").cast("long").alias("x1"), F.col("height").cast("long").alias("y1")))
    got = {r.id: r.place for r in C.layout(photos).collect()}
    assert (got[1].how, got[1].moved, got[1].percent) == ("default", 0, 100) and (got[2].how, got[2].moved, got[2].box.y0) == ("down", 8, 392)
    assert got[3].how == "shrunk" and got[3].gap >= 22 and got[3].box.y1 <= 1300 and got[3].y_min == 392
    assert got[5].how == "default" and got[5].y_min is None  # beside the watermark
    hidden = photos.filter("id = 4").withColumn("opaque", box(0, 0, 4000, 1000))
    assert C.layout(hidden).first().place.ok is not None
    assert C.layout(photos.limit(0)).count() == 0


def test_reports_and_documents(spark):
    reasons = "array<struct<level:string,code:string>>"
    rows = [(2, "a/y.png", "不收", [("不收", "read")], [], None, None, None, None, None), (1, "a/x.png", "收", [], ["paint | it"], 10, 20, 20, 0.98765, 1)]
    df = spark.createDataFrame(rows, f"rank long, path string, verdict string, reasons {reasons}, hints array<string>, width int, height int, long_side int, solidity double, objects int")
    assert [tuple(r) for r in V.report(df).collect()] == [("1", "x.png", "收", "10×20", "20", "0.988", "1", "—", "paint | it"), ("2", "y.png", "不收", "—", "—", "—", "—", "【不收】read", "—")]
    seg = spark.createDataFrame([("v", 1, 30, 1.23456, 0.2, 0.1, "FAIL"), ("v", 0, 12, 1.0, 0.1, 0.0, "PASS"), ("w", 0, 12, 1.0, 0.1, 0.0, "PASS")], "series string, seg int, n long, mean double, ratio double, peak double, verdict string")
    got = {r.series: json.loads(r.json) for r in S.verdict_json(seg, "series", 24.0, 0.15).collect()}
    assert got["v"]["verdict"] == "FAIL" and [x["seg"] for x in got["v"]["segments"]] == [0, 1] and got["v"]["segments"][1]["mean"] == 1.2346 and got["w"]["verdict"] == "PASS"


def test_command(spark, tmp_path, capsys):
    from siftstone.__main__ import main

    shot = lambda i: {"scene_qwen": "a", "scene_video": "b", "anchors": "c", "outfit": "d", "line": ["這是第一句話說得比較" + "一二三"[i], "那是第二句話說得比較" + "一二三"[i]]}
    spec = {"package": "包裝", "shot_prefix": "x", "structure": "3", "person": {"qwen": "a", "video": "b"}, "product": {"word": "w", "look_qwen": "l", "look_video": "v", "size": "s"}, "shots": [shot(i) for i in range(3)]}
    path = tmp_path / "spec.json"
    run = lambda *more: main([str(path), "--out", str(tmp_path / "out"), *more], spark)
    path.write_text(json.dumps(spec), encoding="utf-8")
    assert run() == 0 and len([f for f in (tmp_path / "out").rglob("*.txt")]) == 9
    said = capsys.readouterr().out
    assert "9 files written" in said and "--length 156" in said
    assert run("--protected", str(tmp_path / "out")) == 2
    path.write_text(json.dumps(spec | {"structure": 3}), encoding="utf-8")
    assert run() == 2 and "type:structure" in capsys.readouterr().err
    assert main([str(tmp_path / "none.json")], spark) == 2
