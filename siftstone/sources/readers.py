"""Readers: strict offer files in several encodings, narration files, specs, label boxes, images."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.operators.offers import FIELDS
from siftstone.sources.config import ConfigError, header_map
from siftstone.sources.split_csv import read_offers_in_parts


def offer_rows(text: str, columns: dict[str, list[str]], where: str = "") -> Iterator[dict]:
    """Rows of one file: every field as text, absent ones '', with _line from 2; ragged rows and empty files are errors."""
    rows = csv.reader(io.StringIO(text, newline=""))
    header = next(rows, None)
    if not header:
        raise ConfigError(f"{where}: empty")
    fields, found, titled = header_map(header, columns, where), 0, False
    for line, row in enumerate(rows, start=2):
        if not any(cell.strip() for cell in row):
            continue
        if len(row) != len(fields):
            raise ConfigError(f"{where}: row {line} has {len(row)} cells, not {len(fields)}")
        out = dict.fromkeys(FIELDS, "") | dict(zip(fields, row, strict=True))
        titled = titled or bool(out["title"].strip())
        found += 1
        yield out | {"_line": line}
    if not found or not titled:
        raise ConfigError(f"{where}: no data rows" if not found else f"{where}: no titles")


def read_offers(spark: SparkSession, paths: list[str] | str, columns: dict[str, list[str]]) -> DataFrame:
    """All files' rows, with _file and _line; files of any size are read in parts."""
    return read_offers_in_parts(spark, paths, columns)


def per_file_counts(offers: DataFrame) -> DataFrame:
    return offers.groupBy("_file").agg(F.count("*").alias("rows"))


def read_narration(spark: SparkSession, source: str | list[str], pattern: str = "口白腳本_*.txt") -> DataFrame:
    """(file, text) of the narration files of a folder, or of an explicit list of files, whatever their names."""
    named = spark.read if isinstance(source, list) else spark.read.option("pathGlobFilter", pattern)
    t = named.text(source, wholetext=True)
    return t.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def plan_clips(spark: SparkSession, path: str) -> DataFrame:
    """File names that a plan's shots ask for."""
    plan = spark.read.option("multiLine", True).schema("shots array<struct<clip:string>>").json(path)
    return plan.select(F.explode("shots").alias("s")).select(F.concat(F.lit("口白腳本_"), "s.clip", F.lit(".txt")).alias("file"))


def read_specs(spark: SparkSession, path: str) -> DataFrame:
    """(file, raw): one specification document per file."""
    t = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return t.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("raw"))


def read_label_boxes(spark: SparkSession, path: str) -> DataFrame:
    """(name, box) of a JSON map of [x, y, w, h]; names that begin with _ are comments."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    box = F.from_json("value", "array<int>")
    rows = raw.select(F.explode("m").alias("name", "value")).filter(~F.startswith("name", F.lit("_")))
    return rows.select("name", F.struct(*[F.get(box, k).alias(n) for k, n in enumerate("xywh")]).alias("box"))


def read_images(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, content) of image files: those of a folder, one, or a list of files and folders."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.{jpg,jpeg,png,webp}").load(path).select("path", "content")


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """(path, height, width, channels, data) of the images of a folder, decoded by the JVM's codecs; a file that is none has height -1."""
    return spark.read.format("image").load(path).select(F.col("image.origin").alias("path"), "image.height", "image.width", F.col("image.nChannels").alias("channels"), "image.data")


def scene(settings: DataFrame, shot: int) -> DataFrame:
    """z0, z1, cx, cy of a shot of settings (scenes array<array<string>>); the card has none and is an error."""
    s = F.element_at("scenes", shot)
    value = lambda k: F.when(F.size(s) >= 5, F.get(s, k).cast("double")).otherwise(F.raise_error(F.lit(f"shot {shot} is the card")).cast("double"))
    return settings.select(*[value(k).alias(n) for k, n in ((1, "z0"), (2, "z1"), (3, "cx"), (4, "cy"))])


def frames_between(frames: DataFrame, start: float | None, end: float | None, fps: float) -> DataFrame:
    """Frames (frame, ...) whose time lies in [start, end)."""
    at = F.col("frame") / fps
    keep = F.lit(True) if start is None else at >= start - 1e-6
    return frames.filter(keep if end is None else keep & (at < end - 1e-6))
