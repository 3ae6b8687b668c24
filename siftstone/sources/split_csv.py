"""Offer files of any size, read in parts.

Spark reads a file's lines in many tasks; a record may go over several lines if
a quoted cell has line breaks.  Whether a line begins inside quotes depends on
all lines before it, but each line only maps the state before it (outside or
inside quotes) to the state after it: it keeps, swaps or sets it.  Such maps
compose, so lines are scanned by blocks (the parts of files that Spark reads),
and the state at a block's begin follows from one row for each block before it.
Record numbers come from counts that are carried in the same way.  Only records
of several lines are put together by a shuffle.

Defined results: as csv.reader gives them for the whole file, with record
numbers as _line; a quote that is never closed makes the rest of its file one
record; UTF-8 (with or without a byte order mark) if all of a file's lines are,
else cp950.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftstone.operators.offers import FIELDS
from siftstone.plans.shared import written
from siftstone.sources.config import ConfigError, decode, header_map

# Cells: quoted ones (and what follows the closing quote), others; and what begins like a quoted cell and has no end.
_CELL = rb'(?:"(?:[^"]|"")*+"[^,]*|[^",][^,]*|)'
_OPEN = re.compile(rb'(?:' + _CELL + rb',)*+"(?:[^"]|"")*+')
_STILL = re.compile(rb'(?:[^"]|"")*+')
_REST = re.compile(rb'(?:[^"]|"")*+"[^,]*(?:,(.*))?', re.S)


_RETURN = re.compile(rb"(?<=\r)(?!$)", re.S)
_LINE = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.struct([("id", pa.int64()), ("sub", pa.int32())])), ("value", pa.binary()), ("zero", pa.bool_()), ("one", pa.bool_())])


def leaves_open(line: bytes, inside: bool) -> bool:
    """Whether a line that begins outside or inside quotes ends inside them."""
    if not inside:
        return bool(_OPEN.fullmatch(line))
    if _STILL.fullmatch(line):
        return True
    rest = _REST.fullmatch(line)[1]
    return rest is not None and leaves_open(rest, False)


def _lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(file, block, at, value binary, zero, one: the states after it): a row for each line; lone carriage returns end lines, too."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for file, block, at, value in zip(*(c.to_pylist() for c in b.columns)):
                for sub, line in enumerate(_RETURN.split(value) if b"\r" in value[:-1] else [value]):
                    quoted = b'"' in line
                    rows.append((file, block, {"id": at, "sub": sub}, line, quoted and leaves_open(line, False), not quoted or leaves_open(line, True)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _LINE.types, strict=True)], _LINE.names)

    text = spark.read.option("lineSep", "\n").text(paths)  # a value keeps its bytes, whatever its encoding
    raw = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("value"))
    return raw.mapInArrow(work, "file string, block long, at struct<id:long,sub:int>, value binary, zero boolean, one boolean")


def _state(swaps: Column, last: Column, entry: Column) -> Column:
    """The state after maps of which `last` (struct swaps, value) is the last that sets it, if any does."""
    odd = lambda n: n % 2 == 1
    return F.when(last.isNotNull(), last["value"] != odd(swaps - last["swaps"])).otherwise(entry != odd(swaps))


def records(lines: DataFrame) -> DataFrame:
    """(file, number, value): the records of each file, numbered from 1."""
    block = Window.partitionBy("file", "block").orderBy("at")
    upto, above = block.rowsBetween(Window.unboundedPreceding, 0), block.rowsBetween(Window.unboundedPreceding, -1)
    swap, sets = F.col("zero") & ~F.col("one"), F.col("zero") == F.col("one")
    s = lines.withColumn("swaps", F.sum(swap.cast("long")).over(upto))
    s = s.withColumn("set", F.when(sets, F.struct("swaps", F.col("zero").alias("value"))))
    s = s.withColumns({"before": F.coalesce(F.sum(swap.cast("long")).over(above), F.lit(0)), "last": F.last("set", ignorenulls=True).over(above)})
    # A block's map: the number of its swaps, and the last line that sets the state.
    ends = s.groupBy("file", "block").agg(F.max("swaps").alias("n"), F.max_by("set", F.when(F.col("set").isNotNull(), F.col("at"))).alias("set"))
    by = Window.partitionBy("file").orderBy("block")
    ends = ends.withColumn("total", F.sum("n").over(by))
    ends = ends.withColumn("whole", F.when(F.col("set").isNotNull(), F.struct((F.col("total") - F.col("n") + F.col("set.swaps")).alias("swaps"), F.col("set.value").alias("value"))))
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("file", "block", _state(F.col("total") - F.col("n"), F.last("whole", ignorenulls=True).over(earlier), F.lit(False)).alias("entry"))
    s = s.join(ends, ["file", "block"]).withColumn("inside", _state(F.col("before"), F.col("last"), F.col("entry")))
    s = s.withColumn("open", F.when(F.col("inside"), F.col("one")).otherwise(F.col("zero")))
    s = written(s.select("file", "block", "at", "value", "inside", "open", F.sum((~F.col("inside")).cast("long")).over(upto).alias("k")), "csv-lines")
    counts = s.groupBy("file", "block").agg(F.max("k").alias("k")).withColumn("shift", F.coalesce(F.sum("k").over(earlier), F.lit(0))).drop("k")
    s = s.join(counts, ["file", "block"]).withColumn("number", F.col("k") + F.col("shift"))
    single = s.filter("NOT inside AND NOT open").select("file", "number", "value")
    # Lines lost their line feeds; those that end with a carriage return alone have kept it.
    pieces = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    feed = lambda p, k: F.when((k == 0) | (F.col("p")[k - 1]["at"]["id"] == p["at"]["id"]) & (F.col("p")[k - 1]["block"] == p["block"]), p["value"]).otherwise(F.concat(F.lit(b"\n"), p["value"]))
    several = s.filter("inside OR open").groupBy("file", "number").agg(pieces.alias("p"))
    joined = F.aggregate(F.transform("p", feed), F.lit(b""), lambda a, x: F.concat(a, x))
    return single.union(several.select("file", "number", joined.alias("value")))


def read_offers_in_parts(spark: SparkSession, paths: list[str] | str, columns: dict[str, list[str]]) -> DataFrame:
    """All files' rows: FIELDS as text, absent ones '', with _file and _line; ragged rows and empty files are errors."""
    lines = written(_lines(spark, paths), "csv")
    plain = lines.groupBy("file").agg(F.bool_and(F.is_valid_utf8(F.col("value").cast("string"))).alias("utf8"))
    found = written(records(lines), "csv-records")
    heads = found.filter("number = 1").select("file", F.col("value").alias("head")).join(plain, "file")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, bytes], list[str]] = {}

        def cells(value: bytes, utf8: bool, where: str) -> list[str]:
            text = value.decode("utf-8-sig") if utf8 else decode(value, where)
            return next(csv.reader(text.splitlines(keepends=True) if "\r" in text or "\n" in text else [text]), [])

        for b in batches:
            rows = []
            for file, number, value, head, utf8 in zip(*(b.column(k).to_pylist() for k in range(5))):
                if (file, head) not in known:
                    header = cells(head, utf8, file)
                    if not header:
                        raise ConfigError(f"{file}: empty")
                    known[file, head] = header_map(header, columns, file)
                fields, row = known[file, head], cells(value, utf8, file)
                if number == 1 or not any(c.strip() for c in row):
                    continue
                if len(row) != len(fields):
                    raise ConfigError(f"{file}: row {number} has {len(row)} cells, not {len(fields)}")
                given = dict(zip(fields, row))
                rows.append([*(given.get(f, "") for f in FIELDS), file, number])
            if rows:
                kinds = [pa.string()] * (len(FIELDS) + 1) + [pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], [*FIELDS, "_file", "_line"])

    schema = ", ".join(f"{f} string" for f in FIELDS) + ", _file string, _line int"
    out = written(found.join(heads, "file").select("file", "number", "value", "head", "utf8").mapInArrow(work, schema), "csv-offers")
    titled = out.groupBy("_file").agg(F.bool_or(F.trim("title") != "").alias("titled"))
    for r in titled.filter("NOT titled").take(1):
        raise ConfigError(f"{r['_file']}: no titles")
    # Spark reads no rows of an empty file; the list of files is the driver's anyway.
    names = [re.sub("^file:/+", "file:/", f) for f in spark.read.format("binaryFile").load(paths).inputFiles()]
    if titled.count() < len(names):
        seen = {r[0] for r in titled.select("_file").collect()}
        raise ConfigError(f"{next(f for f in names if f not in seen)}: no data rows")
    return out
