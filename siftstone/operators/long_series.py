"""The series operators for series of any length: a series is cut into blocks, so no task has to hold one whole.

What a block needs of its neighbours are *carried* numbers (counts, sums, last
values: a row for each block, summed up over the blocks before) or a few *halo*
rows that are copied to it.  Results are those of siftstone.operators.series.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftstone.plans.shared import written

#: Rows of a block; more than any halo.
BLOCK = 100_000
_BITS = 33  # of monotonically_increasing_id(): partition, then place


def _before(series: list[str], block: str) -> Window:
    return Window.partitionBy(*series).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)


def _joined(rows: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the summary's columns; null keys are equal to themselves."""
    other = summary.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in summary.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(other[f"__{k}"]) for k in keys])
    return rows.join(other, on).drop(*[f"__{k}" for k in keys])


def numbered(rows: DataFrame, series: list[str], order: list[Column | str], last: str | None = None, number: str = "t") -> DataFrame:
    """rows with `number` (1, 2, ... in each series, by order) and n (rows of the series).

    Rows are range-partitioned and written; the numbers of a partition's first
    rows are carried.  last: a column whose value in the row before comes as
    `previous` too (null in the first row of a series).
    """
    parts, by = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), [*map(F.col, series), *order]
    ranged = written(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id()), "series")
    ranged = ranged.withColumn("__part", F.shiftright("__at", _BITS).cast("int"))
    more = [F.max_by(F.struct(F.col(last).alias("v")), "__at").alias("__end")] if last else []
    summary = ranged.groupBy(*series, "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"), *more)
    carried = summary.withColumns({"__shift": F.coalesce(F.sum("__n").over(_before(series, "__part")), F.lit(0)), "n": F.sum("__n").over(Window.partitionBy(*series))})
    if last:
        carried = carried.withColumn("__end", F.lag("__end").over(Window.partitionBy(*series).orderBy("__part")))
    out = _joined(ranged, carried.drop("__n"), [*series, "__part"])
    if last:
        inner = F.lag(last).over(Window.partitionBy(*series, "__part").orderBy("__at"))
        out = out.withColumn("previous", F.when(F.col("__at") == F.col("__first"), F.col("__end.v")).otherwise(inner))
    return out.withColumn(number, F.col("__at") - F.col("__first") + F.col("__shift") + 1).drop("__at", "__part", "__first", "__shift", *["__end"] * bool(last))


def differences(frames: DataFrame, series: str, order: list[str], value: str) -> DataFrame:
    """frame number t from 1 and d = |value - the value before|, without the first frame."""
    f = numbered(frames.select(series, *order, F.col(value).alias("__value")), [series], order, "__value")
    return f.select(series, (F.col("t") - 1).alias("t"), F.abs(F.col("__value") - F.col("previous")).alias("d")).filter(F.col("d").isNotNull())


def segments(d: DataFrame, series: str, cut: float) -> DataFrame:
    """Rows with segment number seg and position i in it; a row with d > cut ends a segment and is in none."""
    keys = [series, "__block"]
    w = Window.partitionBy(*keys).orderBy("t")
    inside = d.withColumns({"__block": F.floor(F.col("t") / BLOCK), "__cut": (F.col("d") > cut)})
    inside = inside.withColumns({"__was": F.lag("__cut").over(w), "__cuts": F.sum(F.col("__cut").cast("long")).over(w)})
    begins = F.when(~F.col("__cut") & F.col("__was"), F.col("t"))
    inside = inside.withColumns({"__start": F.max(begins).over(w)})
    summary = inside.groupBy(*keys).agg(
        F.max("__cuts").alias("__all"), F.max("__start").alias("__inner"), F.min("t").alias("__first"),
        F.min_by("__cut", "t").alias("__first_cut"), F.max_by("__cut", "t").alias("__last_cut"),
    )
    by = Window.partitionBy(series).orderBy("__block")
    # The block's first row begins a segment if the row before it, in an earlier block, is a cut or does not exist.
    opens = F.when(~F.col("__first_cut") & F.coalesce(F.lag("__last_cut").over(by), F.lit(True)), F.col("__first"))
    carried = summary.withColumns({"__before": F.coalesce(F.sum("__all").over(_before([series], "__block")), F.lit(0)), "__open": opens})
    carried = carried.withColumn("__earlier", F.max(F.coalesce("__inner", "__open")).over(_before([series], "__block")))
    out = _joined(inside, carried.select(*keys, "__before", "__open", "__earlier"), keys).filter(~F.col("__cut"))
    first = F.coalesce("__start", "__open", "__earlier")
    return out.select(series, (F.col("__before") + F.col("__cuts")).alias("seg"), "t", "d", (F.col("t") - first).cast("int").alias("i"))


def with_halo(rows: DataFrame, position: str, before: int, after: int) -> DataFrame:
    """Rows with __block and __own; the `before` last of a block are copied to the next one, the `after` first to the one before it."""
    own, place = F.floor(F.col(position) / BLOCK), F.col(position) % BLOCK
    blocks = F.array_compact(F.array(own, F.when(place >= BLOCK - before, own + 1), F.when((place < after) & (own > 0), own - 1)))
    return rows.withColumn("__block", F.explode(blocks)).withColumn("__own", F.col("__block") == own)


def spread(summary: DataFrame, n: str) -> DataFrame:
    """A segment's summary once for each of its blocks: joined by block it makes no hot key."""
    return summary.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / BLOCK))))


def _dense(seg: DataFrame, series: str) -> DataFrame:
    """seg with n and __r, the row's number in its segment from 0; i leaves out what has no difference."""
    r = numbered(seg.drop("n"), [series, "seg"], ["i"], number="__r")
    return r.withColumn("__r", F.col("__r") - 1)


def _averaged(seg: DataFrame, series: str, width: int) -> DataFrame:
    half, keys = width // 2, [series, "seg", "__block"]
    seg = written(_dense(seg, series), "segments")
    ends = seg.groupBy(series, "seg").agg(F.max("n").alias("__rows"), F.min_by("d", "i").alias("__a"), F.max_by("d", "i").alias("__z"))
    near = F.sum("d").over(Window.partitionBy(*keys).orderBy("__r").rowsBetween(-half, half))
    rows = with_halo(seg, "__r", half, half).withColumn("__near", near).filter("__own").drop("__own")
    rows = _joined(rows, spread(ends, "__rows").drop("__rows"), keys)
    left, right = F.greatest(F.lit(0), half - F.col("i")), F.greatest(F.lit(0), F.col("i") + half - (F.col("n") - 1))
    return rows.withColumn("ma", (F.col("__near") + left * F.col("__a") + right * F.col("__z")) / width).drop("__near", "__a", "__z", "__block")


def moving_average(seg: DataFrame, series: str, width: int = 9) -> DataFrame:
    """Adds ma: the centred average with the edge values repeated beyond the edges, and n."""
    return _averaged(seg, series, width).drop("__r")


def lagged_products(seg: DataFrame, series: str, width: int, lags: tuple[int, int]) -> DataFrame:
    """(series, seg, n, energy, p<k> for each lag k): sums over the detrended, centred segment."""
    lo, hi = lags
    x = _averaged(seg, series, width).select(series, "seg", "__r", (F.col("d") - F.col("ma")).alias("x"))
    middle = x.groupBy(series, "seg").agg(F.avg("x").alias("__mean"), F.count("*").alias("__rows"))
    keys = [series, "seg", "__block"]
    x = _joined(x.withColumn("__block", F.floor(F.col("__r") / BLOCK)), spread(middle, "__rows").drop("__rows"), keys).withColumn("x", F.col("x") - F.col("__mean")).drop("__block", "__mean")
    w = Window.partitionBy(*keys).orderBy("__r")
    x = with_halo(x, "__r", 0, hi)
    x = x.withColumns({f"x{k}": F.lead("x", k).over(w) for k in range(lo, hi + 1)}).filter("__own")
    return x.groupBy(series, "seg").agg(F.count("*").alias("n"), F.sum(F.col("x") * F.col("x")).alias("energy"), *[F.sum(F.col("x") * F.col(f"x{k}")).alias(f"p{k}") for k in range(lo, hi + 1)])


def steps(seg: DataFrame, series: str) -> DataFrame:
    """seg with step = |d - the d before it in the segment|."""
    rows = with_halo(_dense(seg, series).drop("n"), "__r", 1, 0)
    before = F.lag("d").over(Window.partitionBy(series, "seg", "__block").orderBy("__r"))
    return rows.withColumn("step", F.abs(F.col("d") - before)).filter("__own").drop("__own", "__block", "__r")


def median(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, median: the exact median of each group's values (nulls left out), whatever the group's size.

    Ranks come from a global sort with carried counts; the rows in the middle answer.
    """
    r = numbered(rows.select(*keys, value).filter(F.col(value).isNotNull()), keys, [value])
    middle = r.filter((F.col("t") == F.floor((F.col("n") + 1) / 2)) | (F.col("t") == F.floor(F.col("n") / 2) + 1))
    return middle.groupBy(*keys).agg(F.avg(value).alias("median"))
