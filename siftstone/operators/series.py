"""Motion series: differences, segments, smoothing, autocorrelation, verdicts.

Windows are partitioned by series as long as no series has more than LONG rows;
longer ones are worked out in blocks (long_series.py), with the same results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftstone.operators import long_series

#: Rows of a series up to which one task may sort it.
LONG = 1_000_000


def is_long(rows: DataFrame, *keys: str) -> bool:
    return bool(rows.groupBy(*keys).count().filter(F.col("count") > LONG).limit(1).take(1))


@dataclass(frozen=True)
class Limits:
    """Thresholds of the gate; these are the values it was calibrated with."""

    cut: float = 12.0
    least: int = 10
    static_median: float = 0.3
    ratio: float = 0.15
    amplitude: float = 0.08
    peak: float = 0.35
    smooth: int = 9
    lags: tuple[int, int] = (2, 8)
    least_for_peak: int = 25
    spike_floor: float = 1.0
    spike_factor: float = 4.0
    least_spikes: int = 3
    regular_share: float = 0.75


def differences(frames: DataFrame, series: str, order: list[str], value: str) -> DataFrame:
    """frame number t from 1 and d = |value - the value before|, without the first frame."""
    if is_long(frames, series):
        return long_series.differences(frames, series, order, value)
    w = Window.partitionBy(series).orderBy(*order)
    f = frames.select(series, F.row_number().over(w).alias("t"), F.abs(F.col(value) - F.lag(value).over(w)).alias("d"))
    return f.filter(F.col("d").isNotNull()).withColumn("t", F.col("t") - 1)


def segments(d: DataFrame, series: str, cut: float) -> DataFrame:
    """Rows with segment number seg and position i in it; a row with d > cut ends a segment and is in none."""
    if is_long(d, series):
        return long_series.segments(d, series, cut)
    w = Window.partitionBy(series).orderBy("t")
    s = d.withColumn("part", F.sum((F.col("d") > cut).cast("int")).over(w)).filter(F.col("d") <= cut)
    first = F.min("t").over(Window.partitionBy(series, "part"))
    return s.select(series, F.col("part").alias("seg"), "t", "d", (F.col("t") - first).cast("int").alias("i"))


def moving_average(seg: DataFrame, series: str, width: int = 9) -> DataFrame:
    """Adds ma: the centred average with the edge values repeated beyond the edges, and n."""
    if is_long(seg, series, "seg"):
        return long_series.moving_average(seg, series, width)
    half, by = width // 2, Window.partitionBy(series, "seg")
    w = by.orderBy("i")
    near = F.sum("d").over(w.rowsBetween(-half, half))
    n = F.count("*").over(by)
    first, last = F.first("d").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.last("d").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    lack_left, lack_right = F.greatest(F.lit(0), half - F.col("i")), F.greatest(F.lit(0), F.col("i") + half - (n - 1))
    return seg.withColumns({"n": n, "ma": (near + lack_left * first + lack_right * last) / width})


def _lagged_products(seg: DataFrame, series: str, width: int, lags: tuple[int, int]) -> DataFrame:
    by, (lo, hi) = Window.partitionBy(series, "seg"), lags
    x = moving_average(seg, series, width).withColumn("x", F.col("d") - F.col("ma"))
    x = x.withColumn("x", F.col("x") - F.avg("x").over(by))
    x = x.withColumns({f"x{k}": F.lead("x", k).over(by.orderBy("i")) for k in range(lo, hi + 1)})
    products = [F.sum(F.col("x") * F.col(f"x{k}")).alias(f"p{k}") for k in range(lo, hi + 1)]
    return x.groupBy(series, "seg").agg(F.count("*").alias("n"), F.sum(F.col("x") * F.col("x")).alias("energy"), *products)


def medians(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, median: exact, by a hash of the values of a group, or by ranks where a group is long."""
    if is_long(rows, *keys):
        return long_series.median(rows, keys, value)
    return rows.groupBy(*keys).agg(F.median(value).alias("median"))


def autocorrelation(seg: DataFrame, series: str, limits: Limits) -> DataFrame:
    """(series, seg, peak, peak_lag): the largest scaled autocorrelation of the detrended segment over the lags, at least 0, the smallest lag of equals."""
    lo, hi = limits.lags
    g = (long_series.lagged_products if is_long(seg, series, "seg") else _lagged_products)(seg, series, limits.smooth, limits.lags)
    scored = F.array(*[F.struct((F.coalesce(F.col(f"p{k}"), F.lit(0.0)) / F.col("energy") * F.col("n") / (F.col("n") - k)).alias("v"), F.lit(-k).alias("neg")) for k in range(lo, hi + 1)])
    best = F.when((F.col("n") >= limits.least_for_peak) & (F.col("energy") > 1e-12), F.array_max(scored))
    g = g.withColumn("best", best)
    return g.select(series, "seg", F.greatest(F.coalesce("best.v", F.lit(0.0)), F.lit(0.0)).alias("peak"), F.when(F.col("best.v") > 0, -F.col("best.neg")).alias("peak_lag"))


def statistics(seg: DataFrame, series: str) -> DataFrame:
    """n, mean, median, step (mean absolute successive difference), ratio and amp of each segment."""
    sums = [F.count("*").alias("n"), F.avg("d").alias("mean"), F.avg("step").alias("step"), F.stddev_pop("d").alias("std")]
    if is_long(seg, series, "seg"):
        g = long_series.steps(seg, series).groupBy(series, "seg").agg(*sums).join(long_series.median(seg, [series, "seg"], "d"), [series, "seg"])
    else:
        w = Window.partitionBy(series, "seg").orderBy("i")
        s = seg.withColumn("step", F.abs(F.col("d") - F.lag("d").over(w)))
        g = s.groupBy(series, "seg").agg(*sums, F.median("d").alias("median"))
    safe = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return g.select(series, "seg", "n", "mean", "median", F.coalesce("step", F.lit(0.0)).alias("step"), safe(F.coalesce("step", F.lit(0.0)), F.col("mean")).alias("ratio"), safe(F.col("std"), F.col("mean")).alias("amp"))


def spikes(seg: DataFrame, series: str, limits: Limits) -> DataFrame:
    """(series, seg, spikes, regular): starts of hot stretches, and whether they come at even distances."""
    med = medians(seg, [series, "seg"], "d").withColumnRenamed("median", "med")
    hot = seg.join(med, [series, "seg"]).filter(F.col("d") > F.greatest(F.lit(limits.spike_floor), limits.spike_factor * F.col("med")))
    w = Window.partitionBy(series, "seg").orderBy("i")
    start = hot.withColumn("before", F.lag("i").over(w)).filter("before IS NULL OR i > before + 1").withColumn("gap", F.col("i") - F.lag("i").over(w))
    middle = medians(start, [series, "seg"], "gap").withColumnRenamed("median", "g")
    near = F.avg(F.when(F.col("gap").isNotNull(), (F.abs(F.col("gap") - F.col("g")) <= 1).cast("double")))
    g = start.join(middle, [series, "seg"]).groupBy(series, "seg").agg(F.count("*").alias("spikes"), near.alias("near"))
    return g.select(series, "seg", "spikes", ((F.col("spikes") >= limits.least_spikes) & (F.col("near") >= limits.regular_share)).alias("regular"))


def verdicts(seg: DataFrame, series: str, limits: Limits) -> DataFrame:
    """A verdict per segment: SKIP short ones, FAIL on regular spikes of a static one, on a jerky or a periodic one, else PASS."""
    s = statistics(seg, series).join(autocorrelation(seg, series, limits), [series, "seg"]).join(spikes(seg, series, limits), [series, "seg"], "left")
    static = F.col("median") < limits.static_median
    verdict = (
        F.when(F.col("n") < limits.least, "SKIP")
        .when(static, F.when(F.coalesce("regular", F.lit(False)), "FAIL").otherwise("PASS"))
        .when(F.col("ratio") > limits.ratio, "FAIL")
        .when((F.col("amp") >= limits.amplitude) & (F.col("peak") > limits.peak), "FAIL")
        .otherwise("PASS")
    )
    return s.select(series, "seg", "n", "mean", "median", "ratio", "amp", "peak", verdict.alias("verdict"))


def series_verdict(segments_: DataFrame, series: str) -> DataFrame:
    """FAIL if any segment fails."""
    return segments_.groupBy(series).agg(F.count("*").alias("segments"), F.count_if(F.col("verdict") == "FAIL").alias("failed")).withColumn("verdict", F.when(F.col("failed") > 0, "FAIL").otherwise("PASS"))


def nearest_frame(times: DataFrame, frames: DataFrame, fps: float) -> DataFrame:
    """times (series, s) with frame: that at round(s * fps), the last one if that is beyond the end."""
    last = frames.groupBy("series").agg(F.max("frame").alias("last"))
    return times.join(last, "series").withColumn("frame", F.least(F.bround(F.col("s") * fps).cast("long"), F.col("last"))).drop("last")


def separates(values: DataFrame, new: Column, old: Column, threshold: float) -> DataFrame:
    """Calibration: class counts, and whether max(new) <= threshold < min(old)."""
    g = values.agg(F.count_if(new).alias("n_new"), F.count_if(old).alias("n_old"), F.max(F.when(new, F.col("v"))).alias("max_new"), F.min(F.when(old, F.col("v"))).alias("min_old"))
    return g.withColumn("separates", (F.col("max_new") <= threshold) & (F.lit(threshold) < F.col("min_old")))


def frame_rows(d: DataFrame, seg: DataFrame, series: str, fps: float) -> DataFrame:
    """(series, frame, time_s, mean_abs_diff, segment): a row for each difference; segments count from 1, what is in none is a cut."""
    number = F.dense_rank().over(Window.partitionBy(series).orderBy("seg")).cast("string")
    numbered = seg.select(series, "t", number.alias("segment"))
    exact = lambda c, n: F.format_string(f"%.{n}f", F.floor(c * 10**n + 0.5) / 10**n)
    return d.join(numbered, [series, "t"], "left").select(series, F.col("t").cast("long").alias("frame"), exact(F.col("t") / fps, 3).alias("time_s"), exact(F.col("d"), 4).alias("mean_abs_diff"), F.coalesce("segment", F.lit("cut")).alias("segment"))


def verdict_json(segments_: DataFrame, series: str, fps: float, threshold: float) -> DataFrame:
    """(series, json): one document per series with its verdict and its segments (as verdicts() has them), in order."""
    rounded = [F.round(c, 4).alias(c) for c in ("mean", "ratio", "peak")]
    parts = F.array_sort(F.collect_list(F.struct("seg", "n", *rounded, "verdict")))
    g = segments_.groupBy(series).agg(parts.alias("segments"), F.count_if(F.col("verdict") == "FAIL").alias("failed"))
    verdict = F.when(F.col("failed") > 0, "FAIL").otherwise("PASS").alias("verdict")
    return g.select(series, F.to_json(F.struct(F.col(series).alias("file"), F.lit(fps).alias("fps"), F.lit(threshold).alias("threshold"), verdict, "segments")).alias("json"))
