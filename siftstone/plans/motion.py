"""Motion queries: the events of a user are the frames of a series, their values its brightness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.catalogue import register
from siftstone.operators import long_series as L
from siftstone.operators import series as S
from siftstone.plans.shared import table, written

LIMITS = S.Limits(cut=150.0)


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.differences(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "value")


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.segments(_frames(spark, sf_dir), "user_id", LIMITS.cut)


def _rounded(c: str):
    """Four decimals by a rule that both engines share."""
    return (F.floor(F.col(c) * 10000 + 0.5) / 10000).alias(c)


_R = lambda c: f"floor({c} * 10000 + 0.5) / 10000"
SQL_D = "d0 AS (SELECT user_id, row_number() OVER w - 1 AS t, abs(value - lag(value) OVER w) AS d FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), d AS (SELECT * FROM d0 WHERE d IS NOT NULL)"
SQL_SEG = SQL_D + ", s0 AS (SELECT *, sum(CASE WHEN d > 150 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t) AS seg FROM d), seg AS (SELECT user_id, seg, t, d, t - min(t) OVER (PARTITION BY user_id, seg) AS i, count(*) OVER (PARTITION BY user_id, seg) AS n FROM s0 WHERE d <= 150)"
SQL_MA = SQL_SEG + ", ma AS (SELECT *, (sum(d) OVER (PARTITION BY user_id, seg ORDER BY i ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) + greatest(0, 4 - i) * first(d) OVER w + greatest(0, i + 4 - (n - 1)) * last(d) OVER w) / 9 AS ma FROM seg WINDOW w AS (PARTITION BY user_id, seg ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"
SQL_AC = SQL_MA + ", x0 AS (SELECT user_id, seg, i, n, d - ma AS x FROM ma), x AS (SELECT user_id, seg, i, n, x - avg(x) OVER (PARTITION BY user_id, seg) AS x FROM x0), e AS (SELECT user_id, seg, any_value(n) AS n, sum(x * x) AS energy FROM x GROUP BY ALL), lags(k) AS (SELECT unnest(range(2, 9))), p AS (SELECT a.user_id, a.seg, k, sum(a.x * b.x) AS p FROM x a, lags JOIN x b ON a.user_id = b.user_id AND a.seg = b.seg AND b.i = a.i + k GROUP BY ALL), ac AS (SELECT e.user_id, e.seg, e.n, greatest(0.0, coalesce(max(CASE WHEN n >= 25 AND energy > 1e-12 THEN p / energy * n / (n - k) END), 0.0)) AS peak FROM e LEFT JOIN p ON e.user_id = p.user_id AND e.seg = p.seg GROUP BY ALL)"
SQL_ST = ", st0 AS (SELECT *, abs(d - lag(d) OVER (PARTITION BY user_id, seg ORDER BY i)) AS step FROM seg), st AS (SELECT user_id, seg, count(*) AS n, avg(d) AS mean, median(d) AS median, coalesce(avg(step), 0.0) AS step, CASE WHEN avg(d) > 0 THEN coalesce(avg(step), 0.0) / avg(d) ELSE 0.0 END AS ratio, CASE WHEN avg(d) > 0 THEN stddev_pop(d) / avg(d) ELSE 0.0 END AS amp FROM st0 GROUP BY ALL)"
SQL_SP = ", hot AS (SELECT seg.user_id, seg.seg, i, lag(i) OVER (PARTITION BY seg.user_id, seg.seg ORDER BY i) AS b FROM seg JOIN (SELECT user_id, seg, median(d) AS med FROM seg GROUP BY ALL) m ON seg.user_id = m.user_id AND seg.seg = m.seg WHERE d > greatest(1.0, 4 * med)), g AS (SELECT user_id, seg, i, i - lag(i) OVER (PARTITION BY user_id, seg ORDER BY i) AS gap FROM hot WHERE b IS NULL OR i > b + 1), gm AS (SELECT user_id, seg, median(gap) AS g FROM g GROUP BY ALL), sp AS (SELECT g.user_id, g.seg, count(*) AS spikes, count(*) >= 3 AND coalesce(avg(CASE WHEN gap IS NOT NULL THEN CASE WHEN abs(gap - gm.g) <= 1 THEN 1.0 ELSE 0.0 END END) >= 0.75, FALSE) AS regular FROM g JOIN gm ON g.user_id = gm.user_id AND g.seg = gm.seg GROUP BY ALL)"
SQL_V = SQL_AC + SQL_ST + SQL_SP + ", v AS (SELECT st.*, ac.peak, CASE WHEN st.n < 10 THEN 'SKIP' WHEN median < 0.3 THEN CASE WHEN coalesce(regular, FALSE) THEN 'FAIL' ELSE 'PASS' END WHEN ratio > 0.15 THEN 'FAIL' WHEN amp >= 0.08 AND ac.peak > 0.35 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM st JOIN ac ON st.user_id = ac.user_id AND st.seg = ac.seg LEFT JOIN sp ON st.user_id = sp.user_id AND st.seg = sp.seg)"

register("frame_diff", lambda s, d: _frames(s, d).select("user_id", F.col("t").cast("long").alias("t"), _rounded("d")), f"WITH {SQL_D} SELECT user_id, t, {_R('d')} AS d FROM d")
register("segments", lambda s, d: _segments(s, d).select("user_id", F.col("seg").cast("long").alias("seg"), F.col("t").cast("long").alias("t"), F.col("i").cast("long").alias("i")), f"WITH {SQL_SEG} SELECT user_id, CAST(seg AS BIGINT) AS seg, t, i FROM seg")
register("moving_average", lambda s, d: S.moving_average(_segments(s, d), "user_id", LIMITS.smooth).select("user_id", F.col("t").cast("long").alias("t"), _rounded("ma")), f"WITH {SQL_MA} SELECT user_id, t, {_R('ma')} AS ma FROM ma")
register("segment_stats", lambda s, d: S.statistics(_segments(s, d), "user_id").select("user_id", F.col("seg").cast("long").alias("seg"), "n", *map(_rounded, ("mean", "median", "step", "ratio", "amp"))), f"WITH {SQL_SEG}{SQL_ST} SELECT user_id, CAST(seg AS BIGINT) AS seg, n, {', '.join(f'{_R(c)} AS {c}' for c in ('mean', 'median', 'step', 'ratio', 'amp'))} FROM st")
register("autocorr_peak", lambda s, d: S.autocorrelation(_segments(s, d), "user_id", LIMITS).select("user_id", F.col("seg").cast("long").alias("seg"), _rounded("peak")), f"WITH {SQL_AC} SELECT user_id, CAST(seg AS BIGINT) AS seg, {_R('peak')} AS peak FROM ac")
register("static_spikes", lambda s, d: S.spikes(_segments(s, d), "user_id", LIMITS).select("user_id", F.col("seg").cast("long").alias("seg"), "spikes", F.coalesce("regular", F.lit(False)).alias("regular")), f"WITH {SQL_SEG}{SQL_SP} SELECT user_id, CAST(seg AS BIGINT) AS seg, spikes, regular FROM sp")
register("segment_verdict", lambda s, d: S.verdicts(_segments(s, d), "user_id", LIMITS).select("user_id", F.col("seg").cast("long").alias("seg"), "n", "verdict"), f"WITH {SQL_V} SELECT user_id, CAST(seg AS BIGINT) AS seg, n, verdict FROM v")
register("motion_verdict", lambda s, d: S.series_verdict(S.verdicts(_segments(s, d), "user_id", LIMITS), "user_id"), f"WITH {SQL_V} SELECT user_id, count(*) AS segments, count(*) FILTER (verdict = 'FAIL') AS failed, CASE WHEN bool_or(verdict = 'FAIL') THEN 'FAIL' ELSE 'PASS' END AS verdict FROM v GROUP BY 1")


def nearest_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    times = e.select(F.col("user_id").alias("series"), (F.pmod("event_id", F.lit(700)) / 4).alias("s")).distinct()
    frames = e.groupBy(F.col("user_id").alias("series")).agg(F.count("*").alias("n")).select("series", (F.col("n") - 1).alias("frame"))
    return S.nearest_frame(times, frames, 1.0).groupBy("series").agg(F.sum("frame").alias("frames"))


register("nearest_frame", nearest_frame, "WITH t AS (SELECT DISTINCT user_id AS series, (event_id % 700) / 4 AS s FROM events), l AS (SELECT user_id AS series, count(*) - 1 AS last FROM events GROUP BY 1) SELECT series, CAST(sum(least(CAST(round_even(s, 0) AS BIGINT), last)) AS BIGINT) AS frames FROM t JOIN l USING (series) GROUP BY 1")


def calibration_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", F.floor("value").cast("long").alias("v"))
    return S.separates(e, F.col("event_type") == "click", F.col("event_type") == "view", 250.0)


register("calibration_bounds", calibration_bounds, "SELECT count(*) FILTER (event_type = 'click') AS n_new, count(*) FILTER (event_type = 'view') AS n_old, max(v) FILTER (event_type = 'click') AS max_new, min(v) FILTER (event_type = 'view') AS min_old, max(v) FILTER (event_type = 'click') <= 250 AND 250 < min(v) FILTER (event_type = 'view') AS separates FROM (SELECT event_type, CAST(floor(value) AS BIGINT) AS v FROM events)")


def frame_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.frame_rows(_frames(spark, sf_dir), _segments(spark, sf_dir), "user_id", 8.0)


register("frame_rows", frame_rows, f"""WITH {SQL_SEG}, num AS (SELECT user_id, t, dense_rank() OVER (PARTITION BY user_id ORDER BY seg) AS k FROM seg)
SELECT d.user_id, d.t AS frame, printf('%.3f', floor(d.t / 8.0::DOUBLE * 1000 + 0.5) / 1000) AS time_s, printf('%.4f', floor(d * 10000 + 0.5) / 10000) AS mean_abs_diff, coalesce(CAST(k AS VARCHAR), 'cut') AS segment FROM d LEFT JOIN num USING (user_id, t)""")  # fmt: skip


# ── all events as one series, in blocks ──────────────────────────────────────
def _one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.differences(table(spark, sf_dir, "events").withColumn("user_id", F.lit(0)), "user_id", ["ts", "event_id"], "value")


def _one_segments(spark: SparkSession, sf_dir: str, cut: float = 400.0) -> DataFrame:
    """With this cut segments are long; few blocks have none."""
    return written(L.segments(written(_one(spark, sf_dir), "one"), "user_id", cut), "one-segments")


_ONE = lambda sql: "WITH " + sql.replace("FROM events", "FROM (SELECT 0 AS user_id, ts, event_id, value FROM events)").replace("> 150", "> 400").replace("<= 150", "<= 400")
register("long_series_segments", lambda s, d: _one_segments(s, d).select("t", F.col("seg").cast("long").alias("seg"), F.col("i").cast("long").alias("i")), _ONE(SQL_SEG) + " SELECT t, CAST(seg AS BIGINT) AS seg, i FROM seg")
register("long_series_average", lambda s, d: L.moving_average(_one_segments(s, d), "user_id", LIMITS.smooth).select("t", _rounded("ma"), "n"), _ONE(SQL_MA) + f" SELECT t, {_R('ma')} AS ma, n FROM ma")


def long_series_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians of one group of all values and of groups by kind, by ranks."""
    e = table(spark, sf_dir, "events").select("event_type", "value")
    both = e.union(e.withColumn("event_type", F.lit("all")))
    return L.median(both, ["event_type"], "value").select("event_type", _rounded("median"))


register("long_series_median", long_series_median, f"SELECT event_type, {_R('median')} AS median FROM (SELECT event_type, median(value) AS median FROM (SELECT event_type, value FROM events UNION ALL SELECT 'all', value FROM events) GROUP BY 1)")


def long_series_autocorr(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = L.lagged_products(_one_segments(spark, sf_dir), "user_id", LIMITS.smooth, LIMITS.lags)
    return p.filter("n >= 25").select(F.col("seg").cast("long").alias("seg"), "n", *[(F.floor(F.col(f"p{k}") / F.col("energy") * 10000 + 0.5) / 10000).alias(f"r{k}") for k in (2, 5, 8)])


register("long_series_autocorr", long_series_autocorr, _ONE(SQL_MA) + ", x0 AS (SELECT seg, i, n, d - ma AS x FROM ma), x1 AS (SELECT seg, i, n, x - avg(x) OVER (PARTITION BY seg) AS x FROM x0), x AS (SELECT *, lead(x, 2) OVER w AS x2, lead(x, 5) OVER w AS x5, lead(x, 8) OVER w AS x8 FROM x1 WINDOW w AS (PARTITION BY seg ORDER BY i)) SELECT CAST(seg AS BIGINT) AS seg, count(*) AS n, " + ", ".join(f"floor(sum(x * x{k}) / sum(x * x) * 10000 + 0.5) / 10000 AS r{k}" for k in (2, 5, 8)) + " FROM x GROUP BY seg HAVING count(*) >= 25")
