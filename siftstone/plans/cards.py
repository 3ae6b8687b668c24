"""End card queries (a part is a photo, its size and box by key) and files of boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.catalogue import register
from siftstone.functions import boxes as B
from siftstone.operators import cards as C
from siftstone.plans.shared import spread, table


def card_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("p_partkey").cast("long"), F.col("p_size").cast("long")
    w, h = k % 900 + 200, s * 37 + 200
    photos = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select("p_partkey", w.alias("width"), h.alias("height"), B.box(k % 7, s % 5, w - k % 11, h - s % 3).alias("opaque"))
    q = C.layout(photos).select("p_partkey", "place.*")
    return q.select("p_partkey", "ok", "how", "percent", "moved", "w", "h", "x", "y", F.col("box.x0").alias("x0"), F.col("box.y0").alias("y0"), F.col("box.x1").alias("x1"), F.col("box.y1").alias("y1"), (F.floor(F.col("gap") * 100 + 0.5) / 100).alias("gap"), "y_min")


_PUT = "{w} AS w, {h} AS h, (1080 - {w}) // 4 * 2 AS x, {y} AS y, (1080 - {w}) // 4 * 2 + bx0 * {w} // iw AS x0, {y} + by0 * {h} // ih AS y0, (1080 - {w}) // 4 * 2 + (bx1 * {w} + iw - 1) // iw AS x1, {y} + (by1 * {h} + ih - 1) // ih AS y1"
_D2 = "greatest(0, 130 - x1, x0 - 380) * greatest(0, 130 - x1, x0 - 380)"
_ALL2 = f"({_D2} + greatest(0, 260 - y1, y0 - 370) * greatest(0, 260 - y1, y0 - 370))"
_PC = "({v} * f // 100 + CASE WHEN {v} * f % 100 > 50 OR ({v} * f % 100 = 50 AND {v} * f // 100 % 2 = 1) THEN 1 ELSE 0 END)"
register("card_layout", card_layout, f"""
WITH i AS (SELECT p_partkey, CAST(p_partkey % 900 + 200 AS BIGINT) AS iw, CAST(p_size * 37 + 200 AS BIGINT) AS ih, p_partkey % 7 AS bx0, p_size % 5 AS by0, p_partkey % 900 + 200 - p_partkey % 11 AS bx1, p_size * 37 + 200 - p_size % 3 AS by1 FROM part),
s AS (SELECT *, CASE WHEN iw * 1000 >= ih * 900 THEN 900 ELSE (2 * iw * 1000 + ih) // (2 * ih) END AS w0, CASE WHEN iw * 1000 >= ih * 900 THEN (2 * ih * 900 + iw) // (2 * iw) ELSE 1000 END AS h0 FROM i),
a AS (SELECT s.*, 0 AS k, 100 AS f, {_PUT.format(w="w0", h="h0", y="((1290 - h0) // 2 * 2)")} FROM s),
b AS (SELECT *, greatest(1300, y1) AS low, y + CAST(ceil(370 + sqrt(CAST(greatest(0, 484 - {_D2}) AS DOUBLE)) - y0) AS BIGINT) AS t FROM a),
m0 AS (SELECT p_partkey, iw, ih, bx0, by0, bx1, by1, w0, h0, low, y AS ya, t + t % 2 AS ym FROM b),
m AS (SELECT m0.*, 1 AS k, 100 AS f, {_PUT.format(w="w0", h="h0", y="ym")} FROM m0),
z0 AS (SELECT m0.*, k, 101 - k AS f FROM m0, unnest(range(2, 52)) AS r(k)),
z1 AS (SELECT *, greatest(1, {_PC.format(v="w0")}) AS zw, greatest(1, {_PC.format(v="h0")}) AS zh FROM z0),
z2 AS (SELECT *, (low - (by1 * zh + ih - 1) // ih) // 2 * 2 AS zy FROM z1),
z AS (SELECT z2.*, {_PUT.format(w="zw", h="zh", y="zy")} FROM z2),
u AS (SELECT p_partkey, y AS ya, k, f, w, h, x, y, x0, y0, x1, y1 FROM b WHERE {_ALL2} >= 484
      UNION ALL SELECT p_partkey, ya, k, f, w, h, x, y, x0, y0, x1, y1 FROM m WHERE {_ALL2} >= 484 AND y1 <= low
      UNION ALL SELECT p_partkey, ya, k, f, w, h, x, y, x0, y0, x1, y1 FROM z WHERE {_ALL2} >= 484),
c AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY k) = 1)
SELECT p_partkey, k IS NOT NULL AS ok, CASE WHEN k = 0 THEN 'default' WHEN k = 1 THEN 'down' WHEN k > 1 THEN 'shrunk' END AS how, CAST(f AS INTEGER) AS percent, CAST(y - ya AS BIGINT) AS moved, CAST(w AS BIGINT) AS w, CAST(h AS BIGINT) AS h, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y,
 CAST(x0 AS BIGINT) AS x0, CAST(y0 AS BIGINT) AS y0, CAST(x1 AS BIGINT) AS x1, CAST(y1 AS BIGINT) AS y1, floor(sqrt(CAST({_ALL2} AS DOUBLE)) * 100 + 0.5) / 100 AS gap,
 CASE WHEN {_D2} < 484 THEN CAST(floor((ceil(370 + sqrt(CAST(484 - {_D2} AS DOUBLE)) - (y0 - y)) + 1) / 2) * 2 AS BIGINT) END AS y_min
FROM part LEFT JOIN c USING (p_partkey)
""")  # fmt: skip


def card_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a user are the frames of a card, ten a second; values are gaps, and one type is no card."""
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_id") % 10 == 3, "edge").otherwise("ok")
    frames = e.select("user_id", (F.col("event_id") % 12 / 10).alias("since"), status.alias("status"), F.floor(F.col("value")).cast("long").alias("gap"))
    return C.card_verdicts(frames, "user_id")


register(
    "card_verdicts", card_verdicts,
    "WITH f AS (SELECT user_id, event_id % 12 AS t, event_id % 10 <> 3 AS ok, CAST(floor(value) AS BIGINT) AS gap FROM events), g AS (SELECT user_id, min(gap) FILTER (t = 10 AND ok) AS gap, count(*) FILTER (t = 10 AND NOT ok) AS bad, min(gap) FILTER (t <= 9 AND ok) AS bounce_gap FROM f GROUP BY 1) SELECT user_id, CASE WHEN gap IS NULL OR bad > 0 THEN 'NONE' WHEN gap >= 20 THEN 'PASS' ELSE 'FAIL' END AS verdict, gap, bounce_gap, coalesce(bounce_gap < 20, FALSE) AS warn FROM g",
)


def label_box_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    entries = p.select("p_brand", F.col("p_partkey").alias("frame"), F.array(F.col("p_size"), F.col("p_size") + 1, F.col("p_size") * 2, F.lit(9)).alias("box"))
    return B.label_json(entries, "p_brand", "frame", "box", "boxes of a brand")


register(
    "label_box_json", label_box_json,
    """WITH e AS (SELECT p_brand, p_partkey AS k, concat('[', p_size, ',', p_size + 1, ',', p_size * 2, ',9]') AS b FROM part)
SELECT p_brand, concat('{"_note":"boxes of a brand",', string_agg(concat('"', p_brand, '@', k, '":', b), ',' ORDER BY k), ',"_frames":[', string_agg(concat('{"frame":', k, ',"box":', b, '}'), ',' ORDER BY k), ']}') AS json FROM e GROUP BY 1""",
)
