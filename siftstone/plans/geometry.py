"""Geometry, verdict and pixel queries over part, events, documents, labels and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.catalogue import register
from siftstone.functions import boxes as B
from siftstone.operators import images as I
from siftstone.operators import strokes as K
from siftstone.operators import verdicts as V
from siftstone.plans.shared import row_index, table

_R = lambda c: f"floor({c} * 10000 + 0.5) / 10000"


def _r(c):
    return F.floor(c * 10000 + 0.5) / 10000


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = lambda e: F.expr(f"cast({e} as int)")
    a = B.box(i("p_partkey % 97"), i("p_size"), i("p_partkey % 97 + p_size + 5"), i("p_size * 2 + 3"))
    b = B.box(i("p_partkey % 61"), i("p_partkey % 43"), i("p_partkey % 61 + 20"), i("p_partkey % 43 + 9"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", a.alias("a"), b.alias("b"))


_SQL_BOX = "b AS (SELECT p_partkey, p_size, p_partkey % 97 AS ax0, p_size AS ay0, p_partkey % 97 + p_size + 5 AS ax1, p_size * 2 + 3 AS ay1, p_partkey % 61 AS bx0, p_partkey % 43 AS by0, p_partkey % 61 + 20 AS bx1, p_partkey % 43 + 9 AS by1 FROM part)"
register("box_gap", lambda s, d: _boxes(s, d).select("p_partkey", _r(B.gap(F.col("a"), F.col("b"))).alias("gap")), f"WITH {_SQL_BOX}, g AS (SELECT p_partkey, greatest(0, bx0 - ax1, ax0 - bx1) AS dx, greatest(0, by0 - ay1, ay0 - by1) AS dy FROM b) SELECT p_partkey, {_R('sqrt(CAST(dx * dx + dy * dy AS DOUBLE))')} AS gap FROM g")
register("box_iou", lambda s, d: _boxes(s, d).select("p_partkey", _r(B.iou(F.col("a"), F.col("b"))).alias("iou")), f"WITH {_SQL_BOX}, g AS (SELECT p_partkey, greatest(0, least(ax1, bx1) - greatest(ax0, bx0)) * greatest(0, least(ay1, by1) - greatest(ay0, by0)) AS i, (ax1 - ax0) * (ay1 - ay0) + (bx1 - bx0) * (by1 - by0) AS u FROM b) SELECT p_partkey, {_R('CAST(i AS DOUBLE) / (u - i)')} AS iou FROM g")


def box_expand_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = B.expand(F.col("b"), F.lit(70), F.lit(45), up=0.5, down=0.25, left=0.125, right=0.125, pad=1)
    return _boxes(spark, sf_dir).select("p_partkey", e.alias("e")).select("p_partkey", "e.x0", "e.y0", "e.x1", "e.y1")


_C = lambda v, most: f"CAST(least(greatest(round_even({v}, 0), 0), {most}) AS INTEGER)"
register("box_expand_clip", box_expand_clip, f"WITH {_SQL_BOX} SELECT p_partkey, {_C('bx0 - 20 * 0.125 - 1', 70)} AS x0, {_C('by0 - 9 * 0.5 - 1', 45)} AS y0, {_C('bx1 + 20 * 0.125 + 1', 70)} AS x1, {_C('by1 + 9 * 0.25 + 1', 45)} AS y1 FROM b")


def quad_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quads around the boxes of part, mapped by the first frame's window: their boxes in the frame, clipped."""
    p = table(spark, sf_dir, "part").select("p_partkey", *[(F.col("p_size") * m + F.col("p_partkey") % k).cast("double").alias(c) for c, m, k in (("x", 7, 11), ("y", 9, 13))])
    corner = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    quad = F.array(corner(0, 3), corner(120, 0), corner(131, 95), corner(-4, 80))
    window = B.zoom_window(F.lit(1536.0), F.lit(2688.0), F.lit(1.25), F.lit(1.5), F.lit(0.2), F.lit(0.1), F.lit(2), F.lit(0))
    b = B.clip(B.quad_box(B.map_quad(quad, window, F.lit(1536.0), F.lit(2688.0), 1080, 1920)), F.lit(1080), F.lit(1920))
    return p.select("p_partkey", *[b[c].alias(c) for c in ("x0", "y0", "x1", "y1")])


register(
    "quad_boxes", quad_boxes,
    "WITH q AS (SELECT p_partkey, CAST(p_size * 7 + p_partkey % 11 AS DOUBLE) AS x, CAST(p_size * 9 + p_partkey % 13 AS DOUBLE) AS y FROM part), w AS (SELECT *, least(greatest(1536.0::DOUBLE * 0.2::DOUBLE - 1536.0::DOUBLE / 1.25::DOUBLE / 2, 0), 1536.0::DOUBLE - 1536.0::DOUBLE / 1.25::DOUBLE) AS wx, least(greatest(2688.0::DOUBLE * 0.1::DOUBLE - 2688.0::DOUBLE / 1.25::DOUBLE / 2, 0), 2688.0::DOUBLE - 2688.0::DOUBLE / 1.25::DOUBLE) AS wy FROM q) SELECT p_partkey, "
    + ", ".join(f"least(greatest(CAST(round_even((({p}) - w{p[0]}) * 1.25::DOUBLE * {out} / {size}::DOUBLE, 0) AS INTEGER), 0), {out}) AS {n}" for n, p, out, size in (("x0", "x - 4", 1080, "1536.0"), ("y0", "y", 1920, "2688.0"), ("x1", "x + 131", 1080, "1536.0"), ("y1", "y + 95", 1920, "2688.0")))
    + " FROM w",
)


def zoom_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _boxes(spark, sf_dir).select("p_partkey", "b", F.explode(F.sequence(F.lit(0), F.col("p_size") % 5)).alias("i"), (F.col("p_size") % 5 + 1).alias("n"))
    w = B.zoom_window(F.lit(1536.0), F.lit(2688.0), F.lit(1.0), F.lit(1.5), F.lit(0.4), F.lit(0.6), F.col("n"), F.col("i"))
    m = frames.withColumn("w", w).select("p_partkey", "i", B.map_point(F.col("b.x0"), F.col("b.y0"), F.col("w"), F.lit(1536.0), F.lit(2688.0), 1080, 1920).alias("m"))
    return m.select("p_partkey", "i", _r(F.col("m.x")).alias("x"), _r(F.col("m.y")).alias("y"))


register("zoom_map", zoom_map, f"WITH {_SQL_BOX}, f AS (SELECT *, p_size % 5 + 1 AS n, CAST(unnest(range(0, p_size % 5 + 1)) AS INTEGER) AS i FROM b), z AS (SELECT *, 1.0::DOUBLE + 0.5::DOUBLE * i / greatest(n - 1, 1) AS z FROM f), w AS (SELECT *, least(greatest(1536.0::DOUBLE * 0.4::DOUBLE - 1536.0::DOUBLE / z / 2, 0), 1536.0::DOUBLE - 1536.0::DOUBLE / z) AS wx, least(greatest(2688.0::DOUBLE * 0.6::DOUBLE - 2688.0::DOUBLE / z / 2, 0), 2688.0::DOUBLE - 2688.0::DOUBLE / z) AS wy FROM z) SELECT p_partkey, i, {_R('((bx0 - wx) * z * 1080 / 1536.0::DOUBLE)')} AS x, {_R('((by0 - wy) * z * 1920 / 2688.0::DOUBLE)')} AS y FROM w")


def fit_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = B.fit_inside(F.col("p_partkey") % 300 + 50, F.col("p_size") * 7 + 10, F.lit(200).cast("long"), F.lit(120).cast("long"))
    p = table(spark, sf_dir, "part").select("p_partkey", fit.alias("f"), B.floor_even(F.col("p_partkey") * 0.75).alias("even"))
    return p.select("p_partkey", "f.w", "f.h", "even")


register("fit_sizes", fit_sizes, "WITH s AS (SELECT p_partkey, p_partkey % 300 + 50 AS iw, CAST(p_size * 7 + 10 AS BIGINT) AS ih FROM part) SELECT p_partkey, CASE WHEN iw * 120 >= ih * 200 THEN 200 ELSE (2 * iw * 120 + ih) // (2 * ih) END AS w, CASE WHEN iw * 120 >= ih * 200 THEN (2 * ih * 200 + iw) // (2 * iw) ELSE 120 END AS h, CAST(floor(p_partkey * 0.75) AS BIGINT) - CAST(floor(p_partkey * 0.75) AS BIGINT) % 2 AS even FROM s")


# ── verdicts ─────────────────────────────────────────────────────────────────
def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    n, k = F.col("n_chars"), F.col("doc_id")
    m = F.struct(
        (k % 41 != 0).alias("readable"), ((k % 10) / 10).alias("uniform"), n.alias("foreground"), (k % 9).alias("mark_gap"), (k % 13 == 0).alias("crosses_text"), F.when(k % 17 > 0, (k % 17) / 400).alias("bar"),
        (n % 1500).alias("long_side"), (n % 1300).alias("height"), (n % 2000).alias("width"), (F.lit(1) + (k % 11 == 0).cast("int")).alias("objects"), (F.lit(1.0) - (k % 30) / 100).alias("solidity"),
        ((k % 8) / 10).alias("white"), (k % 7).alias("faint_marks"), (k % 4).alias("mark_sides"), (k % 6).alias("faint_gap"), (k % 12).cast("double").alias("slant"), (k % 2 == 0).alias("second_face"), (F.lit(0.85) + (k % 5) / 50).alias("symmetry"),
        ((k % 20) / 25).alias("repeat"), (k % 3 == 0).alias("at_edge"),
    )
    r = d.select(k.alias("doc_id"), (n % 1500).alias("long_side"), V.rules(m).alias("reasons"))
    return r.withColumn("verdict", V.verdict(F.col("reasons")))


_CASES = [
    ("k % 41 = 0", 2), ("k % 41 <> 0 AND k % 10 < 6", 1), ("k % 41 <> 0 AND n < 400", 1), ("s AND k % 9 < 4", 1), ("s AND k % 13 = 0", 1), ("s AND k % 13 <> 0 AND k % 17 >= 8", 1), ("s AND k % 13 <> 0 AND k % 17 BETWEEN 1 AND 7", 1),
    ("s AND n % 1500 < 700", 2), ("s AND n % 1500 BETWEEN 700 AND 999", 1), ("s AND n % 1300 < 600 AND 10 * (n % 2000) < 16 * greatest(n % 1300, 1)", 2), ("s AND n % 1300 < 600 AND 10 * (n % 2000) >= 16 * greatest(n % 1300, 1)", 1), ("s AND k % 11 = 0", 2), ("s AND k % 30 > 25", 2),
    ("s AND k % 30 BETWEEN 13 AND 25", 1), ("s AND k % 8 >= 5", 1), ("s AND k % 7 >= 6 AND k % 4 >= 3", 1), ("s AND k % 7 >= 6 AND k % 4 < 3 AND k % 6 < 4", 1), ("s AND k % 12 > 8 AND k % 2 = 0 AND k % 5 <= 3", 2), ("s AND k % 20 >= 19", 1), ("s AND k % 3 = 0", 0),
]
_SQL_V = "m AS (SELECT doc_id AS k, n_chars AS n, doc_id % 41 <> 0 AND n_chars >= 400 AS s FROM documents), v AS (SELECT k, n, " + "greatest(" + ", ".join(f"CASE WHEN {c} THEN {lv} ELSE 0 END" for c, lv in _CASES) + ") AS sev, " + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c, _ in _CASES) + " AS reasons FROM m), r AS (SELECT k AS doc_id, n % 1500 AS long_side, reasons, CASE sev WHEN 2 THEN '不收' WHEN 1 THEN '要人眼' ELSE '收' END AS verdict, sev FROM v)"
register("verdict_severity", lambda s, d: _results(s, d).select("doc_id", F.size("reasons").cast("long").alias("reasons"), "verdict"), f"WITH {_SQL_V} SELECT doc_id, CAST(reasons AS BIGINT) AS reasons, verdict FROM r")
register("verdict_counts", lambda s, d: _results(s, d).groupBy("verdict").agg(F.count("*").alias("n")), f"WITH {_SQL_V} SELECT verdict, count(*) AS n FROM r GROUP BY 1")


_CODES = ("read", "bg", "nofg", "near-mark", "cross-text", "cross-bar", "cross-bar?", "long<700", "long700-999", "h<600", "wide", "n_obj", "solid<.75", "solid.75-.88", "white", "wm", "wm-near", "slant", "repeat", "edge")
_LEVELS = {0: "備註", 1: "要人眼", 2: "不收"}
_SQL_CODES = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{code}' END" for (c, _), code in zip(_CASES, _CODES, strict=True)) + "], lambda x: x IS NOT NULL)"
_SQL_REASONS = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{{{{\"level\":\"{_LEVELS[lv]}\",\"code\":\"{code}\"}}}}' END" for (c, lv), code in zip(_CASES, _CODES, strict=True)).replace("{{", "{").replace("}}", "}") + "], lambda x: x IS NOT NULL)"
register("verdict_codes", lambda s, d: _results(s, d).select("doc_id", F.array_join(F.transform("reasons", lambda r: r["code"]), " ").alias("codes")), f"WITH {_SQL_V} SELECT k AS doc_id, array_to_string({_SQL_CODES}, ' ') AS codes FROM m")
register(
    "verdict_json", lambda s, d: V.result_json(_results(s, d), ["long_side"], "doc_id"),
    f"""WITH {_SQL_V}, x AS (SELECT k AS doc_id, {_SQL_REASONS} AS rs FROM m) SELECT doc_id, concat('{{"file":"', doc_id, '","verdict":"', verdict, '","reasons":[', array_to_string(rs, ','), '],"measure":{{', CASE WHEN long_side IS NULL THEN '' ELSE concat('"long_side":', long_side) END, '}}}}') AS json FROM r JOIN x USING (doc_id)""",
)


def screen_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _results(spark, sf_dir).withColumn("path", F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    return V.ordered(r, row_index).select("rank", "doc_id", V.page(F.col("rank")).alias("page"))


register("screen_sort", screen_sort, f"WITH {_SQL_V}, o AS (SELECT doc_id, row_number() OVER (ORDER BY sev, long_side DESC, doc_id) AS rank FROM r) SELECT rank, doc_id, (rank - 1) // 100 + 1 AS page FROM o")


def judge_tighten(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = F.create_map(F.lit("front"), F.when(F.col("doc_id") % 2 == 0, "true").otherwise("false"))
    r = _results(spark, sf_dir).withColumn("after", V.judged(F.col("reasons"), answers, {"front": "false"}))
    return r.select("doc_id", V.verdict(F.col("after")).alias("verdict"), (F.size("after") - F.size("reasons")).cast("long").alias("added"))


register("judge_tighten", judge_tighten, f"WITH {_SQL_V} SELECT doc_id, CASE WHEN sev < 2 AND doc_id % 2 = 1 THEN '要人眼' ELSE verdict END AS verdict, CAST(CASE WHEN sev < 2 AND doc_id % 2 = 1 THEN 1 ELSE 0 END AS BIGINT) AS added FROM r")


# ── pixels: an embedding is an 8 x 8 grid ────────────────────────────────────
def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The product stays in the components' own type: times a whole number, Spark would make doubles of floats.
    return I.pixels(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 8).withColumn("v", F.floor(F.col("v") * F.lit(1000).cast("float")).cast("long"))


_SQL_G = "g0 AS (SELECT vec_id AS img, unnest(embedding) AS e, unnest(range(0, len(embedding))) AS pos FROM embeddings), g AS (SELECT img, CAST(pos // 8 AS INTEGER) AS y, CAST(pos % 8 AS INTEGER) AS x, CAST(floor(e * 1000) AS BIGINT) AS v FROM g0)"
register("background_median", lambda s, d: I.background(_grid(s, d), 8, 8, 60).select("img", "bg", _r(F.col("uniform")).alias("uniform")), f"WITH {_SQL_G}, r AS (SELECT * FROM g WHERE y IN (0, 7) OR x IN (0, 7)), b AS (SELECT img, median(v) AS bg FROM r GROUP BY 1) SELECT img, any_value(bg) AS bg, {_R('avg(CASE WHEN abs(v - bg) <= 60 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)')} AS uniform FROM r JOIN b USING (img) GROUP BY img")
register("component_stats", lambda s, d: I.component_stats(_grid(s, d), F.when(F.col("v") > 0, 1).otherwise(0)).select("img", "label", "area", "x0", "y0", "x1", "y1", _r(F.col("mean")).alias("mean")), f"WITH {_SQL_G} SELECT img, CASE WHEN v > 0 THEN 1 ELSE 0 END AS label, count(*) AS area, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1, {_R('avg(v)')} AS mean FROM g GROUP BY 1, 2")
register("orientation_entropy", lambda s, d: I.orientation_entropy(_grid(s, d).select("img", F.col("x").alias("bin"), F.abs("v").alias("mag"))).select("img", _r(F.col("entropy")).alias("entropy")), f"WITH {_SQL_G}, w AS (SELECT img, x, sum(abs(v)) AS m FROM g GROUP BY 1, 2), t AS (SELECT img, sum(m) AS t FROM w GROUP BY 1) SELECT img, {_R('(-sum(m / t * ln(m / t)) / ln(8))')} AS entropy FROM w JOIN t USING (img) WHERE m > 0 GROUP BY 1")


def _chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    x, y = F.col("event_id") * 7 % 400, F.col("event_id") * 13 % 90
    return e.select(F.col("user_id").alias("img"), F.col("event_id").alias("id"), x.alias("x0"), y.alias("y0"), (x + 6 + F.col("event_id") % 5).alias("x1"), (y + 8 + F.col("event_id") % 7).alias("y1"))


_SQL_C = "c AS (SELECT user_id AS img, event_id AS id, event_id * 7 % 400 AS x0, event_id * 13 % 90 AS y0, event_id * 7 % 400 + 6 + event_id % 5 AS x1, event_id * 13 % 90 + 8 + event_id % 7 AS y1 FROM events), p AS (SELECT a.img, a.id AS a, b.id AS b FROM c a JOIN c b ON a.img = b.img AND a.id < b.id WHERE least(a.y1, b.y1) - greatest(a.y0, b.y0) >= 0.5 * least(a.y1 - a.y0, b.y1 - b.y0) AND greatest(a.x0, b.x0) - least(a.x1, b.x1) <= 1.5 * greatest(a.y1 - a.y0, b.y1 - b.y0))"
register("text_line_pairs", lambda s, d: I.line_pairs(_chars(s, d)), f"WITH {_SQL_C} SELECT img, a, b FROM p")
register("line_closure", lambda s, d: I.closure(_chars(s, d), I.line_pairs(_chars(s, d))), f"WITH RECURSIVE {_SQL_C}, e AS (SELECT img, a, b FROM p UNION ALL SELECT img, b, a FROM p), r AS (SELECT img, id, id AS line FROM c UNION SELECT e.img, e.b, r.line FROM r JOIN e ON e.img = r.img AND e.a = r.id AND r.line < e.b) SELECT img, id, min(line) AS line FROM r GROUP BY ALL")


def nms_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.suppress(_chars(spark, sf_dir).withColumn("n", F.col("id") % 10)).select("img", "id", "n")


_SQL_NMS = """, o AS (SELECT *, id % 10 AS n, row_number() OVER (PARTITION BY img ORDER BY id % 10 DESC, id) AS k, {'id': id, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1} AS b FROM c),
 r AS (SELECT DISTINCT img, CAST(0 AS BIGINT) AS k, list_filter([(SELECT any_value(b) FROM o)], lambda z: FALSE) AS kept FROM c
  UNION ALL SELECT o.img, o.k, CASE WHEN len(list_filter(r.kept, lambda z: greatest(0, least(z.x1, o.x1) - greatest(z.x0, o.x0)) * greatest(0, least(z.y1, o.y1) - greatest(z.y0, o.y0))
   > 0.5 * ((z.x1 - z.x0) * (z.y1 - z.y0) + (o.x1 - o.x0) * (o.y1 - o.y0) - greatest(0, least(z.x1, o.x1) - greatest(z.x0, o.x0)) * greatest(0, least(z.y1, o.y1) - greatest(z.y0, o.y0))))) = 0 THEN list_append(r.kept, o.b) ELSE r.kept END
  FROM r JOIN o ON o.img = r.img AND o.k = r.k + 1),
 last AS (SELECT img, unnest(kept).id AS id FROM r QUALIFY k = max(k) OVER (PARTITION BY img))"""
register("nms_lines", nms_lines, f"WITH RECURSIVE {_SQL_C}{_SQL_NMS} SELECT img, id, id % 10 AS n FROM last")


def pixel_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected components of the pixels above a level, with their area, box and mean."""
    p = _grid(spark, sf_dir)
    return I.component_stats(I.labelled(p, F.col("v") > 60, 8), F.col("label")).select("img", "label", "area", "x0", "y0", "x1", "y1", _r(F.col("mean")).alias("mean"))


register(
    "pixel_components", pixel_components,
    f"WITH RECURSIVE {_SQL_G}, f AS (SELECT *, CAST(y * 8 + x AS BIGINT) AS id FROM g WHERE v > 60), e AS (SELECT a.img, a.id AS a, b.id AS b FROM f a JOIN f b ON a.img = b.img AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND a.id <> b.id), r AS (SELECT img, id, id AS label FROM f UNION SELECT e.img, e.b, r.label FROM r JOIN e ON e.img = r.img AND e.a = r.id AND r.label < e.b), l AS (SELECT img, id, min(label) AS label FROM r GROUP BY ALL) SELECT img, label, count(*) AS area, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1, {_R('avg(v)')} AS mean FROM f JOIN l USING (img, id) GROUP BY 1, 2",
)


def chain_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.chained(_chars(spark, sf_dir))


_FITS = f"""z.x0 - cur.x1 >= {K.OVERLAP} * (cur.y1 - cur.y0) AND z.x0 - cur.x1 <= {K.GAP} * greatest(z.y1 - z.y0, cur.y1 - cur.y0)
 AND abs((z.y0 + z.y1) / 2.0 - (cur.y0 + cur.y1) / 2.0) <= {K.OFF} * greatest(z.y1 - z.y0, cur.y1 - cur.y0) AND greatest(z.y1 - z.y0, cur.y1 - cur.y0) <= {K.RATIO} * greatest(least(z.y1 - z.y0, cur.y1 - cur.y0), 1)"""
_SQL_CHAIN = f""", s AS (SELECT img, list({{'id': id, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} ORDER BY x0, id) AS free FROM c GROUP BY img),
 r AS (SELECT img, free, list_filter(free, lambda z: FALSE)[1] AS cur, CAST(NULL AS BIGINT) AS line, -1 AS pos, 0 AS k FROM s
  UNION ALL SELECT img, list_filter(free, lambda z: z.id <> coalesce(onward, free[1]).id), coalesce(onward, free[1]), CASE WHEN onward IS NULL THEN free[1].id ELSE line END, CASE WHEN onward IS NULL THEN 0 ELSE pos + 1 END, k + 1
  FROM (SELECT *, list_sort(list_transform(list_filter(free, lambda z: {_FITS}), lambda z: {{'gap': z.x0 - cur.x1, 'x0': z.x0, 'id': z.id, 'z': z}}))[1].z AS onward FROM r WHERE len(free) > 0))"""
register("chain_lines", chain_lines, f"WITH RECURSIVE {_SQL_C}{_SQL_CHAIN} SELECT img, cur.id AS id, line, pos FROM r WHERE k > 0")
