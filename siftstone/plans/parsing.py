"""Parser queries: lineitem and part rows written out as the texts that offers come with."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.catalogue import register
from siftstone.functions import parse, texts
from siftstone.plans.shared import spread, table

#: Texts made from integers; the expressions mean the same to both engines.
MONTHLY = """CASE l_linenumber WHEN 1 THEN concat(cast(cast(l_quantity as int) as string), '萬+') WHEN 2 THEN concat('已售 ', cast(cast(l_quantity as int) as string), ',500+')
 WHEN 3 THEN concat(cast(cast(l_quantity as int) as string), '.5k sold') WHEN 4 THEN '' WHEN 5 THEN '洽詢' WHEN 6 THEN concat('月銷', cast(cast(l_quantity as int) as string), '千件')
 ELSE concat('　', cast(cast(l_quantity as int) * 100 as string), ' ') END"""
PRICE = """CASE WHEN l_linenumber = 2 AND l_quantity < 5 THEN '洽詢' WHEN l_linenumber = 3 AND l_quantity < 5 THEN '' WHEN l_linenumber = 4 THEN concat('NT$', cast(l_partkey % 900 as string), ',250')
 WHEN l_linenumber = 5 THEN concat('$', cast(l_partkey % 900 as string), ' - $999') WHEN l_linenumber = 6 THEN concat(cast(l_partkey % 900 as string), '.75元') ELSE concat('＄', cast(l_partkey % 900 + 10 as string)) END"""
RATE = """CASE WHEN l_linenumber = 1 AND l_quantity < 10 THEN '10.5' WHEN l_linenumber = 2 AND l_quantity < 10 THEN '' ELSE concat(cast(cast(round(l_discount * 100) as int) as string), '.5%') END"""
SV = """CASE WHEN l_returnflag = 'N' THEN '' WHEN l_linenumber = 7 AND l_quantity < 10 THEN 'abc' ELSE concat(cast(cast(round(l_tax * 100) as int) as string), ' %') END"""
SVB = """CASE WHEN l_linestatus = 'O' THEN '' WHEN l_linenumber = 1 AND l_quantity > 45 THEN 'xyz' ELSE '2.25%' END"""
STORES = """CASE WHEN l_suppkey % 5 = 0 THEN '' WHEN l_suppkey % 5 = 1 THEN concat(cast(l_suppkey % 7 as string), '家') WHEN l_suppkey % 5 = 2 THEN 'many' ELSE cast(l_suppkey % 11 as string) END"""
DATE = """CASE l_linenumber WHEN 1 THEN concat(cast(year(l_shipdate) as string), '/', cast(month(l_shipdate) as string), '/', cast(day(l_shipdate) as string))
 WHEN 2 THEN concat(cast(year(l_shipdate) as string), '-', cast(month(l_shipdate) as string), '-31') WHEN 3 THEN '' WHEN 4 THEN 'soon' WHEN 5 THEN concat(cast(year(l_shipdate) as string), '.', cast(month(l_shipdate) as string), '.1')
 ELSE concat(cast(year(l_shipdate) as string), '/', cast(month(l_shipdate) as string), '/', cast(day(l_shipdate) as string)) END"""

_NARROW = "trim(translate({}, '＄　', '$ '))"


def sql_number(text: str, pattern: str, unit: str = "1", plus: str = "FALSE") -> str:
    """DuckDB: struct of value, plus and state of a text."""
    t = _NARROW.format(text)
    value = f"CAST(CAST(replace(regexp_extract({t}, '{pattern}', 1), ',', '') AS DECIMAL(20,6)) * {unit} AS DECIMAL(20,6))"
    return f"CASE WHEN {t} = '' THEN {{'value': NULL::DECIMAL(20,6), 'plus': FALSE, 'state': 'blank'}} WHEN regexp_matches({t}, '{pattern}') THEN {{'value': {value}, 'plus': {plus.format(t=t)}, 'state': 'value'}} ELSE {{'value': NULL::DECIMAL(20,6), 'plus': FALSE, 'state': 'unreadable'}} END"


_COUNT = r"(?i)^(?:已售|月銷)?\s*(\d[\d,]*(?:\.\d+)?)\s*(萬|万|千|k)?\s*(\+)?\s*(?:sold|已售|件)?$"
_COUNT_UNIT = f"CASE lower(regexp_extract({_NARROW.format('raw')}, '{_COUNT}', 2)) WHEN '萬' THEN 10000 WHEN '万' THEN 10000 WHEN '千' THEN 1000 WHEN 'k' THEN 1000 ELSE 1 END"
SQL_COUNT = lambda raw: sql_number(raw, _COUNT, _COUNT_UNIT.replace("raw", raw, 99), f"regexp_extract({{t}}, '{_COUNT}', 3) = '+'")
SQL_PRICE = lambda raw: sql_number(raw, r"(?i)^(?:NT\$|NT|\$)?\s*(\d[\d,]*(?:\.\d+)?)\s*(?:元)?$")
SQL_RATE = lambda raw: sql_number(raw, r"^(\d+(?:\.\d+)?)\s*%$")
SQL_STORES = lambda raw: sql_number(raw, r"^(\d+)\s*(?:家)?$")
SQL_DATE = lambda raw: f"CASE WHEN regexp_matches({raw}, '^\\d{{4}}[/.-]\\d{{1,2}}[/.-]\\d{{1,2}}$') THEN TRY_CAST(regexp_replace(replace(replace({raw}, '/', '-'), '.', '-'), '^$', '') AS DATE) END"


def _parsed(expression: str, parser):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Texts repeat, so each distinct one is parsed once, after the aggregate.
        raw = table(spark, sf_dir, "lineitem").groupBy(F.expr(expression).alias("raw")).agg(F.count("*").alias("n"))
        p = raw.select("raw", parser(F.col("raw")).alias("p"), "n")
        return p.select("raw", F.col("p.value").alias("value"), F.col("p.plus").alias("plus"), parse.state(F.col("p")).alias("state"), "n")

    return query


def _parsed_sql(expression: str, number) -> str:
    return f"WITH r AS (SELECT {expression} AS raw FROM lineitem), p AS (SELECT raw, {number('raw')} AS p FROM r) SELECT raw, p.value AS value, p.plus AS plus, p.state AS state, count(*) AS n FROM p GROUP BY ALL"


for _name, _text, _parser, _sql in (
    ("parse_counts", MONTHLY, parse.parse_count, SQL_COUNT), ("parse_prices", PRICE, parse.parse_price, SQL_PRICE),
    ("parse_rates", RATE, parse.parse_rate, SQL_RATE), ("parse_stores", STORES, parse.parse_stores, SQL_STORES),
):
    register(_name, _parsed(_text, _parser), _parsed_sql(_text, _sql))


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem").select(F.expr(DATE).alias("raw")).groupBy("raw").agg(F.count("*").alias("n"))
    p = raw.select("raw", "n", parse.parse_date(F.col("raw")).alias("p"))
    return p.select("raw", F.col("p.value").cast("string").alias("day"), F.col("p.ok").alias("readable"), "n")


register("parse_dates", parse_dates, f"WITH r AS (SELECT {DATE} AS raw, count(*) AS n FROM lineitem GROUP BY 1) SELECT raw, CAST({SQL_DATE('raw')} AS VARCHAR) AS day, raw = '' OR ({SQL_DATE('raw')}) IS NOT NULL AS readable, n FROM r")


def number_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"monthly": (MONTHLY, parse.parse_count), "price": (PRICE, parse.parse_price), "rate": (RATE, parse.parse_rate), "sv": (SV, parse.parse_rate), "sv_bonus": (SVB, parse.parse_rate)}
    raws = F.array(*[F.struct(F.lit(name).alias("field"), F.expr(raw).alias("raw")) for name, (raw, _) in fields.items()])
    seen = table(spark, sf_dir, "lineitem").select(F.explode(raws).alias("r")).groupBy("r.field", "r.raw").agg(F.count("*").alias("n"))
    parts = [seen.filter(F.col("field") == name).select("field", parse.state(p(F.col("raw"))).alias("state"), "n") for name, (_, p) in fields.items()]
    return reduce(DataFrame.union, parts).groupBy("field", "state").agg(F.sum("n").alias("n"))


register(
    "number_state", number_state,
    "SELECT field, state, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{name}' AS field, ({sql('raw')}).state AS state FROM (SELECT {raw} AS raw FROM lineitem)" for name, raw, sql in (("monthly", MONTHLY, SQL_COUNT), ("price", PRICE, SQL_PRICE), ("rate", RATE, SQL_RATE), ("sv", SV, SQL_RATE), ("sv_bonus", SVB, SQL_RATE))) + ") GROUP BY ALL",
)

_URL = "CASE l_linenumber % 4 WHEN 0 THEN concat('https://x.example/product/', cast(l_suppkey as string), '/', cast(l_partkey as string)) WHEN 1 THEN concat('https://x.example/name-i.', cast(l_suppkey as string), '.', cast(l_partkey as string), '?a=1') WHEN 2 THEN concat('https://x.example/p?shopid=', cast(l_suppkey as string), '&z=1&itemid=', cast(l_partkey as string)) ELSE 'https://x.example/about' END"


def url_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = table(spark, sf_dir, "lineitem").select(F.expr(_URL).alias("url"))
    return u.select(parse.ids_from_url(F.col("url")).alias("i")).groupBy("i.shop", "i.item").agg(F.count("*").alias("n"))


register("url_ids", url_ids, f"WITH u AS (SELECT {_URL} AS url, l_suppkey, l_partkey, l_linenumber AS k FROM lineitem) SELECT CASE WHEN k % 4 < 3 THEN CAST(l_suppkey AS VARCHAR) END AS shop, CASE WHEN k % 4 < 3 THEN CAST(l_partkey AS VARCHAR) END AS item, count(*) AS n FROM u GROUP BY ALL")


def page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    return table(spark, sf_dir, "pages").groupBy(host.alias("host")).agg(F.count("*").alias("n"), F.max(F.length("url")).cast("long").alias("longest"))


register("page_hosts", page_hosts, "SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, count(*) AS n, CAST(max(length(url)) AS BIGINT) AS longest FROM pages GROUP BY 1")


def fmt_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", (F.round(F.col("p_retailprice") * 100).cast("long") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(20,6)").alias("v"))
    return p.select("p_partkey", parse.show(F.col("v")).alias("shown"))


register("fmt_decimal", fmt_decimal, "WITH c AS (SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS c FROM part) SELECT p_partkey, CASE WHEN c % 100 = 0 THEN CAST(c // 100 AS VARCHAR) WHEN c % 10 = 0 THEN concat(c // 100, '.', c % 100 // 10) ELSE concat(c // 100, '.', lpad(CAST(c % 100 AS VARCHAR), 2, '0')) END AS shown FROM c")


def per_order_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*[F.expr(e).alias(n) for n, e in (("price", PRICE), ("rate", RATE), ("sv", SV), ("svb", SVB))])
    pay = parse.per_order(parse.parse_price(F.col("price")), parse.parse_rate(F.col("rate")), parse.parse_rate(F.col("sv")), parse.parse_rate(F.col("svb")))
    # Each combination of texts is parsed once.
    texts_ = spread(li.groupBy("price", "rate", "sv", "svb").agg(F.count("*").alias("n")))
    return texts_.withColumn("p", pay).select("price", "rate", "sv", "svb", F.col("p.value").alias("value"), F.col("p.kind").alias("kind"), "n")


PAY_SQL = """CASE WHEN c.value IS NULL THEN NULL WHEN s.value IS NOT NULL AND b.state <> 'unreadable' THEN CAST(round(c.value * CAST(s.value + coalesce(b.value, 0) AS DECIMAL(14,6)), 0) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))
 WHEN r.value IS NOT NULL THEN CAST(round(c.value * CAST(r.value AS DECIMAL(14,6)), 0) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) END"""
KIND_SQL = "CASE WHEN c.value IS NULL THEN NULL WHEN s.value IS NOT NULL AND b.state <> 'unreadable' THEN 'real' WHEN r.value IS NOT NULL THEN 'estimate' END"
register(
    "per_order_half_up", per_order_half_up,
    f"WITH t AS (SELECT {PRICE} AS price, {RATE} AS rate, {SV} AS sv, {SVB} AS svb FROM lineitem), p AS (SELECT price, rate, sv, svb, {SQL_PRICE('price')} AS c, {SQL_RATE('rate')} AS r, {SQL_RATE('sv')} AS s, {SQL_RATE('svb')} AS b FROM t) SELECT price, rate, sv, svb, {PAY_SQL} AS value, {KIND_SQL} AS kind, count(*) AS n FROM p GROUP BY ALL",
)


def truthy_bonus(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("CASE l_linenumber WHEN 1 THEN '是' WHEN 2 THEN 'yes' WHEN 3 THEN 'YES' WHEN 4 THEN '１' WHEN 5 THEN '' WHEN 6 THEN ' true ' ELSE 'no' END")
    return table(spark, sf_dir, "lineitem").select(text.alias("bonus")).groupBy("bonus").agg(F.count("*").alias("n")).select("bonus", parse.is_true(F.col("bonus")).alias("yes"), "n")


register("truthy_bonus", truthy_bonus, "SELECT bonus, trim(translate(bonus, '１', '1')) IN ('是','有','Y','y','yes','Yes','TRUE','true','1') AS yes, count(*) AS n FROM (SELECT CASE l_linenumber WHEN 1 THEN '是' WHEN 2 THEN 'yes' WHEN 3 THEN 'YES' WHEN 4 THEN '１' WHEN 5 THEN '' WHEN 6 THEN ' true ' ELSE 'no' END AS bonus FROM lineitem) GROUP BY ALL")


def parse_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("CASE p_size % 4 WHEN 0 THEN concat(cast(p_partkey as string), ',', cast(p_size as string), '.5, 10,20') WHEN 1 THEN concat(cast(p_size as string), ',1,0,5') WHEN 2 THEN 'a,b,c,d' ELSE concat('1,2,', cast(p_size as string), ',4') END")
    p = table(spark, sf_dir, "part").select("p_partkey", texts.parse_box(text).alias("b"))
    return p.select("p_partkey", "b.x", "b.y", "b.w", "b.h")


register("parse_boxes", parse_boxes, "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN CAST(p_partkey AS INT) WHEN 3 THEN 1 END AS x, CASE p_size % 4 WHEN 0 THEN p_size + p_size % 2 WHEN 3 THEN 2 END AS y, CASE p_size % 4 WHEN 0 THEN 10 WHEN 3 THEN p_size END AS w, CASE p_size % 4 WHEN 0 THEN 20 WHEN 3 THEN 4 END AS h FROM part")


def frames_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = F.expr("CASE p_size % 4 WHEN 0 THEN 'all' WHEN 1 THEN 'first,last' WHEN 2 THEN concat(cast(p_size as string), ', 0,', cast(p_size as string)) ELSE '99,1' END")
    p = table(spark, sf_dir, "part").select("p_partkey", texts.parse_frames(spec, F.col("p_size") + 1).alias("f"))
    return p.select("p_partkey", F.size("f").cast("long").alias("frames"), F.aggregate("f", F.lit(0), lambda a, x: a + x).cast("long").alias("total"))


register("frames_spec", frames_spec, "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_size + 1 WHEN 1 THEN 2 WHEN 2 THEN 2 END::BIGINT AS frames, CASE p_size % 4 WHEN 0 THEN p_size * (p_size + 1) // 2 WHEN 1 THEN p_size WHEN 2 THEN p_size END::BIGINT AS total FROM part")


def json_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.lit('So: {"front": '), F.expr("CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE '5' END"), F.lit(', "other": true, "text": false} ok'))
    found = texts.json_answers(said, ["front", "text"])
    e = table(spark, sf_dir, "events").select("event_type", F.element_at(found, F.lit("front")).alias("front"), F.size(found).alias("answers"))
    return e.groupBy("event_type", "front", "answers").agg(F.count("*").alias("n"))


register("json_answers", json_answers, "SELECT event_type, CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS front, CASE WHEN event_id % 3 = 2 THEN 1 ELSE 2 END AS answers, count(*) AS n FROM events GROUP BY ALL")


def name_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.expr("CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN 'a/b' WHEN 2 THEN '..' WHEN 3 THEN 'É9' ELSE 'x y' END").alias("name"))
    return c.groupBy("name").agg(F.count("*").alias("n")).select("name", texts.good_package(F.col("name")).alias("package"), texts.good_prefix(F.col("name")).alias("prefix"), texts.md_escape(F.concat("name", F.lit("|\n"))).alias("cell"), "n")


register("name_checks", name_checks, r"SELECT name, NOT regexp_matches(name, '[/\\:]') AND name NOT IN ('.', '..') AS package, regexp_matches(name, '^[\p{L}\p{N}]+$') AS prefix, concat(name, '｜ ') AS cell, count(*) AS n FROM (SELECT CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN 'a/b' WHEN 2 THEN '..' WHEN 3 THEN 'É9' ELSE 'x y' END AS name FROM customer) GROUP BY ALL")


def nfkc_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-width texts normalised by the Arrow function; the characters used have the same NFKC form everywhere."""
    wide = F.translate("p_name", "abcdefghijklmnopqrstuvwxyz ", "ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ　")
    return table(spark, sf_dir, "part").select("p_partkey", parse.nfkc(F.concat(F.lit(" "), wide)).alias("title"))


register("nfkc_titles", nfkc_titles, "SELECT p_partkey, p_name AS title FROM part")
