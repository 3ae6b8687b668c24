"""Title queries: part names dressed with brackets, promotions and capacities, which the cleaner takes off again."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.catalogue import register
from siftstone.functions.titles import strip_title
from siftstone.plans.screening import RULES
from siftstone.plans.shared import spread, table

TITLE_RULES = replace(RULES, promo_words=("現貨", "買一送一"), capacity_pattern=r"\d+(ml|g|入)")


def strip_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    dressed = F.concat(F.lit("【買一送一】"), "p_name", F.lit("　（red 特）現貨 "), F.col("p_size").cast("string"), F.lit("ml"))
    t = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")).select("p_partkey", strip_title(dressed, TITLE_RULES).alias("t"))
    return t.select("p_partkey", "t.name", F.size("t.removed").cast("long").alias("removed"))


register("strip_titles", strip_titles, "SELECT p_partkey, concat(p_name, ' red') AS name, CAST(4 AS BIGINT) AS removed FROM part")


def strip_titles_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of six kinds: nested brackets, brands and flavours in brackets, wide letters, repeated promotions, none."""
    k, name, size = F.col("p_partkey") % 6, F.col("p_name"), F.col("p_size").cast("string")
    kinds = (
        F.concat(F.lit("【限時[買一送一]】"), name, F.lit("(")), F.concat(F.lit("[Brand#12 官方]"), name, F.lit(" ３００ml")), F.concat(name, F.lit("（blue、red）現貨現貨")),
        F.concat(F.lit("((x)) ｂｉｇ "), name, F.lit(" "), size, F.lit("g|")), F.concat(F.lit("《"), name, F.lit("》「a」 ガ")), F.concat(F.lit("- "), name, F.lit(" ，")),
    )
    title = F.coalesce(*[F.when(k == i, c) for i, c in enumerate(kinds)])
    t = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")).select("p_partkey", strip_title(title, TITLE_RULES).alias("t"))
    return t.select("p_partkey", "t.name", F.array_join("t.removed", "¦").alias("removed"))


register(
    "strip_titles_mixed", strip_titles_mixed,
    """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN concat('', p_name) WHEN 1 THEN concat('Brand#1 ', p_name) WHEN 2 THEN concat(p_name, ' blue red') WHEN 3 THEN concat('big ', p_name) WHEN 4 THEN concat(p_name, ' a ガ') ELSE p_name END AS name,
 CASE p_partkey % 6 WHEN 0 THEN '【限時[買一送一]】' WHEN 1 THEN '300ml' WHEN 2 THEN '(blue、red)¦現貨' WHEN 3 THEN concat('(x)¦', p_size, 'g') ELSE '' END AS removed FROM part""",
)
