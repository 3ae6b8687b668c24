"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.runtime import remove, work_dir, written


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge, root the least of its component; a written table.

    edges: (u, v) in any direction, loops and repeated rows allowed.
    """
    path = work_dir(spark, "components")
    now, k, before = written(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{path}/0"), 0, None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == state or not state["n"]:
            break
        before, k = state, k + 1
        now = written(_small(_large(now)), f"{path}/{k}")
        if k > 1:
            remove(spark, f"{path}/{k - 2}")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(nodes.select(F.col("root").alias("node"), "root").distinct())
