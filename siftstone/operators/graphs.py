"""Graphs as tables of (group, a, b): components by hooking, and greedy choices in rounds.  No group is held by one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.plans.shared import written


def components(nodes: DataFrame, edges: DataFrame, by: str) -> DataFrame:
    """(by, id, root): the least id of its group that each node reaches over edges (by, a, b).

    Each round hooks every root that has a smaller neighbour to the least of
    them, follows the hooks to their ends by doubling, and contracts the edges.
    Of two neighbours one is hooked, so that at least half of the roots that
    still have edges vanish in a round.  Groups with equal ids stay apart;
    nodes without edges are their own root.
    """
    roots = nodes.select(by, "id", F.col("id").alias("root"))
    live = written(edges.filter("a != b").select(by, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while live.take(1):
        hooks = written(live.groupBy(by, F.col("a").alias("id")).agg(F.min("b").alias("to")), "hooks")
        while True:
            onward = hooks.select(by, F.col("id").alias("to"), F.col("to").alias("next"))
            step = written(hooks.join(onward, [by, "to"], "left").select(by, "id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "hooks")
            hooks = step.drop("moved")
            if not step.filter("moved").take(1):
                break
        to = lambda c: hooks.select(by, F.col("id").alias(c), F.col("to").alias(f"{c}_to"))
        moved = live.join(to("a"), [by, "a"], "left").join(to("b"), [by, "b"], "left")
        a, b = F.coalesce("a_to", "a"), F.coalesce("b_to", "b")
        live = written(moved.select(by, F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a != b").distinct(), "edges")
        roots = written(roots.join(to("root"), [by, "root"], "left").select(by, "id", F.coalesce("root_to", "root").alias("root")), "roots")
    return roots


def best_without_conflict(nodes: DataFrame, conflicts: DataFrame, by: str) -> DataFrame:
    """(by, id) of the nodes that a greedy choice keeps: from the best downwards each one that no kept one conflicts with.

    conflicts: (by, better, worse), where `better` comes first in the group's
    order.  Each round keeps the nodes that no undecided better one conflicts
    with, and drops those that conflict with a kept one; the choice is the same
    as one after the other.  There are as many rounds as the longest chain of
    conflicts whose decisions hang on one another.
    """
    open_ = written(conflicts.select(by, "better", "worse").distinct(), "conflicts")
    dropped = None
    while open_.take(1):
        waiting = open_.select(by, F.col("worse").alias("better")).distinct()
        firm = open_.join(waiting, [by, "better"], "left_anti")  # nothing undecided is better than `better`
        gone = written(firm.select(by, F.col("worse").alias("id")).distinct(), "dropped")
        dropped = gone if dropped is None else dropped.union(gone)
        left = open_.join(gone.withColumnRenamed("id", "worse"), [by, "worse"], "left_anti")
        open_ = written(left.join(gone.withColumnRenamed("id", "better"), [by, "better"], "left_anti"), "conflicts")
    kept = nodes.select(by, "id")
    return kept if dropped is None else kept.join(dropped, [by, "id"], "left_anti")


def overlapping(boxes: DataFrame, by: str, limit: float, cell: int = 64) -> DataFrame:
    """(by, better, worse) of boxes (by, id, n, x0, y0, x1, y1) whose common area is more than limit of their union; more n is better, then the smaller id.

    Boxes meet in the cells of a grid that they touch, so only near ones are compared.
    """
    cells = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor((F.col(b) - 1) / cell)))
    side = lambda k: [F.col(c).alias(f"{c}_{k}") for c in ("id", "n", "x0", "y0", "x1", "y1")]
    dealt = boxes.filter("x1 > x0 AND y1 > y0").withColumn("gx", cells("x0", "x1")).withColumn("gy", cells("y0", "y1"))
    a, b = dealt.select(by, "gx", "gy", *side("a")), dealt.select(by, "gx", "gy", *side("b"))
    width, height = F.least("x1_a", "x1_b") - F.greatest("x0_a", "x0_b"), F.least("y1_a", "y1_b") - F.greatest("y0_a", "y0_b")
    area = lambda k: (F.col(f"x1_{k}") - F.col(f"x0_{k}")) * (F.col(f"y1_{k}") - F.col(f"y0_{k}"))
    better: Column = (F.col("n_a") > F.col("n_b")) | (F.col("n_a") == F.col("n_b")) & (F.col("id_a") < F.col("id_b"))
    met = a.join(b, [by, "gx", "gy"]).filter(better & (width > 0) & (height > 0)).withColumn("common", width * height)
    return met.filter(F.col("common") > limit * (area("a") + area("b") - F.col("common"))).select(by, F.col("id_a").alias("better"), F.col("id_b").alias("worse")).distinct()
