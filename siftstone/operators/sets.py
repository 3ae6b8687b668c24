"""Set operations over sources and words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_sources(sources: dict[str, DataFrame], label: str = "source") -> DataFrame:
    """Rows of several sources by column name, absent columns null, with the name of their source."""
    named = [df.withColumn(label, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def per_source(rows: DataFrame, label: str, *more: Column) -> DataFrame:
    """Rows of each source, and more aggregates."""
    return rows.groupBy(label).agg(F.count("*").alias("rows"), *more)


def unknown(names: DataFrame, known: DataFrame, name: str, as_name: str | None = None) -> DataFrame:
    """The rows whose name is not among the known ones (column as_name); a null name is unknown."""
    other = known.select(F.col(as_name or name).alias("__known"))
    return names.join(other, names[name] == other["__known"], "left_anti")


def shared_and_own(a: Column, b: Column, separator: str = ",") -> dict[str, Column]:
    """Two word sets: the words of both, and those of the first alone, sorted and joined."""
    return {"both": F.array_join(F.array_sort(F.array_intersect(a, b)), separator), "own": F.array_join(F.array_sort(F.array_except(a, b)), separator)}
