"""Dictionaries as tables: which keys of a table of any size occur where in texts.

Texts are cut at each place into pieces of a few lengths, the *levels*; a key
is looked up by its first characters, as many as the largest level that it
has, by an equality join, and what is left of it is compared.  So the plan does
not grow with the dictionary, no text is held against each key, and a text of n
characters makes at most n * MOST_LEVELS rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.plans.shared import written

#: Lengths at which texts are cut, and characters of a text that are cut at once.
MOST_LEVELS, WINDOW = 12, 512
#: Dictionaries of the driver up to this many rows are sent to all tasks; longer ones are written as a table first.
SMALL = 1000


def dictionary(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of rows that the driver has read from a rule file."""
    df = spark.createDataFrame(list(rows), schema)
    return F.broadcast(df) if len(rows) <= SMALL else written(df, "dictionary")


def levels_of(lengths: Sequence[int]) -> list[int]:
    """At most MOST_LEVELS of the lengths, the least among them, at about equal ratios."""
    lengths = sorted({n for n in lengths if n > 0})
    if len(lengths) <= MOST_LEVELS:
        return lengths
    ratio = (lengths[-1] / lengths[0]) ** (1 / MOST_LEVELS)
    return sorted({max(n for n in lengths if n <= lengths[0] * ratio**k + 1e-9) for k in range(MOST_LEVELS)})


def occurrences(rows: DataFrame, by: list[str], text: str, entries: DataFrame, key: str, lengths: Sequence[int] | None = None, on: Sequence[str] = ()) -> DataFrame:
    """by, pos (from 1) and the entry's columns, for each place of rows' text at which an entry's key begins.

    by: columns of rows that tell its rows apart; they and the entries' columns
    have different names.  Null and empty texts and keys occur nowhere.
    lengths: those of the keys, if they are known.  on: columns among `by` that
    the entries have too and that must be equal.
    """
    if lengths is None:
        lengths = [r[0] for r in entries.select(F.length(key)).distinct().collect() if r[0]]
    levels = levels_of(lengths)
    if not levels:
        return rows.select(*by, F.lit(1).alias("pos")).join(entries.drop(*on), F.lit(False))
    longest = max(lengths)
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(WINDOW))
    windows = rows.filter(F.length(text) > 0).select(*by, F.explode(F.transform(starts, lambda s: F.struct(s.alias("s"), F.substring(text, s + 1, F.lit(WINDOW + longest - 1)).alias("w")))).alias("__w"))
    places = windows.select(*by, "__w", F.explode(F.sequence(F.lit(1), F.least(F.length("__w.w"), F.lit(WINDOW)))).alias("__at"))
    # A place takes along what a key could cover, not its whole window.
    places = places.select(*by, (F.col("__w.s") + F.col("__at")).alias("pos"), F.substring(F.col("__w.w"), F.col("__at"), F.lit(longest)).alias("__rest"))
    # At the end of a text the pieces of larger levels would be cut short and equal to one another: these are no pieces.
    whole = F.filter(F.lit(levels), lambda n: n <= F.length("__rest"))
    pieces = places.select("*", F.explode(whole).alias("__n")).withColumn("__piece", F.substring(F.col("__rest"), F.lit(1), F.col("__n")))
    level = F.array_max(F.filter(F.lit(levels), lambda n: n <= F.length(key)))
    known = entries.filter(F.length(key) > 0).withColumn("__piece", F.substring(F.col(key), F.lit(1), level))
    # Only dictionary() sends entries to all tasks: a table that grows with the data would pass through the driver whole.
    met = pieces.hint("merge").join(known, ["__piece", *on]).filter(F.substring(F.col("__rest"), F.lit(1), F.length(key)) == F.col(key))
    return met.select(*by, "pos", *[c for c in entries.columns if c not in on])


def earliest_longest(found: DataFrame, by: list[str], key: str, *more: str) -> DataFrame:
    """by, hit struct<pos, neg_len, key, more>: of occurrences() that which begins first, then the longest."""
    columns = F.struct("pos", (-F.length(key)).alias("neg_len"), F.col(key).alias("key"), *more)
    return found.groupBy(*by).agg(F.min(columns).alias("hit"))
