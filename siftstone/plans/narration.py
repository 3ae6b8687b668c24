"""Lint queries: a conversation is a package, a turn a file; narration text is made from its letters, a null text is a missing file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.catalogue import register
from siftstone.functions import texts
from siftstone.operators import lint as L
from siftstone.plans.shared import table

_FROM, _TO = "abcdefghijklmnopqrstuvwxyz .,", "元的欸連結漬每次整保證最好我們便宜美白重乾去痘在五天，。、"
_TEXT = f"translate(lower(text), '{_FROM}', '{_TO}')"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("package"), (F.col("conv_id") * 1000 + F.col("turn")).alias("file"), F.expr(_TEXT).alias("text"))


_SQL = f"f AS (SELECT conv_id AS package, conv_id * 1000 + turn AS file, {_TEXT} AS text FROM conversations), s AS (SELECT package, file, string_split_regex(text, '\\r\\n|\\r|\\n') AS parts FROM f), l0 AS (SELECT package, file, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM s), l AS (SELECT package, file, line_no, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS line FROM l0 WHERE regexp_replace(line, '^\\s+|\\s+$', '', 'g') <> ''), b AS (SELECT *, regexp_replace(line, '[，。、！？\\s]', '', 'g') AS bare FROM l)"
_RULES = [(n, True, p) for n, p in L.HARD.items()] + [(n, False, p) for n, p in L.WARN.items()]
_ISSUES = ", i AS (" + " UNION ALL ".join(f"SELECT file, line_no, '{n}' AS rule, {h} AS hard, len(list_distinct(regexp_extract_all(line, '{p}'))) AS kinds FROM b WHERE regexp_matches(line, '{p}')" for n, h, p in _RULES) + " UNION ALL SELECT file, line_no, 'length', FALSE, 1 FROM b WHERE length(bare) < 3 OR length(bare) > 13)"


def _register(name: str, query: Callable[[DataFrame], DataFrame], sql: str) -> None:
    """query: of the files; sql: what follows the tables of _SQL."""
    register(name, lambda s, d: query(_files(s, d)), f"WITH {_SQL}{sql}")


def hits(files: DataFrame) -> DataFrame:
    kinds = F.when(F.col("rule") == "length", 1).otherwise(F.size(F.split("found", "」「")))
    return L.issues(L.lines_of(files)).select("file", F.col("line_no").cast("long").alias("line_no"), "rule", "hard", kinds.cast("long").alias("kinds"))


_register("lint_hits", hits, f"{_ISSUES} SELECT file, line_no, rule, hard, CAST(kinds AS BIGINT) AS kinds FROM i")


def lengths(files: DataFrame) -> DataFrame:
    line = F.col("line")
    return L.lines_of(files).select("file", F.col("line_no").cast("long").alias("line_no"), F.length(texts.bare(line)).cast("long").alias("bare"), texts.han_count(line).cast("long").alias("han"))


_register("lint_lengths", lengths, " SELECT file, line_no, length(bare) AS bare, length(regexp_replace(line, '[^一-鿿]', '', 'g')) AS han FROM b")
def _packaged(files: DataFrame) -> DataFrame:
    return L.lines_of(files).withColumn("package", F.floor(F.col("file") / 1000).cast("long"))


_register(
    "lint_bigrams",
    lambda files: L.repeated_grams(_packaged(files), files).select("package", "gram", "n"),
    f", m AS (SELECT package FROM f GROUP BY 1 HAVING count(*) > 1), g AS (SELECT package, substr(bare, CAST(k AS BIGINT), 2) AS gram FROM b SEMI JOIN m USING (package), unnest(range(1, length(bare))) t(k)) SELECT package, gram, count(*) AS n FROM g WHERE NOT regexp_matches(gram, '{L.STOP_GRAM}') GROUP BY 1, 2 HAVING count(*) >= 3",
)


def adjacent(files: DataFrame) -> DataFrame:
    lines = _packaged(files).join(L.several_files(files), "package", "left_semi")
    return L.same_endings(lines, "package", ["file", "line_no"]).select("file", F.col("line_no").cast("long").alias("line_no"), "ending")


_register("lint_adjacent", adjacent, ", m AS (SELECT package FROM f GROUP BY 1 HAVING count(*) > 1), e AS (SELECT *, substr(bare, -1) AS ending FROM b SEMI JOIN m USING (package)) SELECT file, line_no, ending FROM e QUALIFY ending <> '' AND ending = lag(ending) OVER (PARTITION BY package ORDER BY file, line_no)")


def summary(files: DataFrame) -> DataFrame:
    return L.summary(files, L.issues(L.lines_of(files))).withColumn("seconds", F.floor(F.col("seconds") * 10 + 0.5).cast("long"))


_register("lint_summary", summary, f"{_ISSUES}, h AS (SELECT package, count(*) AS hard FROM i JOIN f USING (file) WHERE hard GROUP BY 1), n AS (SELECT package, count(*) AS files, count(*) FILTER (text IS NULL) AS missing FROM f GROUP BY 1) SELECT package, files, coalesce(hard, 0) + missing AS hard, CAST(files * 36 AS BIGINT) AS seconds, files * 3.6 < 15 AS too_short FROM n LEFT JOIN h USING (package)")
