"""Small string functions: Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Punctuation that lengths, bigrams and endings leave out.
PAUSES = r"[，。、！？\s]"


def han_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^一-鿿]", ""))


def distinct_hits(text: Column, pattern: str) -> Column:
    """Distinct matches in the order in which they first occur."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def bare(text: Column) -> Column:
    return F.regexp_replace(text, PAUSES, "")


def bigrams(text: Column) -> Column:
    """All runs of two characters of bare(text)."""

    def grams(t: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.substring(t, i, F.lit(2)))
        return F.when(F.length(t) >= 2, every).otherwise(F.array().cast("array<string>"))

    # As a variable of a lambda, bare(text) is computed once, not for every bigram.
    return F.get(F.transform(F.array(bare(text)), grams), F.lit(0))


def md_escape(text: Column) -> Column:
    return F.translate(text, "|\n", "｜ ")


def parse_box(text: Column) -> Column:
    """'x,y,w,h' to struct<x,y,w,h>, rounded half to even; null unless four numbers with w, h > 0."""
    parts = F.transform(F.split(text, ","), lambda p: F.bround(F.trim(p).try_cast("double")).cast("int"))
    box = F.struct(*[F.get(parts, k).alias(n) for k, n in enumerate("xywh")])
    return F.when((F.size(parts) == 4) & F.forall(parts, lambda p: p.isNotNull()) & (F.get(parts, 2) > 0) & (F.get(parts, 3) > 0), box)


def parse_frames(spec: Column, n: Column) -> Column:
    """'all', 'first,last' or a list of indexes to a sorted array of distinct frames; null if one is out of bounds."""
    every = F.sequence(F.lit(0), n - 1)
    ends = F.array_distinct(F.array(F.lit(0), n - 1))
    listed = F.array_sort(F.array_distinct(F.transform(F.split(spec, ","), lambda p: F.trim(p).try_cast("int"))))
    good = F.forall(listed, lambda i: F.coalesce((i >= 0) & (i < n), F.lit(False)))
    return F.when(spec == "all", every).when(spec == "first,last", ends).when(good, listed)


def json_answers(text: Column, asked: list[str]) -> Column:
    """map of the asked keys whose value in the outermost {...} is a boolean."""
    body = F.from_json(F.regexp_extract(text, r"(?s)\{.*\}", 0), "map<string,string>")
    return F.map_filter(body, lambda k, v: k.isin(*asked) & v.isin("true", "false"))


def good_package(name: Column) -> Column:
    return ~name.rlike(r"[/\\:]") & ~name.isin(".", "..")


def good_prefix(name: Column) -> Column:
    return name.rlike(r"^[\p{L}\p{N}]+$")
