"""Secret scans: base patterns plus windows of high Shannon entropy, DataFrame functions only.

Three base kinds are found by pattern, leftmost and non-overlapping per kind.
To these the scan adds spans of *candidate strings*: maximal runs of
`[A-Za-z0-9+/_=-]` of WINDOW characters or more that hold a digit.  A window
slides over each candidate; its character counts, and with them the sum of
c*log2(c), change by the one character that enters and the one that leaves,
so a step costs the same at any window length.  A candidate's class is hex
(only hex digits), lower (a-z and digits only) or mixed; windows whose entropy
reaches the class's threshold are merged to spans.  Allow-listed candidates
(plain words with hyphens, dates, UUIDs, paths, ...) and spans inside a base
span add nothing.

Defined results: a null or empty text has no spans; rows are independent, so
repeated rows give repeated results and an empty table an empty one; spans that
begin at one place are in the order of KINDS; a text may be of any length that
fits a task and hold any number of hits, the time grows in proportion to both;
extra columns, of any name, are not read and stay.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.runtime import fresh_name, table

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"
#: Bits per character that a window of the class must reach.
THRESHOLDS = {"hex": 3.0, "lower": 3.55, "mixed": 3.65}
#: Candidates that match one of these wholly are no secrets.
ALLOW = (
    r"[0-9]+([_=+/-][0-9]+)*",  # numbers, dates, phone numbers
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUIDs
    r"[A-Za-z]+([_/-]+[A-Za-z]+)*[_/-]*[0-9]{0,4}",  # words and paths with a short number at the end
    r"/?([a-z]{1,12}/)+[a-z0-9_-]*",  # paths
    r"(.)\1*",  # one character again and again
)

_SPAN = "struct<start:int,rank:int,end:int>"
#: Steps whose results are appended one by one; lists of so many are then put together.
_CHUNK = 128
#: Window starts of a piece of a candidate, and the character that stands for a count of zero.
_PIECE, _ZERO = 512, 64
#: Spans up to which a text is cut by substring, which looks from the text's begin.
_FEW = 32


def _scan(steps: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """struct<pos, out>: step(pos, x) gives the next pos and a list of results for each x in turn; out is all of them."""
    none = F.array().cast(f"array<{kind}>")

    def one(acc: Column, x: Column) -> Column:
        pos, out = step(acc["pos"], x)
        return F.struct(pos.alias("pos"), F.concat(acc["out"], out).alias("out"))

    def some(acc: Column, chunk: Column) -> Column:
        inner = F.aggregate(F.slice(chunk["steps"], chunk["at"], F.lit(_CHUNK)), F.struct(acc["pos"].alias("pos"), none.alias("out")), one)
        return F.element_at(F.transform(F.array(inner), lambda r: F.struct(r["pos"].alias("pos"), F.concat(acc["out"], F.array(r["out"])).alias("out"))), 1)

    bound = lambda xs: F.transform(F.sequence(F.lit(1), F.greatest(F.size(xs), F.lit(1)), F.lit(_CHUNK)), lambda k: F.struct(xs.alias("steps"), k.alias("at")))
    chunks = F.flatten(F.transform(F.array(steps), bound))
    return F.aggregate(chunks, F.struct(start.alias("pos"), F.array().cast(f"array<array<{kind}>>").alias("out")), some, lambda acc: F.struct(acc["pos"].alias("pos"), F.flatten(acc["out"]).alias("out")))


def _spans(text: Column, pattern: str, rank: int, least: int) -> Column:
    """Spans of the matches of pattern whose checked part has at least `least` characters.

    split() gives what lies between the matches that regexp_extract_all()
    gives, so running sums of lengths are the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if least else found
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), checked.alias("part"))

    none = F.array().cast(f"array<{_SPAN}>")

    def step(pos: Column, x: Column) -> tuple[Column, Column]:
        start = pos + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        return end, F.when(x["hit"].isNotNull() & (F.length(x["part"]) >= least), F.array(span)).otherwise(none)

    return F.when(text.rlike(pattern), _scan(steps, F.lit(0), step, _SPAN)["out"]).otherwise(none)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _hot_starts(piece: Column, most: Column, width: int) -> Column:
    """A '1' or '0' for each window of a piece of a candidate: whether its sum of c*log2(c) is `most` at most.

    Counts by character code are one text, a character for each count, so that
    a step replaces a character instead of rebuilding an array.
    """
    codes = F.transform(F.split(piece, ""), lambda c: F.ascii(c))
    # A character enters before one leaves, so a count may be width + 1.
    weight = [c * log2(c) if c else 0.0 for c in range(width + 2)]
    more = F.array(*[F.lit(weight[c + 1] - weight[c]) for c in range(width + 1)])  # from c to c + 1
    shown = F.array(*[F.lit(chr(_ZERO + c)) for c in range(width + 2)])
    count = lambda counts, code: F.ascii(F.substring(counts, code + 1, F.lit(1))) - _ZERO
    with_count = lambda counts, code, n: F.overlay(counts, F.get(shown, n), code + 1, F.lit(1))

    def enter(acc: Column, x: Column) -> Column:
        return _bound(count(acc["counts"], x["new"]), lambda n: F.struct(with_count(acc["counts"], x["new"], n + 1).alias("counts"), (acc["sum"] + F.get(more, n)).alias("sum")))

    def leave(now: Column, code: Column) -> Column:
        return _bound(count(now["counts"], code), lambda n: F.struct(with_count(now["counts"], code, n - 1).alias("counts"), (now["sum"] - F.get(more, n - 1)).alias("sum")))

    def step(acc: Column, x: Column) -> Column:
        after = _bound(enter(acc, x), lambda now: F.when(x["old"].isNull(), now).otherwise(leave(now, x["old"])))
        i = acc["i"] + 1

        def noted(now: Column) -> Column:
            flag = F.when(i < width, "").when(now["sum"] <= acc["most"], "1").otherwise("0")
            return F.struct(now["counts"].alias("counts"), now["sum"].alias("sum"), i.alias("i"), F.concat(acc["flags"], flag).alias("flags"), acc["most"].alias("most"))

        return _bound(after, noted)

    pairs = _bound(codes, lambda c: F.arrays_zip(c.alias("new"), F.concat(F.array_repeat(F.lit(None).cast("int"), width), F.slice(c, F.lit(1), F.greatest(F.size(c) - width, F.lit(0)))).alias("old")))
    zero = F.struct(F.lit(chr(_ZERO) * 128).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("i"), F.lit("").alias("flags"), most.alias("most"))
    return F.aggregate(pairs, zero, step, lambda acc: acc["flags"])


def hot_windows(candidate: Column, threshold: Column, width: int = WINDOW) -> Column:
    """array<struct<start,end>>: merged windows of `width` characters (ASCII) with entropy >= threshold, 0-based.

    The candidate is cut into pieces of _PIECE window starts, each with the
    characters that its last windows reach into, so time and memory of a step
    do not depend on the candidate's length.
    """
    if width > 60:
        raise ValueError("a window has 60 characters at most")
    # A window of n characters has entropy log2(n) - sum(c*log2 c)/n, so the sum has an upper bound.
    most = (F.log2(F.lit(float(width))) - threshold) * width + 1e-9
    cut = f"(?s)(.{{1,{_PIECE}}})(?=(.{{0,{width - 1}}}))"
    parts = lambda group: F.regexp_extract_all(candidate, F.lit(cut), F.lit(group))
    pieces = F.zip_with(parts(1), parts(2), lambda a, b: F.concat(a, b))
    flags = _bound(most, lambda m: F.array_join(F.transform(pieces, lambda p: _hot_starts(p, m, width)), ""))
    # Windows that start at most `width` apart are one span: spans are parted by so many cold starts.
    apart = f"0{{{width},}}"

    def spans(text: Column) -> Column:
        steps = F.arrays_zip(F.split(text, apart, -1).alias("part"), F.regexp_extract_all(text, F.lit(apart), F.lit(0)).alias("gap"))
        none = F.array().cast("array<struct<start:int,end:int>>")

        def step(pos: Column, x: Column) -> tuple[Column, Column]:
            first, last = F.length(x["part"]) - F.length(F.ltrim(x["part"], F.lit("0"))), F.length(F.rtrim(x["part"], F.lit("0")))
            span = F.array(F.struct((pos + first).alias("start"), (pos + last - 1 + width).alias("end")))
            return pos + F.length(x["part"]) + F.coalesce(F.length(x["gap"]), F.lit(0)), F.when(F.contains(x["part"], F.lit("1")), span).otherwise(none)

        return _scan(steps, F.lit(0), step, "struct<start:int,end:int>")["out"]

    return _bound(flags, spans)


def _entropy_spans(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    steps = F.arrays_zip(F.split(text, CANDIDATE, -1).alias("gap"), found.alias("hit"))

    none = F.array().cast(f"array<{_SPAN}>")

    def step(pos: Column, x: Column) -> tuple[Column, Column]:
        hit = x["hit"]
        start = pos + F.length(x["gap"])
        threshold = F.when(hit.rlike("^[0-9a-fA-F]+$"), THRESHOLDS["hex"]).when(hit.rlike("^[a-z0-9]+$"), THRESHOLDS["lower"]).otherwise(THRESHOLDS["mixed"])
        allowed = hit.rlike("^(?:" + "|".join(f"(?:{a})" for a in ALLOW[:-1]) + ")$") | hit.rlike(f"^{ALLOW[-1]}$")
        spans = F.transform(hot_windows(hit, threshold), lambda s: F.struct((start + s["start"]).alias("start"), F.lit(3).alias("rank"), (start + s["end"]).alias("end")))
        return start + F.coalesce(F.length(hit), F.lit(0)), F.when(hit.isNotNull() & ~allowed, spans).otherwise(none)

    return F.when(text.rlike(CANDIDATE), _scan(steps, F.lit(0), step, _SPAN)["out"]).otherwise(none)


def _outside(added: Column, base: Column) -> Column:
    """The spans of added, in order, that lie in none of base: in one sweep over both, by the farthest end so far."""
    both = F.array_sort(F.concat(F.transform(base, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("own"), s["rank"].alias("rank"), s["end"].alias("end"))), F.transform(added, lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("own"), s["rank"].alias("rank"), s["end"].alias("end")))))
    none = F.array().cast(f"array<{_SPAN}>")

    def step(cover: Column, s: Column) -> tuple[Column, Column]:
        free = (s["own"] == 1) & (s["end"] > cover)
        return F.when(s["own"] == 0, F.greatest(cover, s["end"])).otherwise(cover), F.when(free, F.array(F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))).otherwise(none)

    return F.when((F.size(added) == 0) | (F.size(base) == 0), added).otherwise(_scan(both, F.lit(-1), step, _SPAN)["out"])


def scan_secrets(df: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """df with a last column `out`: struct<base, added>, arrays of struct<start,rank,end> in code points.

    rank is the index in KINDS; both arrays are sorted by start, then rank.  df has no column `out` before.
    """
    if out.lower() in map(str.lower, df.columns):
        raise ValueError(f"there is a column {out} already")
    t = F.coalesce(F.col(text), F.lit(""))
    base = F.array_sort(F.concat(_spans(t, ASSIGN, 0, 6), _spans(t, ACCESS, 1, 0), _spans(t, HEX, 2, 0)))
    step = df.withColumn(out, F.struct(base.alias("base"), _entropy_spans(t).alias("added")))
    return step.withColumn(out, F.struct(F.col(out)["base"].alias("base"), _outside(F.col(out)["added"], F.col(out)["base"]).alias("added")))


def _shown(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat(F.element_at(kinds, s["rank"] + 1), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text: str = "text", mark: str = "[REDACTED]", length: str | None = None) -> DataFrame:
    """df with each found span of `text` replaced by mark; texts without spans stay as they are (null too).

    Spans that overlap are one.  length: a column that holds the number of
    characters; it is set anew where the text changes.
    """
    secrets, gaps = fresh_name(df, "secrets"), fresh_name(df, "gaps")
    found = scan_secrets(df, text, secrets)
    spans = F.array_sort(F.concat(F.col(secrets)["base"], F.col(secrets)["added"]))
    none = F.array().cast("array<struct<from:int,to:int>>")

    def step(pos: Column, s: Column) -> tuple[Column, Column]:
        gap = F.array(F.struct(pos.alias("from"), s["start"].alias("to")))
        return F.greatest(pos, s["end"]), F.when(s["start"] >= pos, gap).otherwise(none)

    found = found.withColumn(gaps, F.when(F.size(spans) > 0, _scan(spans, F.lit(0), step, "struct<from:int,to:int>")))
    kept, end, whole = F.col(gaps)["out"], F.col(gaps)["pos"], F.col(text)

    def joined(cut: Callable[[Column, Column], Column]) -> Column:
        pieces = F.transform(kept, lambda g: cut(g["from"], g["to"] - g["from"]))
        return F.concat(F.array_join(pieces, mark), F.lit(mark), cut(end, F.length(whole)))

    few = joined(lambda at, n: F.substring(whole, at + 1, n))
    many = F.element_at(F.transform(F.array(F.split(whole, "")), lambda chars: joined(lambda at, n: F.array_join(F.slice(chars, at + 1, n), ""))), 1)
    clean = F.when(F.col(gaps).isNull(), whole).when(F.size(kept) <= _FEW, few).otherwise(many)
    new = {text: clean}
    if length in df.columns:
        new[length] = F.when(F.col(gaps).isNull(), F.col(length)).otherwise(F.length(clean).cast(df.schema[length].dataType))
    return found.withColumns(new).drop(secrets, gaps)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, added = F.col("secrets")["base"], F.col("secrets")["added"]
    count = lambda rank: F.size(F.filter(base, lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_shown(base), 256).alias("base_sha256"), _shown(F.array_sort(F.concat(base, added))).alias("spans")
    )
