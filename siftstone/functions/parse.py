"""Text to numbers with three states, dates, ids: Column expressions.

A parsed number is struct<raw, value decimal(20,6), plus, ok>: blank is
(ok, value null), unreadable is (not ok).  The two must stay apart, a blank
bonus is 0 but an unreadable one is not.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from decimal import Decimal
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE, EARNINGS = "decimal(20,6)", "decimal(18,2)"
#: Digits as they are read, before a unit multiplies them.
WIDE = "decimal(28,6)"

# Formats of the input texts.
COUNT = r"(?i)^(?:已售|月銷)?\s*(\d[\d,]*(?:\.\d+)?)\s*(萬|万|千|k)?\s*(\+)?\s*(?:sold|已售|件)?$"
PRICE = r"(?i)^(?:NT\$|NT|\$)?\s*(\d[\d,]*(?:\.\d+)?)\s*(?:元)?$"
RATE = r"^(\d+(?:\.\d+)?)\s*%$"
STORES = r"^(\d+)\s*(?:家)?$"
DATE = r"^(\d{4})[/\-.](\d{1,2})[/\-.](\d{1,2})$"
URLS = (r"/product/(\d+)/(\d+)", r"-i\.(\d+)\.(\d+)", r"[?&]shopid=(\d+).*?[?&]itemid=(\d+)")
UNITS = {"萬": 10_000, "万": 10_000, "千": 1_000, "k": 1_000}
TRUE_TEXTS = ("是", "有", "Y", "y", "yes", "Yes", "TRUE", "true", "1")


def nfkc(text: Column) -> Column:
    """Unicode NFKC and strip, by built-in functions; only conjoining Hangul letters are left as they are."""
    return F.btrim(composed(folded(text)), F.lit(_BLANKS))


@cache
def _compatibility() -> tuple[str, str, dict[str, str]]:
    """Characters that NFKC turns to one other, these, and those that it turns to several."""
    one, many = {}, {}
    for k in range(0x80, 0x110000):
        if not 0xAC00 <= k < 0xD7A4 and (to := unicodedata.normalize("NFKC", chr(k))) != chr(k):
            (one if len(to) == 1 else many)[chr(k)] = to
    return "".join(one), "".join(one.values()), many


#: What Python's strip() takes away, as far as NFKC leaves it.
_BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u1680\u2028\u2029"


@cache
def _composition() -> tuple[str, dict[str, str], dict[str, int], dict[str, str]]:
    """A regex class of combining marks; marks by class; what characters with marks come apart to, and what pairs compose to."""
    marks = {chr(k): c for k in range(0x300, 0x110000) if (c := unicodedata.combining(chr(k)))}
    apart, pairs = {}, {}
    for k in range(0xC0, 0x110000):
        c = chr(k)
        if 0xAC00 <= k < 0xD7A4 or not (d := unicodedata.decomposition(c)) or d[0] == "<":
            continue
        whole = unicodedata.normalize("NFD", c)
        if whole[-1] in marks:
            apart[c] = whole
        both = "".join(chr(int(x, 16)) for x in d.split())
        if len(both) == 2 and both[1] in marks and unicodedata.normalize("NFC", both) == c:
            pairs[both] = c
    ranges: list[list[int]] = []
    for k in map(ord, marks):
        if ranges and ranges[-1][1] == k - 1:
            ranges[-1][1] = k
        else:
            ranges.append([k, k])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges), apart, marks, pairs


def _table(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def composed(text: Column) -> Column:
    """Combining marks put in order and composed with the character before them, as NFC does; conjoining Hangul letters stay."""
    kind, apart, classes, pairs = _composition()
    cluster = f"[^{kind}]?[{kind}]+"  # a text may begin with marks
    apart, classes, pairs = _table(apart), _table(classes), _table(pairs)

    def compose(cluster: Column) -> Column:
        chars = F.split(F.array_join(F.transform(F.split(cluster, ""), lambda c: F.coalesce(F.element_at(apart, c), c)), ""), "")
        bare = F.element_at(classes, F.get(chars, 0)).isNotNull()
        marks = F.slice(chars, F.when(bare, 1).otherwise(2), F.size(chars))
        marks = F.array_sort(F.transform(marks, lambda c, k: F.struct(F.element_at(classes, c).alias("class"), k.alias("k"), c.alias("c"))))
        begin = F.struct(F.when(bare, "").otherwise(F.get(chars, 0)).alias("base"), F.lit("").alias("rest"), F.lit(0).alias("last"))

        def step(acc: Column, m: Column) -> Column:
            to = F.element_at(pairs, F.concat(acc["base"], m["c"]))
            joins = to.isNotNull() & (acc["last"] < m["class"])
            kept = F.struct(acc["base"].alias("base"), F.concat(acc["rest"], m["c"]).alias("rest"), m["class"].alias("last"))
            return F.when(joins, F.struct(to.alias("base"), acc["rest"].alias("rest"), acc["last"].alias("last"))).otherwise(kept)

        return F.aggregate(marks, begin, step, lambda acc: F.concat(acc["base"], acc["rest"]))

    def all_of(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(cluster), F.lit(0)), compose)
        return F.array_join(F.zip_with(F.split(t, cluster, -1), found, lambda gap, c: F.concat(gap, F.coalesce(c, F.lit("")))), "")

    return once(text, lambda t: F.when((F.length(t) < F.octet_length(t)) & t.rlike(cluster), all_of(t)).otherwise(t))


def folded(text: Column) -> Column:
    """NFKC character by character."""
    one, to, many = _compatibility()
    wide = F.translate(text, one, to)
    wide = F.when(F.translate(wide, "".join(many), "") != wide, F.array_join(F.transform(F.split(wide, ""), lambda c: F.coalesce(F.element_at(_table(many), c), c)), "")).otherwise(wide)
    return F.when(F.length(text) == F.octet_length(text), text).otherwise(wide)


@cache
def _common() -> tuple[str, str, str]:
    """Full-width characters, what they become, and a regex class of those that need the whole table.

    Ideographs from U+4E00 on stay as they are.
    """
    one, to, _ = _compatibility()
    wide = {a: b for a, b in zip(one, to, strict=True) if a == "\u3000" or "\uff01" <= a <= "\uff5e"}
    return "".join(wide), "".join(wide.values()), r"[^\x00-\x7F\x{3000}\x{4E00}-\x{9FFF}\x{FF01}-\x{FF5E}]"


def narrow(text: Column) -> Column:
    """nfkc() by built-in functions, character by character: only composition of marks is left out, which no format here has.

    Texts of ASCII, ideographs and full-width characters need no more than a short table.
    """
    one, to, many = _compatibility()
    common, plain, others = _common()
    many = {c: to for c, to in many.items() if to.isascii()}
    # What a character comes apart to has none that changes further, so either step may be first; the table stands in the plan once.
    apart = F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.element_at(_table(many), c), c)), "")
    wide = F.translate(F.when(text.rlike(f"[{''.join(many)}]"), apart).otherwise(text), one, to)
    return F.btrim(F.when(F.length(text) == F.octet_length(text), text).when(~text.rlike(others), F.translate(text, common, plain)).otherwise(wide), F.lit(_BLANKS))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once for a row, however often it occurs; the optimizer does not take it apart."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _groups(text: Column, pattern: str, n: int) -> Callable[[int], Column]:
    """The n groups of the pattern, which matches whole texts, by a single match: the k-th (from 0), null without a match.

    What occurs several times here and below is always evaluated, so Spark works
    it out once for a row; lambdas would be interpreted.
    """
    mark = "\x00"
    unmarked = F.when(F.contains(text, F.lit(mark)), F.translate(text, mark, " ")).otherwise(text)
    parts = F.split(F.regexp_replace(unmarked, pattern, mark.join(f"${k}" for k in range(1, n + 1)) + mark), mark)
    # A match has n parts and an empty one, any other text is one part.
    return lambda k: F.get(parts, F.when(F.size(parts) > 1, F.lit(k)))


def _number(raw: Column, text: Column, pattern: str, n: int = 1, factor: Callable[[Callable[[int], Column]], Column] | None = None, plus: Callable[[Callable[[int], Column]], Column] | None = None) -> Column:
    """A value that does not fit is unreadable."""
    group = _groups(text, pattern, n)
    digits = F.replace(group(0), F.lit(","), F.lit(""))
    value = (digits.try_cast(WIDE) * factor(group) if factor else digits).try_cast(VALUE)
    known = value.isNotNull()
    more = known & F.coalesce(plus(group), F.lit(False)) if plus else F.lit(False)
    return F.struct(raw.alias("raw"), value.alias("value"), more.alias("plus"), ((F.coalesce(text, F.lit("")) == "") | known).alias("ok"))


def parse_count(raw: Column, clean=narrow) -> Column:
    """3萬+ -> 30000 with plus; thousands commas, decimals, units, an optional prefix and suffix."""
    units = F.create_map(*[F.lit(x) for name, n in UNITS.items() for x in (name, Decimal(n))])
    factor = lambda group: F.coalesce(F.element_at(units, F.lower(group(1))), F.lit(Decimal(1)))
    return _number(raw, clean(raw), COUNT, 3, factor, lambda group: group(2) == "+")


def parse_price(raw: Column, clean=narrow) -> Column:
    """A range or words are unreadable."""
    return _number(raw, clean(raw), PRICE)


def parse_rate(raw: Column, clean=narrow) -> Column:
    """Without % a number is unreadable: it may be a share or a percentage."""
    return _number(raw, clean(raw), RATE)


def parse_stores(raw: Column, clean=narrow) -> Column:
    return _number(raw, clean(raw), STORES)


def parse_date(raw: Column, clean=narrow) -> Column:
    """struct<value date, ok>: blank is (null, ok), an impossible or strange date (null, not ok)."""

    text = clean(raw)
    group = _groups(text, DATE, 3)
    date = F.concat(group(0), F.lit("-"), group(1), F.lit("-"), group(2)).try_cast("date")
    return F.struct(date.alias("value"), ((F.coalesce(text, F.lit("")) == "") | date.isNotNull()).alias("ok"))


def state(number: Column) -> Column:
    return F.when(~number["ok"], "unreadable").when(number["value"].isNull(), "blank").otherwise("value")


def ids_from_url(url: Column) -> Column:
    """struct<shop, item> by the first pattern that matches, nulls if none does."""
    pick = lambda k: F.coalesce(*[F.when(url.rlike(p), F.regexp_extract(url, p, k)) for p in URLS])
    return F.struct(pick(1).alias("shop"), pick(2).alias("item"))


def show(value: Column) -> Column:
    """Whole numbers without decimals, others without trailing zeros; null is ''."""
    text = value.cast("string")
    return F.coalesce(F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(F.regexp_replace(text, "0+$", "")), F.lit(""))


def show_number(number: Column) -> Column:
    return F.when(~number["ok"], F.concat(F.lit("「"), number["raw"], F.lit("」"))).otherwise(F.concat(show(number["value"]), F.when(number["plus"], "+").otherwise("")))


def is_true(text: Column, clean=narrow) -> Column:
    return F.coalesce(clean(text).isin(*TRUE_TEXTS), F.lit(False))


def per_order(price: Column, rate: Column, sv: Column, bonus: Column) -> Column:
    """struct<value decimal(18,2), kind>: price x (sv + bonus) % if sv is known ('real'), else price x rate % ('estimate').

    A blank bonus is 0; an unreadable sv or bonus leads to the estimate.
    Products are exact, rounded half up once; earnings of 10**16 or more, and
    percentages of 10**8 or more, are unknown.
    """

    def earn(percent: Column) -> Column:
        # The product in hundredths: rounded to a whole number it is the earnings in cents.
        exact = price["value"] * percent.try_cast("decimal(14,6)")
        return (F.round(exact, 0).cast("decimal(27,0)") * F.lit(Decimal("0.01"))).try_cast(EARNINGS)

    zero = F.lit(0).cast(VALUE)
    use_sv = sv["value"].isNotNull() & sv["ok"] & bonus["ok"]
    real, estimate = earn(sv["value"] + F.coalesce(bonus["value"], zero)), earn(rate["value"])
    known = price["value"].isNotNull()
    return F.struct(
        F.when(known & use_sv, real).when(known, estimate).alias("value"),
        F.when(known & use_sv, "real").when(known & rate["value"].isNotNull(), "estimate").alias("kind"),
    )


def why_unreadable(label: str, number: Column) -> Column:
    """Fixed text, null for a readable number."""
    return F.when(~number["ok"], F.concat(F.lit(f"{label}讀不到（「"), number["raw"], F.lit("」）")))


def per_order_text(price: Column, rate: Column, sv: Column, bonus: Column) -> Column:
    """How per_order() came to its value, or why there is none (fixed texts)."""
    blank = lambda label, n: F.coalesce(why_unreadable(label, n), F.lit(f"{label}空白"))
    bad = F.array_compact(F.array(why_unreadable("短影音", sv), why_unreadable("短影音獎勵", bonus)))
    named = F.array_join(bad, "、")
    real = F.concat(F.lit("短影音 "), show(sv["value"]), F.lit("＋"), show(F.coalesce(bonus["value"], F.lit(0).cast(VALUE))))
    listed = F.concat(F.lit("列表分潤 "), show(rate["value"]), F.lit("%"), F.when(F.size(bad) > 0, F.concat(F.lit("；"), named, F.lit("，改用列表估"))).otherwise(""))
    none = F.concat(blank("分潤率", rate), F.when(F.size(bad) > 0, F.concat(F.lit("；"), named)).otherwise(""))
    return F.when(price["value"].isNull(), blank("價格", price)).when(sv["value"].isNotNull() & (F.size(bad) == 0), real).when(rate["value"].isNotNull(), listed).otherwise(none)
