"""The screening plan: offers -> row rules -> groups -> group rules -> metrics -> ranking."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.functions import parse
from siftstone.operators.dictionary import dictionary, earliest_longest, occurrences
from siftstone.plans.shared import joinable, written

# The fields of an offer; all are text on input.
FIELDS = (
    "title", "shop_id", "item_id", "url", "shop_name", "shop_type", "price", "total_sold", "monthly_sales",
    "commission_rate", "bonus", "offer_end", "sv_rate", "sv_bonus", "front_stores", "category",
)
SORT_FIELDS = {"monthly_sales": "monthly", "per_order": "best_value", "price": "max_price", "commission_rate": "max_rate"}
REASON = "struct<code:string,text:string>"
#: Fields that are read as numbers, dates or truth, and the column of such a field's narrowed text.
TEXTS, NARROWED = ("monthly_sales", "price", "commission_rate", "sv_rate", "sv_bonus", "front_stores", "offer_end", "bonus"), "__{}"


@dataclass(frozen=True)
class Rules:
    """What the rule file says; see siftstone.sources.config.load_rules."""

    stage: int = 1
    categories: dict[str, list[str]] = field(default_factory=dict)
    later_stage_categories: dict[str, list[str]] = field(default_factory=dict)
    min_monthly_sales: Decimal = Decimal(0)
    trap_commission_min: Decimal = Decimal(100)
    same_product_min_stores: int = 0
    same_flavor_max_reject: int = 0
    done_policy: dict[str, str] = field(default_factory=lambda: {"same_brand_same_series": "exclude", "same_brand_other_series": "mark"})
    require_bonus: bool = False
    offer_end_policy: str = "mark"
    sort: tuple[str, ...] = ("monthly_sales desc",)
    promo_words: tuple[str, ...] = ()
    flavor_words: tuple[str, ...] = ()
    capacity_pattern: str = "(?!)"
    brand_aliases: dict[str, list[str]] = field(default_factory=dict)
    done: tuple[tuple[str, str], ...] = ()

    def alias(self) -> dict[str, str]:
        """Lower-cased alias or done brand -> brand; aliases win."""
        found = {b.casefold(): b for b, _ in self.done if b}
        for brand, names in self.brand_aliases.items():
            found |= {n.casefold(): brand for n in [brand, *names]}
        return found


def array_of(values) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def when_list(*pairs: tuple[Column, Column]) -> Column:
    """Array of the values whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, v) for c, v in pairs]))


def identified(raw: DataFrame) -> DataFrame:
    """shop and item of raw offers."""
    ids = parse.ids_from_url(F.col("url"))
    return raw.withColumns({
        "shop": F.coalesce(F.nullif(F.trim("shop_id"), F.lit("")), ids["shop"]),
        "item": F.coalesce(F.nullif(F.trim("item_id"), F.lit("")), ids["item"]),
    })


def parsed(raw: DataFrame, today: date) -> DataFrame:
    """Numbers, dates and ids of raw offers (text columns and idx), and NARROWED.

    Narrowed texts are columns of their own: a narrowing has long tables, and
    what is made of a text names it tens of times, in each plan that the driver keeps.
    """
    o = raw if "shop" in raw.columns else identified(raw)
    o = o.withColumns({NARROWED.format(f): parse.narrow(F.col(f)) for f in TEXTS})
    of = lambda parser, f: parser(F.col(f), lambda _: F.col(NARROWED.format(f)))
    return o.withColumns({
        "monthly": of(parse.parse_count, "monthly_sales"), "cost": of(parse.parse_price, "price"),
        "rate": of(parse.parse_rate, "commission_rate"), "sv": of(parse.parse_rate, "sv_rate"),
        "svb": of(parse.parse_rate, "sv_bonus"), "front": of(parse.parse_stores, "front_stores"),
        "end": of(parse.parse_date, "offer_end"), "today": F.lit(today),
    })


# ── names ────────────────────────────────────────────────────────────────────
def matched(names: DataFrame, found: DataFrame) -> DataFrame:
    """names with the columns of found, both by name; a null name is equal to itself."""
    other = found.withColumnRenamed("name", "__name")
    return names.join(other, names["name"].eqNullSafe(other["__name"]), "left").drop("__name")


def longest_known_prefix(words: DataFrame, known: DataFrame) -> DataFrame:
    """(word, prefix): the longest proper prefix of each distinct word that is among known.word.

    Prefixes are exploded and joined by equality, so no pair of words is compared.
    """
    lengths = F.sequence(F.lit(1), F.length("word") - 1)
    cut = words.select("word").distinct().filter(F.length("word") > 1).select("word", F.explode(lengths).alias("k")).select("word", "k", F.substring("word", F.lit(1), F.col("k")).alias("prefix"))
    hit = cut.join(known.select(F.col("word").alias("prefix")).distinct().hint("merge"), "prefix")
    return hit.groupBy("word").agg(F.max(F.struct("k", "prefix")).alias("m")).select("word", F.col("m.prefix").alias("prefix"))


def flavours(tokens: Column, rules: Rules) -> Column:
    """struct<found array, rest string>: tokens that are flavour words, else flavour words inside the joined tokens."""
    words = array_of(rules.flavor_words)
    category = [w for d in (rules.categories, rules.later_stage_categories) for ws in d.values() for w in ws]
    whole = F.filter(tokens, lambda t: F.array_contains(words, t))
    rest = F.array_join(F.filter(tokens, lambda t: ~F.array_contains(words, t)), "")
    inside = array_of(sorted((w for w in rules.flavor_words if w not in category), key=len, reverse=True))
    none = F.array().cast("array<string>")
    step = lambda acc, w: F.when(F.contains(acc["rest"], w), F.struct(F.concat(acc["found"], F.array(w)).alias("found"), F.replace(acc["rest"], w, F.lit("")).alias("rest"))).otherwise(acc)
    searched = F.aggregate(inside, F.struct(none.alias("found"), rest.alias("rest")), step)
    return F.when(F.size(whole) > 0, F.struct(whole.alias("found"), rest.alias("rest"))).otherwise(searched)


def names_of(names: DataFrame, rules: Rules) -> DataFrame:
    """brand, series, flavour and key of distinct names (column name).

    The brand is that of the earliest, then longest alias in the name, else the
    longest known brand that begins its first word, else its first word.
    """
    spark, alias = names.sparkSession, rules.alias()
    first, spaced = F.split("name", " ")[0], F.contains("name", F.lit(" "))
    o = names.withColumn("word", F.when(spaced, first).otherwise(F.col("name")))
    known = names.filter(spaced).select(first.alias("word"))
    if done := [b for b, _ in rules.done if b]:
        known = known.union(spark.createDataFrame([(b,) for b in done], "word string"))
    prefix = longest_known_prefix(o.select("word"), known)
    o = o.join(prefix, "word", "left")
    brands = dictionary(spark, list(alias.items()), "alias string, alias_brand string")
    if alias:
        low = o.select(F.lower("name").alias("low")).distinct()
        found = occurrences(low, ["low"], "low", brands.filter(F.length("alias") >= 2), "alias", [len(k) for k in alias if len(k) >= 2])
        o = o.withColumn("low", F.lower("name")).join(earliest_longest(found, ["low"], "alias", "alias_brand"), "low", "left")
    else:
        o = o.withColumn("hit", F.lit(None).cast("struct<pos:int,neg_len:int,key:string,alias_brand:string>"))
    after = lambda start: F.filter(F.split(F.expr(f"substring(name, {start})"), " +"), lambda t: t != "")
    brand = F.when(F.col("hit").isNotNull(), F.col("hit.alias_brand")).otherwise(F.coalesce("prefix", F.when(spaced, first).otherwise(F.lit(""))))
    tokens = F.when(F.col("hit").isNotNull(), after("hit.pos - hit.neg_len")).when(F.col("prefix").isNotNull(), after("length(prefix) + 1")).when(spaced, after("length(word) + 1")).otherwise(F.array("name"))
    o = o.select("name", brand.alias("brand"), flavours(tokens, rules).alias("f"))
    if alias:
        o = o.join(brands, F.lower("brand") == F.col("alias"), "left").withColumn("brand", F.coalesce("alias_brand", "brand"))
    o = o.select("name", "brand", F.array_join("f.found", "、").alias("flavour"), F.replace(F.col("f.rest"), F.lit(" "), F.lit("")).alias("series"), "f.found")
    key = F.struct(F.lower("brand").alias("brand"), F.lower("series").alias("series"), F.array_join(F.array_sort("found"), "|").alias("flavours"))
    return o.withColumn("key", key).drop("found")


def named(offers: DataFrame, rules: Rules) -> DataFrame:
    """brand, series, flavour, the grouping key and the done list's hits of each offer, from column name.

    Each distinct name is worked out once; names and what is found for them are
    written, as several joins read them.
    """
    n = written(names_of(written(offers.select("name").distinct(), "names"), rules), "named")
    return matched(offers, matched(n, done_hits(n, rules)).withColumn("done", F.coalesce("done", F.array().cast(f"array<{DONE}>"))))


def categorised(offers: DataFrame, rules: Rules) -> DataFrame:
    """cat_now and cat_later (names in the rule file's order) and category_label, from name and category."""
    spark = offers.sparkSession
    listed = [(kind, at, c, ws) for kind, d in (("now", rules.categories), ("later", rules.later_stage_categories)) for at, (c, ws) in enumerate(d.items())]
    words = dictionary(spark, [(w, kind, at, c) for kind, at, c, ws in listed for w in ws if w], "cat_word string, kind string, at int, cat string")
    own = dictionary(spark, [(c, kind, at, c) for kind, at, c, _ in listed], "own string, kind string, at int, cat string")
    texts = offers.select(F.concat("name", F.lit(" "), F.coalesce("category", F.lit(""))).alias("cat_text"), F.trim("category").alias("own_text")).distinct()
    texts = written(texts, "texts")
    inside = occurrences(texts.select("cat_text").distinct(), ["cat_text"], "cat_text", words, "cat_word", [len(w) for _, _, _, ws in listed for w in ws])
    inside = texts.join(inside.select("cat_text", "kind", "at", "cat").hint("merge"), "cat_text")
    equal = texts.join(own, F.col("own_text") == F.col("own")).select("cat_text", "own_text", "kind", "at", "cat")
    of = lambda kind: F.transform(F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.struct("at", "cat")))), lambda c: c["cat"])
    found = inside.select(equal.columns).union(equal).groupBy("cat_text", "own_text").agg(of("now").alias("cat_now"), of("later").alias("cat_later"))
    text, trimmed = F.concat("name", F.lit(" "), F.coalesce("category", F.lit(""))), F.trim("category")
    o = offers.join(found, text.eqNullSafe(F.col("cat_text")) & trimmed.eqNullSafe(F.col("own_text")), "left").drop("cat_text", "own_text")
    none = F.array().cast("array<string>")
    o = o.withColumns({c: F.coalesce(c, none) for c in ("cat_now", "cat_later")})
    both = (F.size("cat_now") > 0) & (F.size("cat_later") > 0)
    label = (
        F.when(both, F.concat(F.lit("品類衝突（待人判）："), F.array_join("cat_now", "、"), F.lit("／"), F.array_join("cat_later", "、")))
        .when(F.size("cat_later") > 0, F.array_join("cat_later", "、"))
        .when(F.size("cat_now") > 0, F.array_join("cat_now", "、"))
        .otherwise("未分類（待人判）")
    )
    return o.withColumn("category_label", label)


# ── row rules ────────────────────────────────────────────────────────────────
def first_rows(offers: DataFrame) -> DataFrame:
    """first_idx: the first row with the same shop and item, null without both ids."""
    ids = F.col("shop").isNotNull() & F.col("item").isNotNull()
    least = offers.filter(ids).groupBy("shop", "item").agg(F.min("idx").alias("first_idx"))
    return offers.join(least, ["shop", "item"], "left").withColumn("first_idx", F.when(ids, F.col("first_idx")))


DONE = "struct<policy:string,same:boolean,label:string>"


def done_hits(names: DataFrame, rules: Rules) -> DataFrame:
    """(name, done array<struct<policy, same, label>>): the done list's entries that fit, in its order, of names (name, brand, series) with any.

    An entry fits by its brand (an alias counts), by a name without a brand
    that begins with it, or by a name that has it inside.
    """
    spark, alias = names.sparkSession, rules.alias()
    entries = [(k, b, alias.get(b.casefold(), b).casefold(), b.casefold(), s or "", f"{b}｜{s}" if s else b) for k, (b, s) in enumerate(rules.done) if b]
    if not entries:
        return spark.createDataFrame([], f"name string, done array<{DONE}>")
    listed = dictionary(spark, entries, "at int, done_brand string, canonical string, folded string, done_series string, label string")
    by_brand = names.filter("brand != ''").join(listed, F.lower("brand") == F.col("canonical")).select("name", *listed.columns)
    plain = names.filter("brand = ''").select("name")
    begins = occurrences(plain, ["name"], "name", listed, "done_brand", [len(e[1]) for e in entries]).filter("pos = 1").select("name", *listed.columns)
    low = names.select(F.lower("name").alias("low")).distinct()
    inside = occurrences(low, ["low"], "low", listed.filter(F.length("done_brand") >= 2), "folded", [len(e[3]) for e in entries if len(e[1]) >= 2])
    inside = names.join(inside.hint("merge"), F.lower("name") == F.col("low")).select("name", *listed.columns)
    fits = by_brand.union(begins).union(inside).distinct().join(names.select("name", "series").hint("merge"), "name")
    same = (F.col("done_series") == "") | F.contains("series", F.col("done_series")) | F.contains("name", F.col("done_series"))
    policy = F.when(same, rules.done_policy["same_brand_same_series"]).otherwise(rules.done_policy["same_brand_other_series"])
    hits = F.array_sort(F.collect_list(F.struct("at", policy.alias("policy"), same.alias("same"), "label")))
    done = F.transform(hits, lambda h: F.struct(h["policy"].alias("policy"), h["same"].alias("same"), h["label"].alias("label")))
    return fits.groupBy("name").agg(done.alias("done"))


def reason(code: str | Column, text: Column | str) -> Column:
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(as_column(code).alias("code"), as_column(text).alias("text"))


def row_rules(offers: DataFrame, rules: Rules) -> DataFrame:
    """reasons array<struct<code,text>>, marks array<string> and demote of each row; needs first_idx, cat_*, done and the parsed fields."""
    m, rate, least, trap = F.col("monthly"), F.col("rate.value"), F.lit(rules.min_monthly_sales).cast(parse.VALUE), F.lit(rules.trap_commission_min).cast(parse.VALUE)
    unread = lambda label, n: (~n["ok"], F.concat(F.lit(f"{label}讀不到（「"), n["raw"], F.lit("」）")))
    twice = F.coalesce(F.col("first_idx") < F.col("idx"), F.lit(False))
    no_sales = m["ok"] & (m["value"].isNull() | (m["value"] == 0))
    trapped = F.coalesce(rate >= trap, F.lit(False))
    low, equal = F.coalesce(m["value"] < least, F.lit(False)) & ~no_sales, F.coalesce(m["value"] == least, F.lit(False)) & ~no_sales
    bonus = F.col(NARROWED.format("bonus"))
    bonus_text = F.when(F.coalesce(bonus, F.lit("")) == "", "分潤加碼待查").otherwise("不是分潤加碼")
    no_bonus = ~parse.is_true(bonus, lambda narrowed: narrowed)
    expired = F.coalesce(F.col("end.value") < F.col("today"), F.lit(False))
    expired_text = F.concat(F.lit("推廣已到期（"), F.col("offer_end"), F.lit(" 早於 "), F.col("today").cast("string"), F.lit("）"))
    number = F.lit(str(rules.stage + 1))
    done_reasons = F.transform(F.filter("done", lambda d: d["policy"] == "exclude"), lambda d: reason("做過", F.concat(F.lit("做過（"), d["label"], F.lit("）"))))
    other = "同品牌不同系列"
    done_marks = F.transform(F.filter("done", lambda d: d["policy"] == "mark"), lambda d: F.when(d["same"], F.concat(F.lit("做過（"), d["label"], F.lit("）"))).otherwise(F.concat(F.lit(f"{other}（"), d["label"], F.lit("）"))))
    demoted = F.transform(F.filter("done", lambda d: d["policy"] == "demote"), lambda d: F.when(d["same"], F.concat(F.lit("做過（"), d["label"], F.lit("）（降級，排最後）"))).otherwise(f"{other}（降級，排最後）"))
    dup_text = F.concat(F.lit("重複（同 shop/item "), "shop", F.lit("/"), "item", F.lit(" 已在列 "), F.col("first_idx").cast("string"), F.lit("）"))
    reasons = F.concat(
        when_list((twice, reason("重複列", dup_text))),
        done_reasons,
        when_list(
            ((F.size("cat_later") > 0) & (F.size("cat_now") == 0), reason(F.concat(F.lit("第"), number, F.lit("階段品類")), F.concat(F.lit("第 "), number, F.lit(" 階段品類："), F.array_join("cat_later", "、")))),
            (no_sales & trapped, reason("小店衝曝光", F.concat(F.lit("沒有月銷＋列表分潤 "), parse.show(rate), F.lit("% ≥ "), parse.show(trap), F.lit("（小店衝曝光）")))),
            (no_sales & ~trapped, reason("沒有月銷", "沒有月銷")),
            (low, reason("流量低", F.concat(F.lit("流量低（月銷 "), parse.show(m["value"]), F.lit(" < "), parse.show(least), F.lit("）")))),
            (no_bonus & F.lit(rules.require_bonus), reason("不是分潤加碼", bonus_text)),
            (expired & F.lit(rules.offer_end_policy == "exclude_member"), reason("推廣已到期", expired_text)),
        ),
    )
    marks = F.concat(
        when_list((F.col("first_idx").isNull(), F.lit("沒有 shop/item"))),
        done_marks,
        when_list(
            ((F.size("cat_now") > 0) == (F.size("cat_later") > 0), F.col("category_label")),
            unread("月銷", m),
            (equal, F.concat(F.lit("月銷剛好 "), parse.show(least), F.lit("（「"), m["raw"], F.lit("」）留著"))),
            (no_bonus & F.lit(not rules.require_bonus), bonus_text),
            (~F.col("end.ok"), F.concat(F.lit("到期日讀不到（「"), F.col("offer_end"), F.lit("」）"))),
            (F.col("end.ok") & F.col("end.value").isNull(), F.lit("到期日待查")),
            (expired & F.lit(rules.offer_end_policy == "mark"), expired_text),
            *[unread(label, F.col(c)) for label, c in (("價格", "cost"), ("列表分潤率", "rate"), ("短影音", "sv"), ("短影音獎勵", "svb"), ("前台同款家數", "front"))],
        ),
    )
    return offers.withColumns({"reasons": reasons, "marks": marks, "demote": F.get(demoted, F.size(demoted) - 1) if rules.done else F.lit(None).cast("string")}).drop("done", *map(NARROWED.format, TEXTS))


# ── groups ───────────────────────────────────────────────────────────────────
def named_groups(offers: DataFrame, rules: Rules, row_index) -> DataFrame:
    """group_table() of raw offers (idx, name): their rows are counted by name, then names are worked out and grouped."""
    by_name = offers.groupBy("name").agg(F.min("idx").alias("idx"), F.count("*").alias("rows"))
    return group_table(named(written(by_name, "counted"), rules), row_index, F.sum("rows"))


def group_table(offers: DataFrame, row_index, members: Column | None = None) -> DataFrame:
    """key, first (least idx), rep (representative name: spaced names first), gid by first appearance; members: their number, if not rows are counted."""
    members = F.count("*") if members is None else members
    g = offers.groupBy("key").agg(F.min("idx").alias("first"), F.min(F.struct((~F.contains("name", F.lit(" "))).alias("plain"), "idx", "name")).alias("rep"), members.alias("members"))
    return row_index(g.select("key", "first", F.col("rep.name").alias("group_name"), "members"), ["first"], "gid")


def stores(offers: DataFrame, rules: Rules) -> DataFrame:
    """A row per key: front, csv_stores, stores (null: to be counted), stores_from and the group's reasons for its alive members."""
    alive = F.size("reasons") == 0
    g = offers.groupBy("key").agg(
        F.max("front.value").alias("front_value"),
        F.count_distinct(F.when(alive, F.coalesce("shop", F.concat(F.lit("列"), F.col("idx").cast("string"))))).alias("csv_stores"),
    )
    csv, least, most = F.col("csv_stores").cast(parse.VALUE), F.lit(rules.same_product_min_stores), F.lit(rules.same_flavor_max_reject)
    known = F.when(F.col("front_value").isNotNull(), F.greatest("front_value", csv)).when(csv >= least, csv)
    source = F.when(F.col("front_value").isNull(), F.when(csv >= least, "csv").otherwise("unknown")).when(F.col("front_value") >= csv, "front").otherwise("csv")
    g = g.filter("csv_stores > 0").withColumns({"stores": known, "stores_from": source})
    by_front = F.col("front_value").isNotNull()
    front_text = F.concat(F.lit("（前台 "), parse.show(F.col("front_value")))
    reasons = when_list(
        (by_front & (F.col("stores") <= most), reason(f"同口味≤{rules.same_flavor_max_reject}家", F.concat(F.lit(f"同口味 ≤{rules.same_flavor_max_reject} 家"), front_text, F.lit("）")))),
        (by_front & (F.col("stores") < least), reason(f"同款家數<{rules.same_product_min_stores}", F.concat(F.lit(f"同款家數 <{rules.same_product_min_stores}"), front_text, F.lit("、CSV "), F.col("csv_stores").cast("string"), F.lit(" 家）")))),
    )
    return g.withColumn("group_reasons", reasons)


def group_rules(offers: DataFrame, rules: Rules, g: DataFrame | None = None) -> DataFrame:
    """Members with their group's reasons added where they were alive; one reason or more excludes.  g: stores() of the offers, if it is known."""
    g = stores(offers, rules) if g is None else g
    o = offers.join(g, "key", "left")
    added = F.when(F.size("reasons") == 0, F.coalesce("group_reasons", F.array().cast(f"array<{REASON}>"))).otherwise(F.array().cast(f"array<{REASON}>"))
    return o.withColumn("reasons", F.concat("reasons", added)).drop("group_reasons")


def metrics(offers: DataFrame) -> DataFrame:
    """A row per key with an alive member: maxima, and the best earnings per order (the first of equals)."""
    pay = parse.per_order(F.col("cost"), F.col("rate"), F.col("sv"), F.col("svb"))
    alive = offers.filter(F.size("reasons") == 0).withColumn("pay", pay)
    g = alive.groupBy("key").agg(
        F.max("monthly.value").alias("monthly"), F.max("cost.value").alias("max_price"), F.max("rate.value").alias("max_rate"),
        F.max(F.when(F.col("pay.value").isNotNull(), F.struct(F.col("pay.value").alias("v"), (-F.col("idx")).alias("neg"), F.col("pay.kind").alias("kind")))).alias("best"),
        F.count("*").alias("alive"), F.bool_or(F.col("demote").isNotNull()).alias("demoted"),
    )
    return g.withColumns({"best_value": F.col("best.v"), "best_kind": F.col("best.kind"), "best_idx": -F.col("best.neg")}).drop("best")


def order_of(rules: Rules) -> list[Column]:
    """Demoted groups last; per key nulls last in both directions; then the group's first row."""
    out = [F.col("demoted").asc()]
    for s in rules.sort:
        name, direction = s.split()
        c = F.col(SORT_FIELDS[name])
        out.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last())
    return [*out, F.col("first").asc()]


def pending_classes(groups: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Groups that may be one product, without their pairs: (classes, links).

    groups: gid, brand, series, flavour of the first member.  Groups of equal
    brand, series and flavour are one class: class_id (the least gid), b,
    series, flavour, members.  links: (class_id, kind, word, inner).  A class
    has a 'word' link for each category word in its series: classes of one brand
    with the same word are pending with one another.  It has an 'inside' link
    for each class (inner) of its brand whose other series lies in its own.  A
    pair counts if the flavours are equal or one of them is empty.
    """
    spark, words = groups.sparkSession, sorted({w for d in (rules.categories, rules.later_stage_categories) for ws in d.values() for w in ws})
    g = groups.filter("brand != ''").withColumn("b", F.lower("brand"))
    classes = written(g.groupBy("b", "series", "flavour").agg(F.min("gid").alias("class_id"), F.count("*").alias("members")), "classes")
    listed = dictionary(spark, [(w,) for w in words], "word string")
    found = occurrences(classes.select("series").distinct(), ["series"], "series", listed, "word", [len(w) for w in words]).select("series", "word").distinct()
    none = F.lit(None).cast("long")
    by_word = classes.join(found, "series").select("class_id", F.lit("word").alias("kind"), "word", none.alias("inner"))
    series = classes.select("b", "series").distinct()
    inside = occurrences(series, ["b", "series"], "series", series.withColumnRenamed("series", "part"), "part", on=["b"]).filter("series != part").select("b", "series", "part").distinct()
    small = classes.select("b", F.col("series").alias("part"), F.col("flavour").alias("inner_flavour"), F.col("class_id").alias("inner"))
    fits = "flavour = '' OR inner_flavour = '' OR flavour = inner_flavour"
    contained = classes.join(inside, ["b", "series"]).join(small, ["b", "part"]).filter(fits).select("class_id", F.lit("inside").alias("kind"), F.lit(None).cast("string").alias("word"), "inner")
    return classes, by_word.union(contained)


def pending_pairs(groups: DataFrame, rules: Rules) -> DataFrame:
    """Pairs of groups of one brand that may be one product: (gid_a, gid_b, shared words, contained).

    groups: gid, brand, series, flavour of the first member.  The list has all
    pairs; pending_classes() says the same in rows that grow with the groups.
    """
    classes, links = pending_classes(groups, rules)
    links, member = written(links, "links"), groups.filter("brand != ''").select("gid", F.lower("brand").alias("b"), "series", "flavour")
    by_word = links.filter("kind = 'word'").groupBy("class_id").agg(F.collect_list("word").alias("words"))
    member = written(member.join(classes.select("b", "series", "flavour", "class_id"), ["b", "series", "flavour"]).join(by_word, "class_id", "left"), "members")
    a, b = (member.select("b", *[F.col(c).alias(f"{c}_{k}") for c in ("gid", "class_id", "series", "flavour", "words")]) for k in "ab")
    with_word = a.withColumn("w", F.explode("words_a")).join(b.withColumn("w", F.explode("words_b")), ["b", "w"]).drop("w")
    inner = links.filter("kind = 'inside'").select(F.col("class_id").alias("class_id_a"), F.col("inner").alias("class_id_b"))
    inside = a.join(inner, "class_id_a").join(b.drop("b"), "class_id_b")
    # Groups of one series contain each other; that goes by brand and series, over all flavours.
    equal = a.filter("series_a != ''").join(b, (a["b"] == b["b"]) & (F.col("series_a") == F.col("series_b"))).drop(b["b"])
    columns = ["gid_a", "gid_b", "series_a", "series_b", "flavour_a", "flavour_b", "words_a", "words_b"]
    turned = inside.select(*[F.col(c[:-1] + ("b" if c[-1] == "a" else "a")).alias(c) for c in columns])
    pairs = with_word.select(columns).union(inside.select(columns)).union(turned).union(equal.select(columns)).filter("gid_a < gid_b").dropDuplicates(["gid_a", "gid_b"])
    found = pairs.filter("flavour_a = '' OR flavour_b = '' OR flavour_a = flavour_b")
    contained = (F.col("series_a") != "") & (F.col("series_b") != "") & (F.contains("series_a", F.col("series_b")) | F.contains("series_b", F.col("series_a")))
    shared = F.coalesce(F.array_join(F.array_sort(F.array_intersect("words_a", "words_b")), "、"), F.lit(""))
    return found.select("gid_a", "gid_b", shared.alias("shared"), contained.alias("contained"))


def excluded_with_siblings(offers: DataFrame) -> DataFrame:
    """Excluded rows with their codes and the alive rows of their group."""
    alive = offers.filter(F.size("reasons") == 0).groupBy("key").agg(F.count("*").alias("alive"), F.min("idx").alias("first_alive"), F.max("idx").alias("last_alive"))
    codes = F.array_join(F.transform("reasons", lambda r: r["code"]), "、")
    out = offers.filter(F.size("reasons") > 0).join(alive, "key", "left")
    return out.select("idx", codes.alias("codes"), F.coalesce("alive", F.lit(0)).cast("long").alias("alive"), "first_alive", "last_alive")


def reason_counts(offers: DataFrame) -> DataFrame:
    """Rows per reason code, the most frequent first, ties by first appearance."""
    r = offers.select("idx", F.posexplode("reasons").alias("at", "r"))
    return r.groupBy(F.col("r.code").alias("code")).agg(F.count("*").alias("n"), F.min(F.struct("idx", "at")).alias("seen")).orderBy(F.desc("n"), "seen").select("code", "n")


def ruled(raw: DataFrame, rules: Rules, today: date) -> DataFrame:
    """The row rules' results; raw has FIELDS, name and idx, and may have shop, item and first_idx, and what named() and categorised() find.

    Joins come first, as long as rows are short: numbers, reasons and marks are
    made of the texts where the rows lie then, and are not shuffled.
    """
    o = raw if "first_idx" in raw.columns else first_rows(identified(raw))
    o = o if "key" in raw.columns else categorised(named(o, rules), rules)
    return row_rules(parsed(o, today), rules)


def screened(raw: DataFrame, rules: Rules, today: date) -> DataFrame:
    """All of the above up to the group rules; raw as in ruled().

    Rows are written once, after the row rules; what the group rules add is
    joined to the columns that a reader takes.
    """
    o = written(ruled(raw, rules, today), "ruled")
    return group_rules(o, rules, joinable(written(stores(o, rules), "stores")))


def ranked(offers: DataFrame, rules: Rules, row_index) -> DataFrame:
    """Candidate groups with rank, best first."""
    first = offers.groupBy("key").agg(F.min("idx").alias("first"))
    return row_index(metrics(offers).join(first, "key"), order_of(rules), "rank").orderBy("rank")
