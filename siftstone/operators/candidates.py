"""What a screening gives to people: candidate rows, exclusions, groups, all as texts.

A cell lists the members of its group, so its length grows with the group;
members are collected per group only here, at the end of the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.functions import parse
from siftstone.operators.offers import Rules, when_list
from siftstone.plans.shared import joinable

# The columns and texts of the outputs.
CANDIDATE_COLUMNS = (
    "名次", "組名", "品牌", "系列", "口味", "各家（賣場類型 shop/item）", "價", "月銷", "列表分潤率", "每單約 $（哪一家、實／估）",
    "同款家數（前台／CSV／待數）", "品類", "標記", "下一步",
)
EXCLUSION_COLUMNS = ("列", "檔案", "檔案行", "品名", "組", "賣場類型", "shop_id", "item_id", "價", "月銷", "列表分潤率", "理由代碼", "理由", "備註")
STEPS = ("開詳情看短影音那列", "前台數家數", "詳情看價格", "人判品類", "看加碼到期日")
KINDS = {"real": "實", "estimate": "估"}
EXPIRED, NO_END, UNSORTED, CONFLICT = "推廣已到期", "到期日待查", "未分類", "品類衝突"


def _or(c: Column, text: str) -> Column:
    """text in place of null and ''."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(text)).otherwise(c)


def _cell(c: Column, value: Column, *before: str, after: str = "") -> Column:
    """列 N <value>, or the number as it was written, or that it is blank."""
    shown = F.concat(*map(F.lit, before), value, F.lit(after)) if before or after else value
    return F.when(c["value"].isNotNull(), shown).otherwise(_or(parse.show_number(c), "空白"))


def _members(offers: DataFrame) -> DataFrame:
    """A row per key: alive (array of members in order, with their cells) and expired (rows that went by that reason first)."""
    row = F.concat(F.lit("列 "), F.col("idx").cast("string"), F.lit(" "))
    money, n = parse.per_order(F.col("cost"), F.col("rate"), F.col("sv"), F.col("svb")), F.col("monthly")
    monthly = F.when(n["ok"], F.concat(_or(parse.show_number(n), "空白"), F.lit("（"), F.coalesce(n["raw"], F.lit("")), F.lit("）"))).otherwise(parse.show_number(n))
    cells = {
        "each": F.concat(row, _or(F.col("shop_type"), "?"), F.lit(" "), _or(F.col("shop"), "?"), F.lit("/"), _or(F.col("item"), "?")),
        "price": F.concat(row, _cell(F.col("cost"), parse.show_number(F.col("cost")), "$")), "monthly": F.concat(row, monthly),
        "rate": F.concat(row, _cell(F.col("rate"), parse.show(F.col("rate.value")), after="%")), "pay": money, "how": parse.per_order_text(F.col("cost"), F.col("rate"), F.col("sv"), F.col("svb")),
        "category": F.col("category_label"), "marks": F.col("marks"), "demote": F.col("demote"), "no_price": F.col("cost.value").isNull(),
    }
    alive = F.size("reasons") == 0
    member = F.struct("idx", *[c.alias(k) for k, c in cells.items()])
    gone = ~alive & F.coalesce(F.get("reasons", 0)["code"] == EXPIRED, F.lit(False))
    expired = F.when(gone, F.col("idx"))
    # The other rows are in neither list.
    return offers.filter(alive | gone).groupBy("key").agg(F.array_sort(F.collect_list(F.when(alive, member))).alias("alive"), F.array_sort(F.collect_list(expired)).alias("expired"))


def _per_order(alive: Column) -> Column:
    """The best earnings first, with the reason if something was unreadable, then the others, then those without."""
    paid = F.filter(alive, lambda m: m["pay"]["value"].isNotNull())
    best = F.array_max(F.transform(paid, lambda m: F.struct(m["pay"]["value"].alias("v"), (-m["idx"]).alias("neg"), m["pay"]["kind"].alias("kind"), m["how"].alias("how"))))
    kind = lambda k: F.element_at(F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair]), k)
    line = lambda idx: F.concat(F.lit("列 "), idx.cast("string"))

    def cell(b: Column) -> Column:
        first = F.concat(b["v"].cast("string"), F.lit("（"), line(-b["neg"]), F.lit("，"), kind(b["kind"]), F.lit("）"), F.when(F.contains(b["how"], F.lit("讀不到")), F.concat(F.lit("："), b["how"])).otherwise(""))
        others = F.transform(F.filter(paid, lambda m: m["idx"] != -b["neg"]), lambda m: F.concat(line(m["idx"]), F.lit(" "), m["how"], F.lit("＝"), m["pay"]["value"].cast("string"), F.lit("（"), kind(m["pay"]["kind"]), F.lit("）")))
        none = F.transform(F.filter(alive, lambda m: m["pay"]["value"].isNull()), lambda m: F.concat(line(m["idx"]), F.lit(" 算不出來（"), m["how"], F.lit("）")))
        return F.array_join(F.concat(F.array(first), others, none), "；")

    all_none = F.concat(F.lit("算不出來（"), F.array_join(F.transform(alive, lambda m: F.concat(line(m["idx"]), F.lit(" "), m["how"])), "；"), F.lit("）"))
    return F.element_at(F.transform(F.array(best), lambda b: F.when(b.isNull(), all_none).otherwise(cell(b))), 1)


def _marks(alive: Column, expired: Column) -> Column:
    """Expired members, demotions, then members' marks, each of these once and with its row if there are several."""
    rows = F.array_join(F.transform(alive, lambda m: m["idx"].cast("string")), "、")
    gone = F.transform(expired, lambda i: F.concat(F.lit("列 "), i.cast("string"), F.lit(f" {EXPIRED}，只剩列 "), rows))
    demoted = F.transform(F.filter(alive, lambda m: m["demote"].isNotNull()), lambda m: m["demote"])
    own = F.flatten(F.transform(alive, lambda m: F.transform(m["marks"], lambda t: F.when(F.size(alive) > 1, F.concat(F.lit("列 "), m["idx"].cast("string"), F.lit(" "), t)).otherwise(t))))
    first = F.concat(gone, demoted)
    return F.concat(first, F.array_except(own, first))


def stores_text() -> Column:
    csv = F.col("csv_stores").cast("string")
    known = F.when(F.col("stores_from") == "front", "前台").otherwise("CSV")
    return (
        F.when(F.col("stores").isNull(), F.concat(F.lit("待數（CSV "), csv, F.lit(" 家有效）")))
        .when(F.col("front_value").isNull(), F.concat(csv, F.lit("（CSV）")))
        .otherwise(F.concat(parse.show(F.col("stores")), F.lit("（"), known, F.lit("）")))
    )


def steps_text(stores: Column, no_price: Column, marks: Column) -> Column:
    """What a person still has to look at; categories and dates count where the group itself has the mark."""
    begins = lambda text: F.exists(marks, lambda m: F.startswith(m, F.lit(text)))
    conditions = (F.lit(True), stores.isNull(), no_price, begins(UNSORTED) | begins(CONFLICT), F.array_contains(marks, NO_END))
    return F.array_join(when_list(*[(c, F.lit(t)) for c, t in zip(conditions, STEPS, strict=True)]), "；")


def candidate_rows(offers: DataFrame, ranked: DataFrame, groups: DataFrame) -> DataFrame:
    """CANDIDATE_COLUMNS of each ranked group.

    offers: the screened rows; ranked: key and rank; groups: key and group_name.
    """
    of_group = offers.filter(F.size("reasons") == 0).groupBy("key").agg(
        *[F.min_by(c, "idx").alias(c) for c in ("front_value", "csv_stores", "stores", "stores_from")], F.max("monthly.value").alias("most")
    )
    # The group's brand, series and flavour are those of its first member.
    named = offers.groupBy("key").agg(F.min(F.struct("idx", "brand", "series", "flavour")).alias("f")).select("key", "f.brand", "f.series", "f.flavour")
    g = ranked.select("key", "rank").join(joinable(groups.select("key", "group_name")), "key").join(named, "key").join(of_group, "key").join(_members(offers), "key")
    g = g.withColumn("marks", _marks(F.col("alive"), F.col("expired")))
    cell = lambda name: F.array_join(F.transform("alive", lambda m: m[name]), "；")
    values = (
        F.col("rank"), F.col("group_name"), F.col("brand"), F.col("series"), F.col("flavour"), cell("each"), cell("price"),
        F.concat(F.when(F.col("most").isNull(), "讀不到").otherwise(parse.show(F.col("most"))), F.lit("｜"), cell("monthly")), cell("rate"), _per_order(F.col("alive")), stores_text(),
        F.array_join(F.array_distinct(F.transform("alive", lambda m: m["category"])), "、"), F.array_join("marks", "；"),
        steps_text(F.col("stores"), F.exists("alive", lambda m: m["no_price"]), F.col("marks")),
    )
    return g.select(*[v.alias(n) for n, v in zip(CANDIDATE_COLUMNS, values, strict=True)])


def exclusion_rows(offers: DataFrame, groups: DataFrame) -> DataFrame:
    """EXCLUSION_COLUMNS of each excluded row; the note names the rows of its group that stay."""
    alive = offers.filter(F.size("reasons") == 0).groupBy("key").agg(F.array_sort(F.collect_list("idx")).alias("stay"))
    note = F.when(F.col("stay").isNotNull(), F.concat(F.lit("同組列 "), F.array_join(F.transform("stay", lambda i: i.cast("string")), "、"), F.lit(" 照留"))).otherwise("")
    have = lambda c: F.col(c) if c in offers.columns else F.lit("")
    part = lambda name, sep: F.array_join(F.transform("reasons", lambda r: r[name]), sep)
    o = offers.filter(F.size("reasons") > 0).join(joinable(groups.select("key", "group_name")), "key").join(alive, "key", "left")
    values = (
        F.col("idx"), have("_file"), have("_line"), F.col("title"), F.col("group_name"), F.col("shop_type"), F.coalesce("shop", F.lit("")), F.coalesce("item", F.lit("")),
        F.col("price"), F.col("monthly_sales"), F.col("commission_rate"), part("code", "、"), part("text", "；"), note,
    )
    return o.select(*[v.alias(n) for n, v in zip(EXCLUSION_COLUMNS, values, strict=True)])


def group_documents(offers: DataFrame, groups: DataFrame) -> DataFrame:
    """(gid, json): each group with its rows, whether it is a candidate, and what its names were compared by."""
    compared = F.concat(F.col("brand"), F.lit("｜"), F.col("series"), F.lit("｜"), _or(F.col("flavour"), "（無口味）"))
    member = F.struct(F.col("idx").alias("列"), F.col("title").alias("品名"), compared.alias("比對用"))
    rows = offers.groupBy("key").agg(
        F.array_sort(F.collect_list(member)).alias("members"), F.min(F.struct("idx", "brand", "series", "flavour")).alias("f"), F.bool_or(F.size("reasons") == 0).alias("candidate")
    )
    doc = F.struct(
        F.col("gid").alias("組"), F.col("group_name").alias("組名"), F.col("f.brand").alias("品牌"), F.col("f.series").alias("系列"), F.col("f.flavour").alias("口味"),
        F.transform("members", lambda m: m["列"]).alias("列"), F.col("candidate").alias("候選"), F.col("members").alias("怎麼判"),
    )
    return rows.join(joinable(groups.select("key", "gid", "group_name")), "key").select("gid", F.to_json(doc).alias("json"))


def report(candidates: DataFrame, exclusions: DataFrame, rules: Rules, today: str, sources: list[tuple[str, int]], pending: DataFrame | None = None) -> DataFrame:
    """(part, at, line): the lines of the Markdown report in order; pending has columns gid, names and reason."""
    escaped = lambda c: F.replace(F.replace(c.cast("string"), F.lit("|"), F.lit("｜")), F.lit("\n"), F.lit(" "))
    head = [
        f"# 候選表（{today}，第 {rules.stage} 階段：{'、'.join(rules.sort)}）", "", "來源：" + "、".join(f"{name}（{n} 列）" for name, n in sources), "",
        "列表分潤率不一定等於短影音（規則檔 list_rate_note）：每單約 $ 標「估」的是拿列表分潤率估的，只拿來排序。", "",
        "| " + " | ".join(CANDIDATE_COLUMNS) + " |", "|" + "---|" * len(CANDIDATE_COLUMNS),
    ]
    spark = candidates.sparkSession
    fixed = lambda part, lines: spark.createDataFrame([(part, k, x) for k, x in enumerate(lines)], "part int, at long, line string")
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *[escaped(F.col(f"`{c}`")) for c in CANDIDATE_COLUMNS]), F.lit(" |"))
    parts = [fixed(0, head), candidates.select(F.lit(1).alias("part"), F.col("名次").cast("long").alias("at"), row.alias("line"))]
    if pending is not None and pending.take(1):
        line = F.concat(F.lit("- 組 "), F.col("gid").cast("string"), F.lit("："), F.col("names"), F.lit(" ⇒ "), F.col("reason"))
        parts += [fixed(2, ["", "## 分組待人判（程式沒有併）", ""]), pending.select(F.lit(3).alias("part"), F.col("gid").cast("long").alias("at"), line.alias("line"))]
    parts.append(fixed(4, ["", f"## 排除 {exclusions.count()} 列（細節見 排除.csv）", ""]))
    gone = F.concat(F.lit("- 列 "), F.col("列").cast("string"), F.lit(" "), F.col("品名"), F.lit("："), F.col("理由"))
    parts.append(exclusions.select(F.lit(5).alias("part"), F.col("列").cast("long").alias("at"), gone.alias("line")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.orderBy("part", "at")

