import json
import os
from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftstone.operators import images, photo, series, specs, verdicts
from siftstone.operators import lint as L
from siftstone.operators import offers as O
from siftstone.plans.shared import row_index
from siftstone.sources import config, readers, sinks

DATA = "/root/testdata/sf0.001"
RULES = O.Rules(categories={"food": ["海苔"]}, min_monthly_sales=Decimal(1000), trap_commission_min=Decimal(15), same_product_min_stores=2, same_flavor_max_reject=0, flavor_words=("原味", "辣味"), promo_words=("現貨",), capacity_pattern=r"\d+g", done=(("舊識牌", "豆漿"),))


def raw(spark, rows):
    blank = dict.fromkeys(O.FIELDS, "")
    data = [{**blank, **r, "name": r["title"]} for r in rows]
    return row_index(spark.createDataFrame(data).withColumn("seq", F.monotonically_increasing_id()), ["seq"])


def row(title, shop, item, sales="3萬+", **more):
    return {"title": title, "shop_id": shop, "item_id": item, "monthly_sales": sales, "price": "$100", "commission_rate": "10%", "bonus": "是", "offer_end": "2026/12/31", **more}


def test_plan(spark):
    rows = [row("晴空 海苔 原味", "1", "1"), row("晴空 海苔 原味", "2", "2", "5萬", sv_rate="12%"), row("晴空 海苔 原味", "2", "2"), row("晴空 海苔 辣味", "3", "3", "500"), row("舊識牌 豆漿 原味", "4", "4"), row("晴空 海苔 辣味", "5", "5", "", commission_rate="20%")]
    o = O.screened(raw(spark, rows), RULES, date(2026, 10, 19))
    codes = {r.idx: [x.code for x in r.reasons] for r in o.collect()}
    assert codes == {1: [], 2: [], 3: ["重複列"], 4: ["流量低"], 5: ["做過"], 6: ["小店衝曝光"]}
    best = O.ranked(o, RULES, row_index).collect()
    assert [(b["rank"], b["best_value"], b["best_kind"], b["best_idx"], b["alive"]) for b in best] == [(1, Decimal("12.00"), "real", 2, 2)]


def test_splitting_pages_changes_nothing(spark):
    rows = [row(f"晴空 海苔 {f}", str(i), str(i)) for i, f in enumerate(("原味", "辣味") * 3)]
    one = O.ranked(O.screened(raw(spark, rows), RULES, date(2026, 1, 1)), RULES, row_index).drop("key").collect()
    both = O.ranked(O.screened(raw(spark, rows[:3] + rows[3:]), RULES, date(2026, 1, 1)), RULES, row_index).drop("key").collect()
    assert one == both and len(one) == 2


def test_titles():
    from title_reference import cleaner

    clean = cleaner(RULES)
    assert clean("【買一送一】舊識牌 豆漿 500g") == ("舊識牌 豆漿", ["【買一送一】", "500g"])
    assert clean("(辣味)海苔 現貨")[0] == "辣味 海苔"
    assert clean("【舊識牌】豆漿")[0] == "舊識牌 豆漿"


def test_rule_file(tmp_path):
    good = {"stage": 1, "categories": {}, "later_stage_categories": {}, "min_monthly_sales": 1, "trap_commission_min": 1, "same_product_min_stores": 1, "same_flavor_max_reject": 1, "done_policy": {"same_brand_same_series": "exclude", "same_brand_other_series": "mark"}, "require_bonus": True, "offer_end_policy": "mark", "sort": ["price asc"], "promo_words": [], "flavor_words": [], "capacity_pattern": "x", "_note": 1}
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(good))
    assert config.load_rules(str(path)).sort == ("price asc",)
    for key, bad in (("sort", ["price up"]), ("capacity_pattern", "("), ("offer_end_policy", "x")):
        path.write_text(json.dumps(good | {key: bad}))
        with pytest.raises(config.ConfigError):
            config.load_rules(str(path))


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "cp950"])
def test_encodings(spark, tmp_path, encoding):
    (tmp_path / "a.csv").write_bytes("品名,價格\r\n海苔,$5\r\n\r\n豆漿,$6\r\n".encode(encoding))
    got = readers.read_offers(spark, str(tmp_path), {"title": ["品名"], "price": ["價格"]}).orderBy("_line").collect()
    assert [(r.title, r.price, r._line) for r in got] == [("海苔", "$5", 2), ("豆漿", "$6", 4)]


def test_strict_files():
    columns = {"title": ["品名"]}
    for text in ("", "品名\n", "神秘欄\nx\n", "品名\na,b\n", "品名,title\na,b\n"):
        with pytest.raises(config.ConfigError):
            list(readers.offer_rows(text, columns))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 1), (None, 2)], "x string, y int").coalesce(1)
    sinks.write_csv(df, str(tmp_path / "a.csv"))
    assert (tmp_path / "a.csv").read_bytes() == b"\xef\xbb\xbfx,y\r\na|b,1\r\n,2\r\n"
    sinks.write_markdown(df, str(tmp_path / "a.md"), "T")
    assert "| a｜b | 1 |" in (tmp_path / "a.md").read_text()
    files = spark.createDataFrame([("d/q.txt", "t\n")], "path string, text string")
    assert sinks.write_package(files, str(tmp_path / "out")) == 1
    with pytest.raises(ValueError):
        sinks.write_package(files, str(tmp_path / "out" / "x"), protected=str(tmp_path / "out"))
    with pytest.raises(ValueError):
        sinks.write_package(spark.createDataFrame([("../q.txt", "t")], "path string, text string"), str(tmp_path / "out"))


def test_series_against_numpy(spark):
    rng = np.random.default_rng(5)
    d = np.abs(np.sin(np.arange(60) * 2 * np.pi / 5)) + rng.random(60) * 0.05 + 1
    frame = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(d)], "s int, t int, d double")
    limits = series.Limits()
    got = series.autocorrelation(series.segments(frame, "s", limits.cut), "s", limits).first()
    pad = np.pad(d, 4, mode="edge")
    x = d - np.convolve(pad, np.ones(9) / 9, mode="valid")
    x -= x.mean()
    n, e = len(x), (x * x).sum()
    scores = {k: (x[:-k] * x[k:]).sum() / e * n / (n - k) for k in range(2, 9)}
    assert got.peak == pytest.approx(max(scores.values())) and got.peak_lag == max(scores, key=scores.get)


def test_lint(spark):
    lines = L.lines_of(spark.createDataFrame([("a", "這個保證便宜\n\n 好 "), ("b", "頭髮3天 abc 買")], "file string, text string"))
    got = {(r.file, r.line_no, r.rule): r.found for r in L.issues(lines).collect()}
    assert got == {("a", 0, "absolute"): "保證", ("a", 0, "price"): "便宜", ("a", 2, "length"): "short", ("b", 0, "digits"): "3", ("b", 0, "latin"): "abc"}


def test_template_values_are_not_filled_again(spark):
    got = spark.range(1).select(specs.fill("<{a}> {{x}} {b}", {"a": F.lit("{b}"), "b": F.lit("y")}).alias("t")).first()["t"]
    assert got == "<{b}> {x} y"


def test_image_kernels():
    image = np.full((60, 60, 3), 255, dtype=np.uint8)
    image[10:50, 20:40] = 30
    m = photo.measure("p", image)
    assert (m["objects"], m["width"], m["height"], m["at_edge"], m["uniform"]) == (1, 20, 40, False, 1.0)
    assert m["solidity"] == pytest.approx(1.0)
    image[5:12, 2:9] = 30
    assert photo.measure("p", image)["objects"] == 2
    tiles = np.tile(np.kron(np.array([[0, 255, 90], [40, 0, 200]]), np.ones((6, 6))), (4, 3))
    assert photo.repeat(tiles, np.ones(tiles.shape, dtype=bool)) > 0.75
    assert photo.measure("p", None)["readable"] is False


def test_row_index(spark):
    got = row_index(spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")), ["v"]).collect()
    assert {(r.v + 1, r.idx) for r in got} == {(i, i) for i in range(1, 1001)}
    assert row_index(spark.range(0), ["id"]).count() == 0


def test_whole_texts_are_linted(spark, tmp_path):
    import __spark_entry__ as entry

    # What breaks rules, and the endings, lie beyond character 160.
    rows = [(1, 1, "x" * 200 + "\nab12\nqqq\rqqq"), (1, 7, "7 here"), (1, 8, None), (2, 1, "x" * 200 + "\nab12\nqqq")]
    spark.createDataFrame(rows, "conv_id long, turn long, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    run = lambda name: entry.queries()[name](spark, str(tmp_path)).collect()
    assert {(r.file, r.line_no) for r in run("lint_hits") if r.rule == "digits"} == {(1001, 1), (1007, 0), (2001, 1)}
    assert {(r.file, r.line_no): r.bare for r in run("lint_lengths")} == {(1001, 0): 200, (1001, 1): 4, (1001, 2): 3, (1001, 3): 3, (1007, 0): 5, (2001, 0): 200, (2001, 1): 4, (2001, 2): 3}
    assert {(r.file, r.line_no) for r in run("lint_adjacent")} == {(1001, 3)}
    from siftstone.plans.narration import _FROM, _TO

    q = _TO[_FROM.index("q")]
    assert [(r.package, r.n) for r in run("lint_bigrams") if r.gram == q + q] == [(1, 4)]  # counted by package, and only if it has several files
    assert {r.package: r.files for r in run("lint_summary")} == {1: 3, 2: 1}
    hard = {r.package: r.hard for r in run("lint_summary")}
    hits = [r.file // 1000 for r in run("lint_hits") if r.hard]
    assert hard == {1: hits.count(1) + 1, 2: hits.count(2)}


WHOLE = ("lint_hits", "lint_lengths", "lint_bigrams", "lint_adjacent", "lint_summary")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", WHOLE)
def test_whole_lint_against_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry

    c = duckdb.connect()
    c.sql(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    df = entry.queries()[name](spark, DATA)
    expected = c.sql(entry.oracle_sql()[name])
    at = [expected.columns.index(x) for x in df.columns]
    assert sorted(map(tuple, df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in expected.fetchall()), key=str)


def test_rule_files_and_done_lists(tmp_path):
    import json

    from siftstone.sources import config

    good = {
        "stage": 2, "categories": {"a": ["x"]}, "later_stage_categories": {}, "min_monthly_sales": 1000, "trap_commission_min": 15, "same_product_min_stores": 4, "same_flavor_max_reject": 2,
        "done_policy": {"same_brand_same_series": "exclude", "same_brand_other_series": "mark"}, "require_bonus": False, "offer_end_policy": "mark", "sort": ["monthly_sales desc"], "promo_words": ["p"],
        "flavor_words": [], "capacity_pattern": "x+", "_note": 1,
    }

    def rules(**changed):
        path = tmp_path / "rules.json"
        path.write_text(json.dumps({k: v for k, v in (good | changed).items() if v is not None}), encoding="utf-8-sig")
        return config.load_rules(str(path))

    assert rules().stage == 2 and rules(brand_aliases={"b": ["c"]}).alias() == {"b": "b", "c": "b"}
    for bad in ({"stage": None}, {"capacity_pattern": "("}, {"sort": ["price up"]}, {"brand_aliases": {"b": "c"}}, {"done_policy": {}}, {"offer_end_policy": "x"}, {"categories": ["x"]}, {"require_bonus": "yes"}):
        with pytest.raises(config.ConfigError, match=next(iter(bad))):
            rules(**bad)
    with pytest.raises(config.ConfigError, match="stage.*promo_words"):  # all of them are named
        rules(stage=None, promo_words=None)
    for encoding in ("utf-8", "utf-8-sig", "cp950"):
        path = tmp_path / "done.txt"
        path.write_bytes("# 註\n舊識牌｜豆漿\n 另牌 \n\n".encode(encoding))
        assert config.load_done(str(path)) == (("舊識牌", "豆漿"), ("另牌", ""))


def test_candidate_cells(spark):
    from datetime import date
    from decimal import Decimal

    from siftstone.operators import candidates as C
    from siftstone.operators import offers as O
    from siftstone.plans.shared import row_index

    rules = O.Rules(min_monthly_sales=Decimal(10), same_product_min_stores=2, done_policy={"same_brand_same_series": "demote", "same_brand_other_series": "mark"}, offer_end_policy="exclude_member")
    base = dict.fromkeys(O.FIELDS, "") | {"title": "牌 豆漿", "name": "牌 豆漿", "offer_end": "2026/12/31", "bonus": "是", "category": ""}
    rows = [
        base | {"idx": 1, "shop_id": "1", "item_id": "9", "price": "$100", "monthly_sales": "3萬+", "commission_rate": "3%", "sv_rate": "10%", "sv_bonus": "abc", "shop_type": "商城"},
        base | {"idx": 2, "shop_id": "2", "item_id": "9", "price": "洽詢", "monthly_sales": "500", "commission_rate": "5%"},
        base | {"idx": 3, "shop_id": "3", "item_id": "9", "price": "$80", "monthly_sales": "40", "sv_rate": "10%", "sv_bonus": "1%"},
        base | {"idx": 4, "shop_id": "4", "item_id": "9", "price": "$80", "monthly_sales": "40", "offer_end": "2020/1/1"},
        base | {"idx": 5, "title": "別 茶", "name": "別 茶", "price": "", "monthly_sales": "70", "offer_end": "", "commission_rate": "4%"},
    ]
    raw = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in (*O.FIELDS, "name")) + ", idx long")
    o = O.screened(raw, rules, date(2026, 1, 1))
    groups = O.group_table(o, row_index)
    got = {r["組名"]: r.asDict() for r in C.candidate_rows(o, O.ranked(o, rules, row_index), groups).collect()}
    bean, tea = got["牌 豆漿"], got["別 茶"]
    assert bean["各家（賣場類型 shop/item）"] == "列 1 商城 1/9；列 2 ? 2/9；列 3 ? 3/9" and bean["價"] == "列 1 $100；列 2 「洽詢」；列 3 $80"
    assert bean["月銷"] == "30000｜列 1 30000+（3萬+）；列 2 500（500）；列 3 40（40）" and bean["列表分潤率"] == "列 1 3%；列 2 5%；列 3 空白"
    assert bean["每單約 $（哪一家、實／估）"] == "8.80（列 3，實）；列 1 列表分潤 3%；短影音獎勵讀不到（「abc」），改用列表估＝3.00（估）；列 2 算不出來（價格讀不到（「洽詢」））"
    assert bean["同款家數（前台／CSV／待數）"] == "3（CSV）" and bean["標記"].startswith("列 4 推廣已到期，只剩列 1、2、3；列 1 未分類（待人判）；列 1 短影音獎勵讀不到")
    assert bean["下一步"] == "開詳情看短影音那列；詳情看價格"
    assert tea["每單約 $（哪一家、實／估）"] == "算不出來（列 5 價格空白）" and tea["同款家數（前台／CSV／待數）"] == "待數（CSV 1 家有效）" and tea["價"] == "列 5 空白"
    assert tea["標記"] == "沒有 shop/item；未分類（待人判）；到期日待查" and tea["下一步"] == "開詳情看短影音那列；前台數家數；詳情看價格；人判品類；看加碼到期日"
    out = C.exclusion_rows(o, groups).collect()
    assert [(r["列"], r["理由"], r["備註"]) for r in out] == [(4, "推廣已到期（2020/1/1 早於 2026-01-01）", "同組列 1、2、3 照留")]
    lines = [r.line for r in C.report(C.candidate_rows(o, O.ranked(o, rules, row_index), groups), C.exclusion_rows(o, groups), rules, "2026-01-01", [("a.csv", 5)]).collect()]
    assert lines[2] == "來源：a.csv（5 列）" and lines[-1] == "- 列 4 牌 豆漿：推廣已到期（2020/1/1 早於 2026-01-01）" and sum(x.startswith("| 1 |") for x in lines) == 1
