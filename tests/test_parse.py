from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siftstone.functions import parse, texts

COUNTS = {"3萬+": (30000, True), "6,000+": (6000, True), "1.2萬": (12000, False), "50萬+ sold": (500000, True), "1,000+": (1000, True), "500+": (500, True), "10萬+": (100000, True), "２千": (2000, False)}


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text", COUNTS)
def test_counts(spark, text):
    got = one(spark, parse.parse_count(F.lit(text)))
    assert (got["value"], got["plus"], got["ok"]) == (Decimal(COUNTS[text][0]), COUNTS[text][1], True)


def test_three_states(spark):
    states = [one(spark, parse.state(p(F.lit(t)))) for p, t in ((parse.parse_price, "洽詢"), (parse.parse_price, ""), (parse.parse_price, "$1,299"), (parse.parse_rate, "10.5"), (parse.parse_rate, "10.5%"), (parse.parse_price, "$59 - $99"))]
    assert states == ["unreadable", "blank", "value", "unreadable", "value", "unreadable"]


def test_dates(spark):
    rows = spark.createDataFrame([("2026/12/31",), ("2026.1.5",), ("2026/13/1",), ("",), ("soon",)], "t string").select(parse.parse_date(F.col("t")).alias("d")).collect()
    assert [(str(r.d.value), r.d.ok) for r in rows] == [("2026-12-31", True), ("2026-01-05", True), ("None", False), ("None", True), ("None", False)]


def test_earnings_round_half_up_and_keep_unreadable_apart(spark):
    def pay(price, rate, sv, bonus):
        p = parse.per_order(parse.parse_price(F.lit(price)), *[parse.parse_rate(F.lit(t)) for t in (rate, sv, bonus)])
        return tuple(one(spark, p))

    assert pay("$99", "", "10.5%", "") == (Decimal("10.40"), "real")
    assert pay("$100", "3%", "10%", "xyz") == (Decimal("3.00"), "estimate")
    assert pay("$100", "3%", "abc", "1%") == (Decimal("3.00"), "estimate")
    assert pay("洽詢", "3%", "10%", "1%") == (None, None)


def test_wide_numbers_and_forms(spark):
    assert one(spark, parse.state(parse.parse_count(F.lit("99999999999999萬")))) == "unreadable"
    assert one(spark, parse.parse_count(F.lit("⑫千＋")))["value"] == 12000 and one(spark, parse.parse_count(F.lit("\t①,０００+\n")))["plus"] is True
    assert one(spark, parse.parse_price(F.lit("ＮＴ＄１，２９９．５元")))["value"] == Decimal("1299.5")
    assert one(spark, parse.parse_rate(F.lit("㏂")))["ok"] is False and one(spark, parse.parse_price(F.lit("1\x00")))["ok"] is True

    def pay(price, rate):
        p = parse.per_order(parse.parse_price(F.lit(price)), parse.parse_rate(F.lit(rate)), parse.parse_rate(F.lit("")), parse.parse_rate(F.lit("")))
        return one(spark, p)["value"]

    assert pay("99999999999", "1%") == Decimal("999999999.99")
    assert pay("0.00999", "50%") == Decimal("0.00") and pay("0.01", "50%") == Decimal("0.01")
    assert pay("99999999999999", "99999999%") is None


def test_urls(spark):
    got = [tuple(one(spark, parse.ids_from_url(F.lit(u)))) for u in ("x/product/12/34", "x-i.5.6?a", "x?shopid=7&b&itemid=8", "x")]
    assert got == [("12", "34"), ("5", "6"), ("7", "8"), (None, None)]


def test_small_texts(spark):
    assert one(spark, texts.parse_box(F.lit("1.5, 2.5,3,4"))).asDict() == {"x": 2, "y": 2, "w": 3, "h": 4}
    assert one(spark, texts.parse_box(F.lit("1,2,0,4"))) is None
    assert one(spark, texts.parse_frames(F.lit("2,0,2"), F.lit(3))) == [0, 2]
    assert one(spark, texts.parse_frames(F.lit("3"), F.lit(3))) is None
    assert one(spark, texts.bigrams(F.lit("好，的呀"))) == ["好的", "的呀"]
    assert one(spark, parse.nfkc(F.lit("　ＡＢ①"))) == "AB1"
