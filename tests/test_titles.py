"""Titles and normal forms by built-in functions against plain Python."""

import random
import unicodedata

from pyspark.sql import functions as F
from title_reference import cleaner

from siftstone.functions import parse
from siftstone.functions.titles import strip_title
from siftstone.operators.offers import Rules

RULES = Rules(brand_aliases={"舊識牌": ["old", "older"], "Brand": ["b#1"]}, flavor_words=("紅茶", "red", "原味", "紅茶拿鐵"), promo_words=("現貨", "買一送一", "現貨供應"), capacity_pattern=r"\d+(ml|g|入)")


def test_titles(spark):
    r = random.Random(5)
    bits = ["【", "】", "[", "]", "(", ")", "（", "）", "「", "》", "現貨", "現貨供應", "買一送一", "紅茶", "紅茶拿鐵", "red", "原味", "OLD", "Older", "舊識牌", "b#1", "300ml", "５入", " ", "　", "x", "é", "é", "ｶﾞ", "|", "-", "，", "/", "\t", "字"]
    titles = [None, "", " - "] + ["".join(r.choice(bits) for _ in range(r.randint(1, 24))) for _ in range(700)]
    clean = cleaner(RULES)
    found = spark.createDataFrame(list(enumerate(titles)), "id int, t string").select("id", "t", strip_title(F.col("t"), RULES).alias("x")).collect()
    for row in found:
        assert (row.x.name, row.x.removed) == clean(row.t), repr(row.t)


def test_composition(spark):
    r = random.Random(6)
    marks = [chr(k) for k in (0x300, 0x301, 0x302, 0x303, 0x304, 0x308, 0x323, 0x327, 0x328, 0x331, 0x345, 0x5B0, 0x5B4, 0x3099, 0x309A, 0x93C)]
    bases = list("aeiouAEOsdzくカハき") + ["é", "ạ", "ǭ", "ﬁ", "ｶ", "①", "字", "Ω", "ẛ", "ᾳ", "क", "א", " "]
    texts = ["".join(r.choice(marks if r.random() < 0.5 else bases) for _ in range(r.randint(1, 9))) for _ in range(1500)]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse.composed(parse.folded(F.col("t"))).alias("x")).collect()
    wrong = [(x.t, x.x, unicodedata.normalize("NFKC", x.t)) for x in found if x.x != unicodedata.normalize("NFKC", x.t)]
    assert not wrong, wrong[:5]
