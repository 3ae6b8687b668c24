"""The screening's shared steps: what is shuffled, and what is interpreted row by row."""

from siftstone.functions import parse
from siftstone.operators import offers as O
from siftstone.plans import screening as S
from siftstone.plans import shared
from siftstone.plans.shared import row_index
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parsers_have_no_lambdas(spark):
    texts = spark.createDataFrame([("３萬+",), ("1\x002",), (None,)], "x string")
    plain = lambda raw: F.btrim(raw)
    for parser in (parse.parse_count, parse.parse_price, parse.parse_rate, parse.parse_stores, parse.parse_date):
        assert "lambda" not in _plan(texts.select(parser(F.col("x"), plain)))
    got = [r.p for r in texts.select(parse.parse_count(F.col("x")).alias("p")).collect()]
    assert [(p.value, p.plus, p.ok) for p in got] == [(30000, True, True), (None, False, False), (None, False, True)]


def test_narrow_is_nfkc(spark):
    import unicodedata

    # Each way through narrow(): ASCII, full-width, ideographs, and what needs the whole table.
    rows = [" a1 ", "　＄５０ ", "月銷５千件", "３㎏", "ﾊ", "①萬", "x\x00"]
    got = spark.createDataFrame([(r,) for r in rows], "x string").select("x", parse.narrow(F.col("x")).alias("n")).collect()
    assert [r.n for r in got] == [unicodedata.normalize("NFKC", r.x).strip() for r in got]


def test_no_text_of_offers_is_shuffled(spark):
    """Lines meet names in their join with parts: above it no join is by a text."""
    raw = S.raw_offers(spark, DATA, firsts=True, names=True)
    plan = _plan(raw)
    above = plan[: plan.index("l_partkey")]
    assert "Join" in plan and "name" not in "".join(x for x in above.splitlines() if "Join" in x)
    want = O.categorised(O.named(S.raw_offers(spark, DATA, firsts=True), S.RULES), S.RULES)
    columns = ["idx", "name", "brand", "series", "flavour", "key", "done", "cat_now", "cat_later", "category_label", "first_idx", "price"]
    assert sorted(raw.select(columns).collect(), key=str) == sorted(want.select(columns).collect(), key=str)


def test_names_of_parts_without_lines_are_no_brands(spark, tmp_path):
    line = {"l_orderkey": 1, "l_partkey": 1, "l_suppkey": 1, "l_linenumber": 1, "l_quantity": 1.0, "l_extendedprice": 1.0, "l_discount": 0.0, "l_tax": 0.0, "l_returnflag": "N", "l_linestatus": "O"}
    spark.createDataFrame([line]).withColumn("l_shipdate", F.lit("1999-01-01").cast("timestamp")).withColumn("l_linenumber", F.col("l_linenumber").cast("int")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "hot bolt", "Mark#55", "LARGE"), (2, "hot bolt", "Mark#5", "LARGE")], "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    assert [r.brand for r in S.raw_offers(spark, str(tmp_path), firsts=True, names=True).collect()] == ["Mark#55"]


def test_groups_of_counted_names(spark):
    raw = spark.createDataFrame([(1, "A#1 x red"), (2, "B y"), (3, "A#1 x red"), (4, None), (5, "a#1 X red")], "idx long, name string")
    columns = ["group_name", "first", "members", "gid"]
    got = O.named_groups(raw, S.RULES, row_index).select(columns)
    assert sorted(got.collect(), key=str) == sorted(O.group_table(O.named(raw, S.RULES), row_index).select(columns).collect(), key=str)
    assert ("A#1 x red", 1, 3) in [tuple(r)[:3] for r in got.collect()]


def _broadcast(df):
    """The plans below each exchange that sends a table to all tasks."""
    lines, found = df._jdf.queryExecution().executedPlan().toString().splitlines(), []
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    for k, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(k + 1, len(lines)) if depth(lines[j]) <= depth(line)), len(lines))
            found.append("\n".join(lines[k + 1 : end]))
    return found


def test_tables_made_of_data_are_not_broadcast(spark, monkeypatch):
    """Files of few bytes may hold many rows: those of parts take 6 bytes a row, and the driver's memory a hundred."""
    few, offers = "spark.sql.autoBroadcastJoinThreshold", S.offers(spark, DATA)
    monkeypatch.setattr(shared, "FEW", 10, raising=False)
    before = spark.conf.get(few)
    spark.conf.set(few, "20000")  # the parts' file has fewer bytes, that of the lines more
    try:
        for names in (False, True):
            raw = S.raw_offers(spark, DATA, firsts=True, names=names)
            assert "Join" in _plan(raw) and not [p for p in _broadcast(raw) if "p_partkey" in p]
        words = spark.createDataFrame([("ab",), ("a",)], "word string")
        assert not _broadcast(O.longest_known_prefix(words, words))
        for df in (S.exclusion_rows(spark, DATA), S.candidate_rows(spark, DATA), S.groups_json(spark, DATA)):
            assert not [p for p in _broadcast(df) if "group_name" in p]
    finally:
        spark.conf.set(few, before)


def test_plans_are_short(spark):
    """The driver keeps the text of each plan, and anew after each stage: long tables stand in it once for a text."""
    o = O.ruled(S.raw_offers(spark, DATA, firsts=True, names=True), S.RULES, S.TODAY)
    plan = o.select("idx", "reasons", "marks", "demote")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert len(plan) < 600_000
    assert not [c for c in o.columns if c.startswith("__")]
