import shutil

from siftstone.plans import screening, shared

SF = "/root/testdata/sf0.001"


def test_shared_tables_follow_their_input(spark, tmp_path):
    for name in ("lineitem", "part"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path)
    sf_dir = str(tmp_path)
    whole = screening.offers(spark, sf_dir)
    assert screening.offers(spark, sf_dir).inputFiles() == whole.inputFiles()
    n = whole.count()
    part = spark.read.parquet(f"{SF}/lineitem.parquet").limit(50)
    (tmp_path / "lineitem.parquet").unlink()
    part.write.parquet(f"{sf_dir}/lineitem.parquet")
    fresh = screening.offers(spark, sf_dir)
    assert n > 50 == fresh.count() and shared.indexed_table(spark, sf_dir, "lineitem", ["l_orderkey"]).count() == 50
    shared.forget()
    assert screening.offers(spark, sf_dir).inputFiles() != fresh.inputFiles()


def test_rows_of_the_screening_are_shuffled_before_they_grow(spark):
    """No join or exchange has parsed numbers, reasons or marks below it."""
    from siftstone.operators import offers as O

    o = O.ruled(screening.raw_offers(spark, SF, firsts=True), screening.RULES, screening.TODAY)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = o._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    above, below = plan.split("Join", 1)
    assert "regexp_replace" in above and "regexp_replace" not in below
    assert {f.split("/")[-2].split("-")[0] for f in screening.offers(spark, SF).inputFiles()} == {"ruled", "stores"}
