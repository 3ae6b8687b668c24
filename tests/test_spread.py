import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ("card_layout", "strip_titles", "strip_titles_mixed", "per_order_half_up"))
def test_costly_work_does_not_hang_on_the_number_of_files(spark, name):
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    if name == "per_order_half_up":  # texts are parsed after they were counted
        assert plan.index("regexp_replace") < plan.index("HashAggregate") and "regexp_replace" not in plan[plan.index("HashAggregate") :]
