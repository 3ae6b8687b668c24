import os

import duckdb
import pytest

DATA = "/root/testdata/sf0.001"
QUICK = ("parse_counts", "per_order_half_up", "series_keys", "category_assign", "segment_verdict", "lint_hits", "spec_violations", "prompt_render", "box_iou", "verdict_counts", "card_layout", "card_verdicts", "label_box_json", "frame_rows", "verdict_severity", "screen_sort", "judge_tighten", "background_median", "strip_titles")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", QUICK)
def test_query_against_sql(spark, name):
    import __spark_entry__ as entry

    c = duckdb.connect()
    for file in os.listdir(DATA):
        c.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    expected = c.sql(entry.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    at = [expected.columns.index(x) for x in columns]
    assert sorted((tuple(r[x] for x in columns) for r in df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in expected.fetchall()), key=str)


def test_every_sql_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
