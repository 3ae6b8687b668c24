import pytest


@pytest.mark.parametrize("name", ("pixel_components", "component_stats", "background_median", "orientation_entropy"))
def test_pixels_near_whole_numbers_against_sql(spark, tmp_path, name):
    """Times 1000, these floats are whole numbers as floats, and just below them as doubles."""
    import duckdb

    import __spark_entry__ as entry

    edge = [-0.061000000685453415, -0.14900000393390656, 0.05299999937415123, 0.07199999690055847, 0.1979999989271164]
    rows = [(k, [edge[(k + i) % 5] if (i * 7 + k) % 3 else 0.01 * (i % 9) for i in range(64)]) for k in range(6)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    df = entry.queries()[name](spark, str(tmp_path))
    expected = c.sql(entry.oracle_sql()[name])
    at = [expected.columns.index(x) for x in df.columns]
    assert sorted(map(tuple, df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in expected.fetchall()), key=str)
