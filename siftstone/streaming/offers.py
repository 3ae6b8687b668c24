"""Offers that arrive as files: grouping and ranking are global, so each batch adds rows and the plan runs over all of them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siftstone.operators import offers as O
from siftstone.plans.shared import row_index


def follow(spark: SparkSession, source: str, state: str, output: str, rules: O.Rules, today: date, checkpoint: str) -> StreamingQuery:
    """Watches folder `source` for Parquet files of raw offers (the sixteen fields, name and a sequence number seq).

    Each batch is written to its own folder below `state` (so that a repeated
    batch replaces itself), then all rows so far are screened and the ranked
    groups written to `output`.
    """
    schema = ", ".join(f"{f} string" for f in O.FIELDS) + ", name string, seq long"

    def batch(new: DataFrame, number: int) -> None:
        new.write.mode("overwrite").parquet(f"{state}/batch={number}")
        rows = row_index(spark.read.schema(schema).parquet(state).drop("batch"), ["seq"])
        O.ranked(O.screened(rows, rules, today), rules, row_index).drop("key").write.mode("overwrite").parquet(output)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
