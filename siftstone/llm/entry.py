"""Queries of this subpackage and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftstone.llm.bpe import op4_byte_bpe
from siftstone.llm.decontaminate import OP5_SQL, op5_benchmark_decontamination
from siftstone.llm.jaccard_join import OP3_SQL, op3_jaccard_join
from siftstone.llm.media import op8_transport_stream
from siftstone.llm.negatives import OP13_SQL, op13_hard_negatives
from siftstone.llm.quality import op2_quality_ranking
from siftstone.llm.secrets import op10_secret_scan
from siftstone.llm.substring_dedup import OP1_SQL, op1_substring_dedup
from siftstone.llm.token_counts import op6_token_counts
from siftstone.llm.topk import OP11_SQL, op11_vector_file_topk
from siftstone.llm.toxicity import op9_toxicity
from siftstone.llm.upsert import op12_copy_on_write_upsert
from siftstone.llm.warc import OP7_SQL, op7_warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_substring_dedup, op2_quality_ranking, op3_jaccard_join, op4_byte_bpe, op5_benchmark_decontamination, op6_token_counts,
        op7_warc, op8_transport_stream, op9_toxicity, op10_secret_scan, op11_vector_file_topk, op12_copy_on_write_upsert, op13_hard_negatives,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1_SQL, "op3_jaccard_join": OP3_SQL, "op5_benchmark_decontamination": OP5_SQL, "op7_warc": OP7_SQL, "op11_vector_file_topk": OP11_SQL, "op13_hard_negatives": OP13_SQL}
