"""A corpus pipeline of five stages.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next stage's docs.  All but the last return the
columns of documents.

Defined results: null and empty texts pass every stage and give no ids; rows
with a null id are documents of their own unless their texts link; of repeated
rows all stay or go; an empty table gives an empty one; extra columns, of any
name, pass the stages before the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftstone.llm import decontaminate, jaccard_join, secrets, toxicity
from siftstone.llm.bpe import encode_documents
from siftstone.llm.runtime import remove, table, work_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon rejects go; it is learned from the labelled documents of sf_dir."""
    return toxicity.keep_clean(docs, toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays."""
    return jaccard_join.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; n_chars follows the text."""
    return secrets.redact(docs, length="n_chars")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the decoded bytes."""
    return encode_documents(docs, keep_ids=True)


STAGES = [("toxicity", drop_toxic), ("jaccard_join", drop_near_copies), ("decontamination", drop_contaminated), ("secret_scan", redact_secrets), ("byte_bpe", encode)]

#: The learned lexicon and the byte-pair encoding are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), work_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{path}/{k}")
            docs = spark.read.parquet(f"{path}/{k}")
            if k:
                remove(spark, f"{path}/{k - 1}")
    return docs
