"""Shared folders, written tables and small Column helpers of the corpus operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids stand for themselves; a null id sorts after every other.
LAST_ID = (1 << 63) - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset on one machine, a temporary one that goes with the process."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="siftstone-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/siftstone/{name}-{uuid.uuid4().hex}"


#: With this on, the shuffle files of a statement go when it ends, not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, path: str, rows: int | None = None) -> DataFrame:
    """df written as Parquet and read back: its lineage ends there, and a lost executor loses nothing of it.

    rows: how many wide rows at once go to Python at most.
    """
    spark = df.sparkSession
    before = {_CLEANUP: spark.conf.get(_CLEANUP), _BATCH: spark.conf.get(_BATCH)}
    spark.conf.set(_CLEANUP, "true")
    if rows:
        spark.conf.set(_BATCH, rows)
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """work, and then free memory goes back to the system: a Python worker outlives its task and may stand idle beside others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
                ctypes.CDLL(None).malloc_trim(0)

    return run


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    return next(name for k in range(len(taken) + 1) if (name := f"{base}_{k}" if k else base) not in taken)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; lower() would also change letters beyond ASCII."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
