"""Tables, written intermediate results and row numbers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset on one machine, a temporary one that goes with the process."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="siftstone-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder."""
    path = f"{shared_dir(df.sparkSession)}/siftstone/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df's rows dealt evenly over as many tasks as shuffles have: for costly work on rows that lie in few files or partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


#: Rows of a table that may be sent to all tasks.
FEW = 100_000


def joinable(df: DataFrame) -> DataFrame:
    """df, a table that is read as it was written, for a join: by shuffles if it has more than FEW rows.

    The bytes of its files, by which Spark judges it, say little of its rows in
    the memory of the driver, through which all goes that is sent to all tasks.
    """
    return df if df.count() <= FEW else df.hint("merge")


def row_index(df: DataFrame, order: list[Column | str], name: str = "idx") -> DataFrame:
    """df with 1, 2, ... in the given order, without sending all rows to one task.

    Rows are range-partitioned, sorted and written once with their place in
    their partition, which is then shifted by the sizes of the partitions before.
    """
    spark, bits = df.sparkSession, 33  # as monotonically_increasing_id() has it: partition, then place
    parts, at = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name}__at"
    ranged = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "ranged")
    sizes = ranged.groupBy(F.shiftright(at, bits).alias("part")).count().collect()  # a row for each partition
    before, total = [], 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        before += [F.lit(r["part"]).cast("long"), F.lit(total).cast("long")]
        total += r["count"]
    shift = F.element_at(F.create_map(*before), F.shiftright(at, bits)) if before else F.lit(0).cast("long")
    return ranged.withColumn(name, (F.col(at).bitwiseAND((1 << bits) - 1) + shift + 1).cast("long")).drop(at)


#: key: (state of the tables that were read, written table)
_KEPT: dict[tuple[str, ...], tuple[list[tuple[int, int, int]], DataFrame]] = {}


def _file_system(spark: SparkSession, name: str) -> tuple:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _state(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> list[tuple[int, int, int]]:
    """Bytes, files and time of change of each table; two calls for each, however many files it has."""
    found = []
    for name in names:
        path, fs = _file_system(spark, f"{sf_dir}/{name}.parquet")
        size = fs.getContentSummary(path)
        found.append((size.getLength(), size.getFileCount(), fs.getFileStatus(path).getModificationTime()))
    return found


def kept(spark: SparkSession, key: str, sf_dir: str, reads: tuple[str, ...], make: Callable[[], DataFrame]) -> DataFrame:
    """make(), a written table, once for a session.

    Its queries share it as long as the written files are there and the tables of sf_dir that it reads are as they were.
    """
    place, state = (spark.sparkContext.applicationId, key, sf_dir), _state(spark, sf_dir, reads)
    before, known = _KEPT.get(place, (None, None))
    if known is not None and before == state and (files := known.inputFiles()):
        path, fs = _file_system(spark, files[0])
        if fs.exists(path):
            return known
    known = make()
    _KEPT[place] = state, known
    return known


def forget() -> None:
    """The next query works all out anew."""
    _KEPT.clear()


def indexed_table(spark: SparkSession, sf_dir: str, name: str, order: list[str], index: str = "idx") -> DataFrame:
    """row_index() of a table, kept for the session's queries."""
    return kept(spark, f"indexed {name}", sf_dir, (name,), lambda: row_index(table(spark, sf_dir, name), order, index))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
