"""Copy-on-write keyed upsert of a folder of sorted Parquet files.

`lay_out` writes a table as files of a given number of rows in the order of an
integer key.  `upsert` applies keyed changes by set algebra: rows of deleted
keys go by an anti-join, rows of set keys change by an inner join, keys that
are not there yet come by an anti-join.  EXCEPT ALL in both directions between
the rows before and after tells which files' rows differ; only those are
written anew, in a staging folder, then moved in, and what they replace goes.

Rows are ranked by range partitions whose sizes are summed up, so no task sees
more than its partition; a file is written by the task that holds its rows.
What goes to the driver or into a broadcast are numbers by file (at most 1,000
starting files by the contract's rule, whatever the input) and by partition.

Defined results: rows with a null key are left out of the files and changes
with a null key are ignored; repeated keys stay beside each other and change
alike, equal keys are ordered by the other columns; a null sequence number is
below any other; of equal numbers the larger change id, then the larger of the
other columns, wins; without starting files nothing has a home and nothing is
written; empty changes leave all files; texts may be of any length that fits a
row; extra columns, of any name, are written as they are and are null in
inserted rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.runtime import fresh_name, table, tidy, work_dir, written

_BITS = 33  # of monotonically_increasing_id(): partition, then place
SET = ("source", "segment", "city", "balance")


@dataclass(frozen=True)
class File:
    path: str
    first: int
    last: int
    rows: int


# ── ranks and files ──────────────────────────────────────────────────────────
def placed(df: DataFrame, group: str, order: list[str], place: str, path: str) -> tuple[DataFrame, dict[int, int]]:
    """df with the 0-based place of each row in its group, and the groups' sizes; order begins with group."""
    spark, at, part = df.sparkSession, fresh_name(df, "at"), fresh_name(df, "part")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), path)
    ranged = ranged.withColumns({part: F.shiftright(at, _BITS).cast("int"), at: F.col(at).bitwiseAND((1 << _BITS) - 1)})
    sizes: dict[int, int] = {}
    shifts = []  # a row for each partition and each group in it, which are neighbours
    for r in ranged.groupBy(part, group).agg(F.count("*").alias("n"), F.min(at).alias("first")).orderBy(part, group).collect():
        p, g, n, first = r
        shifts.append((p, g, sizes.get(g, 0) - first))
        sizes[g] = sizes.get(g, 0) + n
    shift = fresh_name(ranged, "shift")
    small = spark.createDataFrame(shifts, f"`{part}` int, `{group}` {df.schema[group].dataType.simpleString()}, `{shift}` long")
    return ranged.join(F.broadcast(small), [part, group]).withColumn(place, F.col(at) + F.col(shift)).drop(at, part, shift), sizes


def _moved(spark: SparkSession, source: str, folder: str, name: str) -> dict[int, str]:
    """Part files of source go to folder as name-<partition>.parquet; their paths by partition."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # noqa: N806
    fs, found = Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), {}
    fs.mkdirs(Path(folder))
    for status in fs.listStatus(Path(source)):
        file = status.getPath()
        if file.getName().startswith("part-"):
            number = int(file.getName().split("-")[1])
            target = f"{folder}/{name}-{number:06d}.parquet"
            if not fs.rename(file, Path(target)):
                raise OSError(f"{file} can't be moved to {target}")
            found[number] = target
    fs.delete(Path(source), True)
    return found


def _write(df: DataFrame, file: str, count: int, order: list[str], columns: list[str], folder: str, name: str, staging: str) -> dict[int, str]:
    """A file for each number 0 <= file < count, each written by one task."""
    df.repartitionById(count, F.col(file).cast("int")).sortWithinPartitions(*order).select(*columns).write.parquet(staging)
    return _moved(df.sparkSession, staging, folder, name)


def _quoted(columns: list[str]) -> list[str]:
    return ["`" + c.replace("`", "``") + "`" for c in columns]


def lay_out(df: DataFrame, key: str, per_file: int, folder: str, staging: str) -> list[File]:
    """df by key in files of per_file rows, the last with the rest."""
    rows, columns = df.filter(F.col(key).isNotNull()), _quoted(df.columns)
    group, place = fresh_name(df, "whole"), fresh_name(df, "place")
    order = [f"`{group}`", f"`{key}`", *[c for c in columns if c != f"`{key}`"]]
    ranked, sizes = placed(rows.withColumn(group, F.lit(0)), group, order, place, f"{staging}/ranked")
    total = sizes.get(0, 0)
    if not total:
        return []
    count, file = -(-total // per_file), fresh_name(ranked, "file")
    ranked = ranked.withColumn(file, F.floor(F.col(place) / per_file))
    bounds = ranked.groupBy(file).agg(F.min(key).alias("a"), F.max(key).alias("b"), F.count("*").alias("n")).collect()
    paths = _write(ranked, file, count, order, columns, folder, "start", f"{staging}/start")
    return [File(paths[r[file]], r["a"], r["b"], r["n"]) for r in sorted(bounds, key=lambda r: r[file])]


# ── changes ──────────────────────────────────────────────────────────────────
def home_of(key: Column, firsts: list[int]) -> Column:
    """Number of the last file that begins at or below key, else 0: a binary search in a constant."""
    begins = F.lit(firsts)
    steps = [1 << b for b in reversed(range(max(1, len(firsts)).bit_length()))]
    return F.aggregate(F.lit(steps), F.lit(0), lambda at, s: F.when((at + s < len(firsts)) & (F.get(begins, at + s) <= key), at + s).otherwise(at))


def winners(changes: DataFrame, key: str, sequence: list[str], payload: list[str]) -> DataFrame:
    """The change of each key with the highest sequence columns: (key, change struct)."""
    ordered = F.struct(*[F.col(c) for c in sequence], *[F.col(c) for c in payload if c not in sequence])
    return changes.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(ordered).alias("change"))


def applied(before: DataFrame, deletes: DataFrame, sets: DataFrame, key: str, home: str, columns: list[str], set_columns: tuple[str, ...]) -> DataFrame:
    """before (columns and home) with deletes and sets (key, home, change) applied."""
    change, new_home = fresh_name(before, "change"), fresh_name(before, "new_home")
    sets = sets.select(key, F.col("change").alias(change), F.col("home").alias(new_home))
    value = lambda c, old: F.col(change)[c].alias(c) if c in set_columns else old
    # All of these grow with the input, so none is broadcast.
    keys, sets = sets.select(key).hint("merge"), sets.hint("merge")
    left = before.join(deletes.select(key).hint("merge"), key, "left_anti")
    untouched = left.join(keys, key, "left_anti").select(home, *_quoted(columns))
    updated = left.join(sets, key).select(home, *[value(c, F.col(q)) for c, q in zip(columns, _quoted(columns), strict=True)])
    added = sets.join(before.select(key).hint("merge"), key, "left_anti")
    null = lambda c: F.col(key) if c == key else F.lit(None).cast(before.schema[c].dataType).alias(c)
    inserted = added.select(F.col(new_home).alias(home), *[value(c, null(c)) for c in columns])
    return untouched.unionAll(updated).unionAll(inserted)


def differing(before: DataFrame, after: DataFrame, home: str) -> list[int]:
    """Homes whose rows differ: EXCEPT ALL in both directions."""
    gone, come = before.exceptAll(after).select(home), after.exceptAll(before).select(home)
    return sorted(r[0] for r in gone.unionAll(come).distinct().collect())


def new_files(files: int, dirty: list[int], sizes: dict[int, int], per_file: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(home, rows, pieces, number of the first piece, number of the second) of each dirty home with rows, and how many files they make.

    A home's rows go to as few pieces as possible, of about equal sizes, the
    larger first.  A piece joins the file on its left if that is rewritten too
    and both fit.  Two pieces of one home never fit into one file, so only a
    home's first piece can join.
    """
    out, count, rewritten = [], 0, set(dirty)
    left: list[int] | None = None  # number and rows of the file on the left, if that is rewritten
    for home in range(files):
        if home not in rewritten:
            left = None
            continue
        n = sizes.get(home, 0)
        pieces = -(-n // per_file)
        if not pieces:
            continue
        first = n // pieces + (n % pieces > 0)
        if left is not None and left[1] + first <= per_file:
            at = left[0]
            left[1] += first
        else:
            at, count = count, count + 1
            left = [at, first]
        out.append((home, n, pieces, at, count))
        count += pieces - 1
        if pieces > 1:
            left = [count - 1, n // pieces]
    return out, count


def upsert(spark: SparkSession, folder: str, files: list[File], effective: DataFrame, key: str, per_file: int, staging: str, set_columns: tuple[str, ...] = SET) -> int:
    """Applies effective changes (key, home, change struct, deletes boolean) to the files of lay_out in folder; how many files there are then."""
    effective = written(effective, f"{staging}/effective")
    touched = {r[0] for r in effective.select("home").distinct().collect()}
    for i, (a, b) in reversed(list(enumerate(pairwise(files)))):  # a repeated key may stand in both
        if i + 1 in touched and a.last == b.first:
            touched.add(i)
    if not touched:
        return len(files)
    current = spark.read.parquet(*[files[i].path for i in sorted(touched)])
    columns, home = current.columns, fresh_name(current, "home")
    before = current.withColumn(home, F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.parquet$", 1).cast("int")).select(home, *_quoted(columns))
    deletes, sets = effective.filter("deletes"), effective.filter("NOT deletes")
    after = written(applied(before, deletes, sets, key, home, columns, set_columns), f"{staging}/after")
    dirty = differing(before, after, home)
    if not dirty:
        return len(files)
    place, order = fresh_name(after, "place"), [f"`{home}`", f"`{key}`", *[q for q in _quoted(columns) if q != f"`{key}`"]]
    ranked, sizes = placed(after.filter(F.col(home).isin(dirty)), home, order, place, f"{staging}/ranked-after")
    plan, count = new_files(len(files), dirty, sizes, per_file)
    if count:
        names = {c: fresh_name(ranked, c) for c in ("n", "pieces", "first", "second", "file")}
        small = spark.createDataFrame(plan, f"`{home}` int, `{names['n']}` long, `{names['pieces']}` long, `{names['first']}` long, `{names['second']}` long")
        n, pieces, at = F.col(names["n"]), F.col(names["pieces"]), F.col(place)
        size, more = F.floor(n / pieces), n % pieces
        piece = F.when(at < more * (size + 1), F.floor(at / (size + 1))).otherwise(more + F.floor((at - more * (size + 1)) / size))
        file = F.when(piece == 0, F.col(names["first"])).otherwise(F.col(names["second"]) + piece - 1)
        _write(ranked.join(F.broadcast(small), home).withColumn(names["file"], file), names["file"], count, order, _quoted(columns), folder, "next", f"{staging}/next")
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # noqa: N806
    fs = Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for i in dirty:
        fs.delete(Path(files[i].path), False)
    return len(files) - len(dirty) + count


# ── what the files hold ──────────────────────────────────────────────────────
def file_digests(spark: SparkSession, folder: str, key: str, sums: dict[str, Column]) -> DataFrame:
    """path, first_id, n_rows, ids_sha256 of each file of folder, and the sums of long columns; rows are read in their order in the file."""
    read = spark.read.parquet(folder)
    rows = read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("at"), F.col(key).cast("long").alias("id"), *[c.alias(name) for name, c in sums.items()])
    names, summed = ["path", "first_id", "n_rows", "ids_sha256", *sums], len(sums)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, first, n, digest, totals = None, None, 0, None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([digest.hexdigest()]), *[pa.array([t], pa.int64()) for t in totals]], names)

        for b in batches:
            if not b.num_rows:
                continue
            runs, begin = pa.compute.run_end_encode(b.column(0)), 0
            for end, now in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
                s = b.slice(begin, end - begin)
                if now != path:
                    if path is not None:
                        yield out()
                    path, first, n, digest, totals = now, s.column(1)[0].as_py(), 0, hashlib.sha256(), [0] * summed
                digest.update((b"," if n else b"") + ",".join(map(str, s.column(1).to_pylist())).encode())
                n += s.num_rows
                totals = [t + (pa.compute.sum(s.column(2 + k)).as_py() or 0) for k, t in enumerate(totals)]
                begin = end
        if path is not None:
            yield out()

    ordered = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path").sortWithinPartitions("path", "at").drop("at")
    return ordered.mapInArrow(tidy(work), "path string, first_id long, n_rows long, ids_sha256 string" + "".join(f", {name} long" for name in sums))


def op12_copy_on_write_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients, changes = table(spark, sf_dir, "clients"), table(spark, sf_dir, "client_changes")
    path = work_dir(spark, "upsert")
    nothing = spark.createDataFrame([], "first_id long, n_rows long, cents long, rows_crc long, ids_sha256 string, columns string, path string, rewritten boolean")
    folder, staging = f"{path}/data", f"{path}/staging"
    per_file = 1 + clients.count() // 1000
    files = lay_out(clients.filter("crc32(cast(client_id AS string)) % 7 > 3"), "client_id", per_file, folder, staging)
    if not files:
        return nothing
    firsts = [f.first for f in files]
    home = home_of(F.col("client_id"), firsts)
    last = winners(changes, "client_id", ["seq", "change_id"], ["op", *SET]).withColumn("home", home)
    last = last.withColumn("h", F.get(F.lit([zlib.crc32(str(f).encode()) % 16 for f in firsts]), F.col("home")))
    deletes = F.coalesce((F.col("change.op") == "D") | (F.crc32(F.col("change.change_id").cast("string")) % 8 < F.col("h")), F.lit(False))
    left = upsert(spark, folder, files, last.filter("h <= 7").select("client_id", "home", "change", deletes.alias("deletes")), "client_id", per_file, staging)
    if not left:
        return nothing
    text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in ("source", "segment", "city")])
    sums = {"cents": F.coalesce(F.floor(100 * F.col("balance") + 0.5), F.lit(0)).cast("long"), "rows_crc": F.crc32(text)}
    found = file_digests(spark, folder, "client_id", sums)
    columns = ",".join(spark.read.parquet(folder).columns)
    return found.select("first_id", "n_rows", "cents", "rows_crc", "ids_sha256", F.lit(columns).alias("columns"), "path", F.regexp_extract("path", r"/(\w+)-\d+\.parquet$", 1).eqNullSafe("next").alias("rewritten"))
