"""A sink whose tasks write parts and whose driver commits: all of an output takes its name, or nothing does.

Tasks write below a staging folder beside the output, through pyarrow's file
systems, so a path may be local or in a shared store.  A failed or repeated
attempt leaves a part that nobody names.  commit() puts the parts of the
attempts that count together, in the order of the partitions, byte by byte, and
gives the result its name by a rename; header and byte order mark come once.
For a package of many files it moves each to its place.  abort() removes the
staging folder; what stood there before stays.
"""

from __future__ import annotations

import csv
import io
import os.path
import posixpath
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from siftstone.shipping import ship

NAME = "siftstone_commit"
_COPY = 1 << 22  # bytes that the driver holds while parts are put together


@dataclass
class Written(WriterCommitMessage):
    part: int
    names: list[str] = field(default_factory=list)


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), os.path.abspath(path))


def inside(root: str, name: str) -> str:
    """The path of name below root; one that leads out of it is an error."""
    target = posixpath.normpath(posixpath.join(root, name))
    if not target.startswith(posixpath.normpath(root) + "/"):
        raise ValueError(f"{name} leads out of {root}")
    return target


class _Lines:
    """Rows as lines of one file."""

    def __init__(self, kind: str, columns: list[str], title: str):
        self.kind, self.columns, self.title = kind, columns, title

    def head(self) -> bytes:
        if self.kind == "csv":  # with a byte order mark, as spreadsheet programs want it
            return b"\xef\xbb\xbf" + self._csv([self.columns])
        if self.kind == "markdown":
            return f"# {self.title}\n\n| {' | '.join(self.columns)} |\n|{'---|' * len(self.columns)}\n".encode()
        return b""

    @staticmethod
    def _csv(rows) -> bytes:
        out = io.StringIO(newline="")
        csv.writer(out).writerows(rows)
        return out.getvalue().encode()

    def line(self, row: Row) -> bytes:
        if self.kind == "csv":
            return self._csv([["" if v is None else v for v in row]])
        if self.kind == "markdown":
            cell = lambda v: "" if v is None else str(v).replace("|", "｜").replace("\n", " ")
            return f"| {' | '.join(map(cell, row))} |\n".encode()
        return f"{row[0]}\n".encode()


class CommitWriter(DataSourceWriter):
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.kind = options["path"], options.get("kind", "csv")
        self.lines, self.staging = _Lines(self.kind, columns, options.get("title", "")), f"{self.path.rstrip('/')}.staging-{uuid.uuid4().hex}"
        self.at = [columns.index(c) for c in ("path", "text")] if self.kind == "package" else []

    def write(self, rows: Iterator[Row]) -> Written:
        task = TaskContext.get()
        store, root = _store(self.staging)
        own = f"{root}/{task.partitionId():06d}-{task.taskAttemptId()}"
        if self.kind == "package":
            names = []
            for row in rows:
                name, text = (row[k] for k in self.at)
                inside(_store(self.path)[1], name)
                target = inside(own, name)
                store.create_dir(posixpath.dirname(target), recursive=True)
                with store.open_output_stream(target) as f:
                    f.write(text.encode())
                names.append(name)
            return Written(task.partitionId(), [posixpath.basename(own), *names])
        store.create_dir(root, recursive=True)
        with store.open_output_stream(own, buffer_size=1 << 20) as f:
            for row in rows:
                f.write(self.lines.line(row))
        return Written(task.partitionId(), [posixpath.basename(own)])

    def commit(self, messages: list[Written | None]) -> None:
        (store, root), (_, target) = _store(self.staging), _store(self.path)
        done = sorted((m for m in messages if m), key=lambda m: m.part)
        store.create_dir(root, recursive=True)
        if self.kind == "package":
            for own, *names in (m.names for m in done):
                for name in names:
                    final = inside(target, name)
                    store.create_dir(posixpath.dirname(final), recursive=True)
                    store.move(f"{root}/{own}/{name}", final)
        else:
            with store.open_output_stream(f"{root}/whole") as out:
                out.write(self.lines.head())
                for m in done:
                    with store.open_input_stream(f"{root}/{m.names[0]}") as part:
                        while data := part.read(_COPY):
                            out.write(data)
            store.create_dir(posixpath.dirname(target), recursive=True)
            store.move(f"{root}/whole", target)
        store.delete_dir(root)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _store(self.staging)
        for _ in range(4):  # tasks that are being stopped may still write
            if store.get_file_info(root).type != pafs.FileType.NotFound:
                store.delete_dir(root)
            time.sleep(0.5)


class CommitSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> CommitWriter:
        return CommitWriter(dict(self.options), schema.names)


def save(df: DataFrame, path: str, kind: str, **options: str) -> None:
    """kind: csv, markdown (with a title), lines (the first column) or package (columns path and text, files below path)."""
    spark = ship(df.sparkSession)
    spark.dataSource.register(CommitSource)
    df.write.format(NAME).options(kind=kind, **options).mode("append").save(path)
