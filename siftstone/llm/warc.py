"""Content-addressed web archives.

`write_archives` turns pages into WARC files in a folder: of pages with the
same payload (SHA-256, verified when read) of REVISIT_FROM bytes or more, that
with the smallest id is stored as a response, the others are revisit records
without payload.  `read_archives` parses the files; `store` keeps each payload
once under its verified digest and the exact record headers apart from them;
`reconstruct` joins both to the original records.

Defined results: a null payload is an empty one; a null url gives no target
header, line breaks in it are percent-encoded; pages with the same id and
payload are all written as the first is (response), a null id sorts after all
others; other columns are not stored; an empty table gives empty archives; a
payload may be of any length that a row of Spark can have (2 GB with its header).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.runtime import LAST_ID, remove, table, tidy, work_dir, written

REVISIT_FROM = 100
#: (bytes, records): a file of payloads of at most so many bytes has at most so many records, 64 MB of payload; a larger
#: payload has a file of its own.  A task holds a file as it is stored, and its records one after the other.
FILES = ((64 << 10, 1_000), (4 << 20, 16))
#: Bytes that are unpacked, and payload bytes that are given on, at a time.
PIECE, BATCH = 1 << 20, 8_000_000
END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """page_id, url, payload, n, digest and refers_to (null: a response) of each page."""
    p = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    p = p.withColumns({"n": F.octet_length("payload"), "digest": F.sha2(F.col("payload").cast("binary"), 256)})
    # Of the groups only those with two members or more need the join, so unique digests don't meet a hot one.
    first = p.filter(F.col("n") >= REVISIT_FROM).groupBy("digest").agg(F.min(F.coalesce("page_id", F.lit(LAST_ID))).alias("least"), F.count("*").alias("size")).filter("size > 1").drop("size")
    p = p.join(first, "digest", "left")
    return p.select("page_id", "url", "payload", "n", "digest", F.when(F.coalesce("page_id", F.lit(LAST_ID)) > F.col("least"), F.col("least")).alias("refers_to"))


def _records(planned: DataFrame) -> DataFrame:
    """The text of each record up to END; the files have END after each."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"\r\n{name}: "), value)).otherwise(F.lit(""))
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    body = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"),
        F.lit("\r\nWARC-Record-ID: "), ident(F.col("page_id")), F.lit(f"\r\nWARC-Date: {DATE}"),
        line("WARC-Target-URI", target), line("WARC-Refers-To", F.when(F.col("refers_to").isNotNull(), ident(F.col("refers_to")))),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit(END),
    )
    return planned.select(F.concat(head, body).alias("value"))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Gzip files of WARC records below folder path, which is emptied before: a folder for each size of payloads."""
    remove(pages.sparkSession, path)
    size = F.octet_length(F.coalesce(F.col(payload), F.lit("")))
    longest, above = pages.agg(F.max(size)).first()[0] or 0, -1
    for k, (most, records) in enumerate((*FILES, (None, 1))):
        # A file is needed even of an empty table; sizes that no payload has need no job.
        if k and longest <= above:
            break
        # Equal payloads are of one size, so each size is planned by itself.
        sized = pages.filter((size > above) & (size <= (longest if most is None else most)))
        _records(plan_records(sized, page_id, url, payload)).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records).text(f"{path}/{k}")
        above = most


def _unpacked(data: bytes) -> Iterator[bytes]:
    """The content of a gzip file of one member or more, piece by piece."""
    while data:
        member = zlib.decompressobj(wbits=31)
        while not member.eof:
            piece = member.decompress(data, PIECE)
            if not piece and not member.unconsumed_tail and not member.eof:
                raise ValueError("the file ends within a gzip member")
            data = member.unconsumed_tail
            yield piece
        data = member.unused_data


def parse_archive(data: bytes | Iterable[bytes]) -> Iterator[tuple[bytes, dict[str, str], bytes]]:
    """(header with its blank line, fields, payload) of each record of the bytes or pieces; ValueError on a damaged file."""
    pieces, held, at, gone = iter([data] if isinstance(data, bytes) else data), bytearray(), 0, 0

    def more() -> bool:
        """Another piece is held; what is done with goes."""
        nonlocal at, gone
        piece = next(pieces, None)
        if piece is None:
            return False
        if at:
            gone += at
            del held[:at]
            at = 0
        held.extend(piece)
        return True

    def until(size: int) -> None:
        while len(held) - at < size:
            if not more():
                raise ValueError(f"the file ends within the record at byte {gone + at}")

    while at < len(held) or more():
        if at == len(held):
            continue
        until(7)
        if held[at : at + 7] != b"WARC/1.":
            raise ValueError(f"no WARC record at byte {gone + at}")
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            until(len(held) - at + 1)
        head = bytes(held[at : end + 4])
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:-2])
        size = int(fields["Content-Length"])
        until(len(head) + size + 4)
        start = at + len(head)
        payload = bytes(held[start : start + size])
        if held[start + size : start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"a record ends wrongly at byte {gone + start + size}")
        at = start + size + 4
        yield head, fields, payload


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_type, refers_to, digest (as the header says), header, payload (null in revisits)."""

    def page(value: str | None) -> int | None:
        number = value[len("<urn:page:") : -1] if value else "null"
        return None if number == "null" else int(number)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                rows, size = [], 0
                for head, f, payload in parse_archive(_unpacked(value.as_py())):
                    kind = f["WARC-Type"]
                    rows.append((page(f["WARC-Record-ID"]), kind, page(f.get("WARC-Refers-To")), f["WARC-Payload-Digest"].removeprefix("sha256:"), head, payload if kind == "response" else None))
                    size += len(payload)
                    if size > BATCH:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["page_id", "record_type", "refers_to", "digest", "header", "payload"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(tidy(work), "page_id long, record_type string, refers_to long, digest string, header binary, payload binary")


def store(records: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(headers, payloads) written below path; a payload whose SHA-256 is not its header's digest stops the job."""
    verified = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload differs from digest "), F.col("digest"))).cast("binary"))
    headers = written(records.drop("payload"), f"{path}/headers")
    payloads = written(records.filter("payload IS NOT NULL").select("digest", verified.alias("payload")).dropDuplicates(["digest"]), f"{path}/payloads")
    return headers, payloads


def reconstruct(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """page_id, record_type, refers_to, digest, header, payload: revisits too get the payload they stand for."""
    return headers.join(payloads, "digest", "left").select(*headers.columns, "payload")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), f"{path}/archives")
    headers, payloads = store(read_archives(spark, f"{path}/archives"), path)
    remove(spark, f"{path}/archives")
    # The digest and size of what is stored, from its bytes; only these meet the headers.
    sizes = payloads.select("digest", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    return headers.join(sizes, "digest", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS n, sha256(h) AS d FROM p),
r AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) ELSE page_id END AS f FROM q)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = f THEN NULL ELSE f END AS refers_to FROM r
"""
