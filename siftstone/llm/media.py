"""Media columns: MPEG transport streams.

`write_stream` stores a payload as access units in PES packets, cut into
188-byte transport packets after a PAT and a PMT.  `read_stream` parses the
program tables, checks continuity counters, reassembles the PES packets and
gives back the payload with the time stamp of each access unit and which of
them are random-access points.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.runtime import table, tidy

PACKET, SYNC, STUFFING = 188, 0x47, 0xFF
PAT_PID, PMT_PID, STREAM_PID, PROGRAM = 0x0000, 0x1000, 0x0100, 1
PRIVATE_STREAM, PRIVATE_TYPE = 0xBD, 0x06
#: Payloads are padded to a multiple of UNIT; an access unit is UNIT * PER_ACCESS bytes, GROUP of them per random-access point.
UNIT, PER_ACCESS, GROUP = 576, 16, 4
FIRST_PTS, PTS_STEP = 90_000, 3_600


@cache
def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


def crc32_mpeg(data: bytes) -> int:
    t, c = _crc_table(), 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ t[c >> 24 ^ b]
    return c


def _section(table_id: int, ident: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + ident.to_bytes(2, "big") + b"\xc1\x00\x00" + body
    return head + crc32_mpeg(head).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    return (b"\x47" + (0x4000 | pid).to_bytes(2, "big") + b"\x10\x00" + section).ljust(PACKET, b"\xff")


@cache
def _tables() -> bytes:
    pat = _section(0x00, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
    pmt = _section(0x02, PROGRAM, (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_TYPE]) + (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\x00")
    return _table_packet(PAT_PID, pat) + _table_packet(PMT_PID, pmt)


def _stamp(pts: int) -> bytes:
    return bytes([0x21 | pts >> 29 & 0x0E, pts >> 22 & 0xFF, 0x01 | pts >> 14 & 0xFE, pts >> 7 & 0xFF, 0x01 | pts << 1 & 0xFE])


def _clock(pts: int) -> bytes:
    return (pts << 15 | 0x7E00).to_bytes(6, "big")  # base, reserved bits, extension 0


def write_stream(payload: bytes, access_bytes: int = UNIT * PER_ACCESS, group: int = GROUP) -> bytes:
    out, counter = [_tables()], 0
    for k, at in enumerate(range(0, len(payload), access_bytes)):
        unit, pts = payload[at : at + access_bytes], (FIRST_PTS + k * PTS_STEP) & (1 << 33) - 1
        pes = b"\x00\x00\x01" + bytes([PRIVATE_STREAM]) + (len(unit) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(pts) + unit
        adapt = bytes([0x50 if k % group == 0 else 0x10]) + _clock(pts)  # random access indicator, clock
        first, pos = True, 0
        while pos < len(pes):
            room = PACKET - 4 - (len(adapt) + 1 if first else 0)
            part = pes[pos : pos + room]
            field_ = adapt if first else b""
            if (lack := room - len(part)) > 0:  # stuffing goes to the adaptation field
                field_ = field_ + b"\xff" * lack if first else (b"" if lack == 1 else b"\x00" + b"\xff" * (lack - 2))
            has = first or lack > 0
            out.append(b"\x47" + ((0x4000 if first else 0) | STREAM_PID).to_bytes(2, "big") + bytes([(0x30 if has else 0x10) | counter]) + (bytes([len(field_)]) + field_ if has else b"") + part)
            counter, pos, first = counter + 1 & 15, pos + len(part), False
    return b"".join(out)


@dataclass
class Stream:
    payload: bytes = b""
    programs: dict[int, int] = field(default_factory=dict)  # program -> PID of its map
    streams: dict[int, int] = field(default_factory=dict)  # PID -> stream type
    timestamps: list[int] = field(default_factory=list)
    access_points: list[int] = field(default_factory=list)  # indexes into timestamps
    packets: int = 0
    gaps: int = 0  # breaks of a continuity counter


@cache
def _read_section(data: bytes) -> tuple[int, bytes]:
    """(table id, body) of a section whose checksum holds."""
    size = int.from_bytes(data[1:3], "big") & 0x0FFF
    if size + 3 > len(data) or crc32_mpeg(data[: size + 3]):
        raise ValueError("a program table is damaged")
    return data[0], data[8 : size - 1]


def read_stream(media: bytes) -> Stream:
    """Raises ValueError where sync, a table, a PES header or a PES length is damaged; counts continuity breaks."""
    if len(media) % PACKET:
        raise ValueError("not whole packets")
    s, counters, parts, units = Stream(), {}, [], []

    def close() -> None:
        if not parts:
            return
        pes = b"".join(parts)
        if pes[:3] != b"\x00\x00\x01":
            raise ValueError("no PES start code")
        size, flags, extra = int.from_bytes(pes[4:6], "big"), pes[7], pes[8]
        if size and size + 6 != len(pes):
            raise ValueError("a PES packet is cut")
        if flags & 0x80:
            p = pes[9:14]
            s.timestamps.append((p[0] >> 1 & 7) << 30 | p[1] << 22 | p[2] >> 1 << 15 | p[3] << 7 | p[4] >> 1)
        units.append(pes[9 + extra :])
        parts.clear()

    for at in range(0, len(media), PACKET):
        if media[at] != SYNC:
            raise ValueError("sync is lost")
        head, control = media[at + 1] << 8 | media[at + 2], media[at + 3]
        pid, begins = head & 0x1FFF, head & 0x4000
        body, access = at + 4, False
        if control & 0x20:
            size = media[body]
            access = size > 0 and bool(media[body + 1] & 0x40)
            body += 1 + size
        if control & 0x10:
            if counters.get(pid, control & 15) != control & 15:
                s.gaps += 1
            counters[pid] = (control & 15) + 1 & 15
        data = media[body : at + PACKET]
        if pid == PAT_PID or pid in s.programs.values():
            start = 1 + data[0]
            kind, inner = _read_section(bytes(data[start : start + 3 + (int.from_bytes(data[start + 1 : start + 3], "big") & 0x0FFF)]))
            if kind == 0x00:
                s.programs |= {int.from_bytes(inner[i : i + 2], "big"): int.from_bytes(inner[i + 2 : i + 4], "big") & 0x1FFF for i in range(0, len(inner), 4)}
            elif kind == 0x02:
                i = 4 + (int.from_bytes(inner[2:4], "big") & 0x0FFF)
                while i < len(inner):
                    s.streams[int.from_bytes(inner[i + 1 : i + 3], "big") & 0x1FFF] = inner[i]
                    i += 5 + (int.from_bytes(inner[i + 3 : i + 5], "big") & 0x0FFF)
        elif pid in s.streams:
            if begins:
                close()
                if access:
                    s.access_points.append(len(units))
            parts.append(data)
        s.packets += 1
    close()
    s.payload = b"".join(units)
    return s


def padded(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw.ljust(max(1, -(-len(raw) // UNIT)) * UNIT, b"\xff")


FIELDS = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, timestamps array<long>, access_points array<int>"


def stream_columns(df: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_media: bool = False) -> DataFrame:
    """doc_id, the columns of FIELDS and, with keep_media, media (binary), a row for each row of df.

    A null text is an empty one.  Rows are independent, equal texts give equal
    values; extra columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            values, begin = batch.column(1), 0
            while begin < len(values):
                rows, size, first = [], 0, begin
                while begin < len(values) and size < 8_000_000:
                    n, payload = padded(values[begin].as_py())
                    media = write_stream(payload)
                    got = read_stream(media)
                    t = got.timestamps
                    feature = f"programs={len(got.programs)};streams={len(got.streams)};packets={got.packets};units={len(t)};access={len(got.access_points)};gaps={got.gaps};pts={t[0]}-{t[-1]}"
                    rows.append((n, len(got.payload), sha(got.payload), zlib.crc32(got.payload[-32:]), len(media), sha(media), feature, t, got.access_points, media if keep_media else None))
                    size, begin = size + len(media), begin + 1
                cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, begin - first), *cols], names)

    slim = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    fields = FIELDS + (", media binary" if keep_media else "")
    names = ["doc_id", *(f.split()[0] for f in fields.split(", "))]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), *([pa.binary()] if keep_media else [])]
    return slim.mapInArrow(tidy(work), f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, {fields}")


def op8_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_columns(table(spark, sf_dir, "documents"))
