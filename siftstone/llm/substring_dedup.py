"""Substring dedup: seed on winnowed anchors, extend, keep maximal repeats.

A repeat is a run of `size` words or more that an earlier document (smaller
id) has too; its words are removed.

Seed: winnowing takes from each window of `size` words the k-gram with the
least hash, so equal windows have the same anchor at the same place.  Anchors
of at least two documents are the seeds; joining on them leaves out all text
that cannot be repeated.
Extend: a seed's *run* is its anchor extended both ways over all windows that
have chosen it.  Runs that an earlier document has whole are repeats.  Where
that fails (at the ends of a repeat) and the anchor occurs with other runs
too, the run's single windows are looked up.  Documents are never compared
pair by pair: runs and windows are looked up by a cryptographic digest of their
words (BLAKE2b, 128 bits), and each learns the smallest document that has it,
by an aggregate that combines before the shuffle.  Shorter hashes only select:
where they meet by chance, something is looked up in vain.  Work and shuffled
rows grow with the text, not with the square of a group of copies.
Maximal repeats: windows that an earlier document has are merged to the
longest spans; these are cut out.

Words are runs of bytes other than space and 0x09-0x0D.  Defined results: a
null text has no words; fewer than `size` words are never removed; repeated
rows (same id) don't remove each other and each give a row; a null id counts
as larger than any other, and rows without an id (or with one of 2**63 - 2**32
or more) don't remove each other; an empty table gives an empty one; a text may
be of any length that fits a task; equal anchor hashes in a window are a tie
that the last one wins; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.runtime import remove, table, tidy, work_dir, written
from siftstone.llm.textvec import Key, Words, gram_hashes, inside, mix, new_key, range_hashes, slices, winnow, words_of

SIZE, GRAM = 13, 5
_SECOND = np.uint64(0xD6E8FEB86659FD93)
_APART = np.uint64(0x9E3779B97F4A7C15)
#: Rows without an id stand here, each text for itself, so that they are no hot key.
NO_ID = (1 << 63) - (1 << 32)


def _windows(buf: np.ndarray, offsets: np.ndarray, size: int, gram: int, key: Key):
    """(words, window starts, document of each, anchor hash of each, position of the anchor)."""
    w = words_of(buf, offsets, key)
    starts = np.flatnonzero(inside(w.first, len(w.hashes), size))
    grams = gram_hashes(w.hashes, gram)
    at = winnow(grams, size - gram + 1)[starts]
    return w, starts, w.doc_of()[starts], grams[at], at


def _anchors(docs: DataFrame, size: int, gram: int, key: Key) -> DataFrame:
    """(anchor, id), once for each anchor of a document (or slice of its rows)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            for first, _, buf, offsets in slices(b.column(1)):
                _, _, doc, anchor, at = _windows(buf, offsets, size, gram, key)
                new = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.empty(0, bool)
                doc, anchor = doc[new], anchor[new]
                _, once = np.unique(mix(anchor + doc.astype(np.uint64) * _APART), return_index=True)
                once.sort()
                yield pa.RecordBatch.from_arrays([pa.array(anchor[once].view(np.int64)), pa.array(ids[first + doc[once]])], ["anchor", "id"])

    return docs.mapInArrow(tidy(work), "anchor long, id long")


def _members(column: pa.Array, n: int) -> np.ndarray:
    """Keys of (document, element) of a list column; nulls are empty."""
    owner = np.repeat(np.arange(n), column.value_lengths().fill_null(0).to_numpy())
    return mix(column.flatten().to_numpy().view(np.uint64) + owner.astype(np.uint64) * _APART)


def _runs(w, starts: np.ndarray, doc: np.ndarray, anchor: np.ndarray, at: np.ndarray, size: int):
    """(index of each run's first window, run number of each window, hash, first and end word of each run).

    A run is a stretch of windows with one anchor; its hash covers its words and the anchor's place.
    """
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    begins, ends = starts[first], starts[last] + size
    hashes = range_hashes(w.hashes, begins, ends) if len(first) else np.empty(0, np.uint64)
    return first, np.cumsum(new) - 1, mix(hashes + (at[first] - begins).astype(np.uint64) * _SECOND), begins, ends


def _digests(w: Words, begins: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """BLAKE2b of the words of each range, joined by one space, which no word has."""
    data, blake = w.buf.tobytes(), hashlib.blake2b
    plain = (w.starts[1:] == w.ends[:-1] + 1) & (w.buf[w.ends[:-1]] == 0x20)
    odd = np.concatenate([[0], np.cumsum(~plain)])  # gaps that are not one space, before each word
    joined = odd[ends - 1] == odd[begins]
    ranges = zip(w.starts[begins].tolist(), w.ends[ends - 1].tolist(), joined.tolist(), strict=True)
    return [blake(data[a:b] if whole else b" ".join(data[a:b].split()), digest_size=16).digest() for a, b, whole in ranges]


def _once(doc: np.ndarray, digests: list[bytes]) -> np.ndarray:
    """Places of the first of equal (document, digest) pairs."""
    d = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    order = np.lexsort((d[:, 1], d[:, 0], doc))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (d[order][1:] != d[order][:-1]).any(axis=1)
    return np.sort(order[new])


def _seed_runs(docs: DataFrame, size: int, gram: int, key: Key) -> DataFrame:
    """(anchor, run, digest, id) of the runs of docs (id, text, anchors) whose anchor is among the document's seeds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            for first, end, buf, offsets in slices(b.column(1)):
                w, starts, doc, anchor, at = _windows(buf, offsets, size, gram, key)
                heads, _, run, begins, ends = _runs(w, starts, doc, anchor, at, size)
                doc, anchor = doc[heads], anchor[heads]
                # A chance hit only adds a run that is looked up in vain.
                keep = np.isin(mix(anchor + doc.astype(np.uint64) * _APART), _members(b.column(2).slice(first, end - first), end - first))
                doc, anchor, run, digests = doc[keep], anchor[keep], run[keep], _digests(w, begins[keep], ends[keep])
                once = _once(doc, digests)
                columns = [anchor[once].view(np.int64), run[once].view(np.int64), [digests[k] for k in once], ids[first + doc[once]]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.int64()), strict=True)], ["anchor", "run", "digest", "id"])

    return docs.mapInArrow(tidy(work), "anchor long, run long, digest binary, id long")


def _open_windows(docs: DataFrame, size: int, gram: int, key: Key) -> DataFrame:
    """(h, digest, id) of the windows of docs (id, text, open) in its open runs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            for first, end, buf, offsets in slices(b.column(1)):
                w, starts, doc, anchor, at = _windows(buf, offsets, size, gram, key)
                heads, number, run, _, _ = _runs(w, starts, doc, anchor, at, size)
                keep = np.isin(mix(run + doc[heads].astype(np.uint64) * _APART), _members(b.column(2).slice(first, end - first), end - first))
                keep = keep[number] if len(number) else np.empty(0, bool)
                h = gram_hashes(w.hashes, size)[starts[keep]] if keep.any() else np.empty(0, np.uint64)
                doc, digests = doc[keep], _digests(w, starts[keep], starts[keep] + size)
                once = _once(doc, digests)
                columns = [h[once].view(np.int64), [digests[k] for k in once], ids[first + doc[once]]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int64()), strict=True)], ["h", "digest", "id"])

    return docs.mapInArrow(tidy(work), "h long, digest binary, id long")


def _spans(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _found(w: Words, hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray, known: pa.Scalar) -> np.ndarray:
    """Which ranges are among the known (h, digest): those that the hash selects are held against the digests."""
    hit = np.isin(hashes, known.values.field("h").to_numpy().view(np.uint64))
    digests = set(known.values.field("digest").to_pylist())
    hit[hit] = [d in digests for d in _digests(w, begins[hit], ends[hit])]
    return hit


def _cut(docs: DataFrame, size: int, gram: int, key: Key, keep_text: bool) -> DataFrame:
    """Result rows of docs (id, text, runs, windows: its runs and windows that an earlier document has, as (h, digest), or null)."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"] + ["text"] * keep_text
    kinds = [pa.int64(), pa.int64(), pa.string(), span] + [pa.string()] * keep_text

    def repeated(buf: np.ndarray, n: int, runs: pa.Scalar, windows: pa.Scalar) -> np.ndarray:
        """Which of the n words of one document are covered."""
        w, starts, doc, anchor, at = _windows(buf, np.array([0, len(buf)]), size, gram, key)
        hit = np.zeros(len(starts), dtype=bool)
        if runs.is_valid and len(starts):
            _, number, run, begins, ends = _runs(w, starts, doc, anchor, at, size)
            hit |= _found(w, run, begins, ends, runs)[number]
        if windows.is_valid and len(starts):
            hit |= _found(w, gram_hashes(w.hashes, size)[starts], starts, starts + size, windows)
        edge = np.zeros(n + 1, dtype=np.int64)
        np.add.at(edge, starts[hit], 1)
        np.add.at(edge, starts[hit] + size, -1)
        return np.cumsum(edge)[:n] > 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, runs, windows, rows = b.column(0), b.column(2), b.column(3), []
            for first, end, buf, offsets in slices(b.column(1)):
                data = buf.tobytes()
                for k in range(end - first):
                    words, spans = data[offsets[k] : offsets[k + 1]].split(), []
                    n = len(words)
                    if runs[first + k].is_valid or windows[first + k].is_valid:
                        gone = repeated(buf[offsets[k] : offsets[k + 1]], n, runs[first + k], windows[first + k])
                        spans = _spans(gone)
                        words = list(compress(words, ~gone))
                    kept = b" ".join(words)
                    rows.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), [{"start": x, "end": y} for x, y in spans], *([kept.decode()] * keep_text)))
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([ids, *cols], names)

    return docs.mapInArrow(tidy(work), "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:int,end:int>>" + ", text string" * keep_text)


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (maximal repeats, in words) and, with keep_text, text; a row for each row of df.

    Each step is written to the shared folder, so that its shuffle files can go before the next.
    """
    path, key = work_dir(df.sparkSession, "repeats"), new_key()
    text_, own = F.coalesce(F.col(text).cast("string"), F.lit("")), F.col(doc_id).cast("long")
    docs = df.select(F.coalesce(own, NO_ID + F.pmod(F.xxhash64(text_), F.lit(1 << 32))).alias("id"), text_.alias("text"), own.alias("own"))
    anchors = _anchors(docs.select("id", "text"), size, gram, key)
    shared = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    seeds = written(anchors.join(shared, "anchor").groupBy("id").agg(F.collect_set("anchor").alias("anchors")), f"{path}/seeds")

    runs = written(_seed_runs(docs.join(seeds, "id").select("id", "text", "anchors"), size, gram, key), f"{path}/runs")
    least = runs.groupBy("anchor", "run", "digest").agg(F.min("id").alias("least"))
    # An anchor that always comes with the same run has no windows that other runs share.
    several = least.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor", F.lit(True).alias("several"))
    late = F.col("least") < F.least("id", F.lit(NO_ID))
    known = runs.join(least.join(several, "anchor", "left"), ["anchor", "run", "digest"]).filter(late | F.coalesce("several", F.lit(False)))
    whole = F.when(late, F.struct(F.col("run").alias("h"), "digest"))
    found = known.groupBy("id").agg(F.collect_set(whole).alias("runs"), F.collect_set(F.when(~late, F.col("run"))).alias("open"))
    found = written(found, f"{path}/found")

    opened = docs.join(found.filter(F.size("open") > 0).select("id", "open"), "id").select("id", "text", "open")
    windows = written(_open_windows(opened, size, gram, key), f"{path}/windows")
    earliest = windows.groupBy("h", "digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").drop("most")
    single = windows.join(earliest, ["h", "digest"]).filter(late).groupBy("id").agg(F.collect_set(F.struct("h", "digest")).alias("windows"))
    repeats = written(found.select("id", F.when(F.size("runs") > 0, F.col("runs")).alias("runs")).join(single, "id", "full"), f"{path}/repeats")
    for name in ("seeds", "runs", "found", "windows"):
        remove(df.sparkSession, f"{path}/{name}")
    joined = docs.join(repeats.filter("runs IS NOT NULL OR windows IS NOT NULL"), "id", "left")
    return _cut(joined.select(F.col("own").alias("doc_id"), "text", "runs", "windows"), size, gram, key, keep_text)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS k FROM d, unnest(range(1, len(w) - 11)) AS t(i) WHERE len(w) >= 13),
least AS (SELECT k, min(doc_id) AS f FROM win GROUP BY k),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN least USING (k) WHERE f < doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN cov USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
