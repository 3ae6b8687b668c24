"""Benchmark decontamination: a broadcast hash set of test n-grams, DataFrame functions only.

Texts are normalised (A-Z lower-cased, words are runs of letters, digits and
characters beyond ASCII).  Windows of `size` item words are hashed to 64 bits
and broadcast when there are at most MAX_BROADCAST of them.  Document windows
are produced by explode() and looked up within one code-generated stage,
nothing is shuffled but the hits and one row per document; equal hashes are
verified on the words.  With more item windows only (id, place, hash) of the
document windows are shuffled to the item hashes, and the hits alone meet the
texts again to be verified.

Defined results: a null text has no words, so no hits; an item without words
has no windows; an item of fewer than `size` words is one window of its own
length; an item with a null id hits words but is not counted or listed;
repeated rows each get their result; a null id of a document is an id like
others; a text may be of any length that fits a task; an empty table gives an
empty one, without items nothing is hit; extra columns are not read, and kept
by remove_documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.runtime import ascii_lower, fresh_name, table

WINDOW = 10
#: Windows, about 150 bytes each, that are broadcast at most.
MAX_BROADCAST = 500_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, -1), "")


def _copy(text: Column) -> Column:
    """Tells rows of one id apart by their texts."""
    return F.sha2(text.cast("string").cast("binary"), 256)


def _key(w: Column, at: Column, size: int) -> Column:
    """64-bit hash of the words w[at:at+size]."""
    return F.xxhash64(*[F.get(w, at + k) for k in range(size)])


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """One row per distinct window: n (its words), key, window (array of words), items (ids as strings)."""
    w = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(size))
    rows = w.select("item", F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - n), lambda i: F.slice(F.col("w"), i + 1, n))).alias("window"))
    return rows.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items")).select(F.size("window").alias("n"), "window", "items")


def _places(d: DataFrame, lengths: list[int], first: int, *columns: str) -> DataFrame:
    """columns, n_words, pos (from first), len and hash of each document window; position -1 stands for the document itself."""
    at = d.select(*columns, F.size("w").alias("n_words"), "w", F.explode(F.sequence(F.lit(first), F.greatest(F.size("w") - lengths[0], F.lit(-1)))).alias("pos"))
    if len(lengths) == 1:
        return at.withColumn("len", F.lit(lengths[0])).withColumn("hash", _key(F.col("w"), F.col("pos"), lengths[0]))
    options = F.array(*[F.struct(F.lit(n).alias("len"), _key(F.col("w"), F.col("pos"), n).alias("hash")) for n in lengths])
    at = at.withColumn("o", F.explode(options)).filter((F.col("pos") < 0) & (F.col("o.len") == lengths[0]) | (F.col("pos") >= 0) & (F.col("pos") + F.col("o.len") <= F.col("n_words")))
    return at.select(*columns, "n_words", "w", "pos", F.col("o.len").alias("len"), F.col("o.hash").alias("hash"))


def _looked_up(d: DataFrame, keyed: DataFrame, lengths: list[int]) -> DataFrame:
    """doc_id, copy, n_words, pos, len, items of verified hits, and a row of position -1 for each document."""
    at = _places(d, lengths, -1, "doc_id", "copy")
    hits = at.join(keyed, (F.col("hash") == F.col("key")) & (F.col("len") == F.col("n")) & (F.col("pos") >= 0), "left")
    # Verified after the join: as a join key the slice would be built for every window, not for the hits alone.
    hits = hits.filter((F.col("pos") < 0) | (F.slice(F.col("w"), F.greatest(F.col("pos"), F.lit(0)) + 1, F.col("len")) == F.col("window")))
    return hits.select("doc_id", "copy", "n_words", "pos", "len", "items")


def _shuffled(d: DataFrame, keyed: DataFrame, lengths: list[int]) -> DataFrame:
    """_looked_up() for any number of windows: hashes are shuffled, and words of hits only."""
    d = d.withColumn("mark", F.xxhash64("copy"))
    at = _places(d.filter(F.size("w") >= lengths[0]), lengths, 0, "doc_id", "mark").select("doc_id", "mark", "pos", "len", "hash")
    spots = at.join(keyed.select(F.col("n").alias("len"), F.col("key").alias("hash")), ["len", "hash"], "left_semi")
    spots = spots.groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("m")).agg(F.collect_set(F.struct("pos", "len")).alias("spots"))
    texts = d.dropDuplicates(["doc_id", "copy"]).join(spots, d["doc_id"].eqNullSafe(F.col("id")) & (d["mark"] == F.col("m")))
    spot = texts.select("doc_id", "copy", "w", F.explode("spots").alias("s")).select("doc_id", "copy", F.size("w").alias("n_words"), "s.pos", "s.len", F.slice(F.col("w"), F.col("s.pos") + 1, F.col("s.len")).alias("window"))
    hits = spot.join(keyed.select("window", "items"), "window").select("doc_id", "copy", "n_words", "pos", "len", "items")
    own = d.select("doc_id", "copy", F.size("w").alias("n_words"), F.lit(-1).alias("pos"), F.lit(lengths[0]).alias("len"), F.lit(None).cast("array<string>").alias("items"))
    return own.union(hits)


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, hits (array of covered [start, end) word spans), items (sorted ids)."""
    windows = item_windows(items, item_id, item_text, size)
    count = {r["n"]: r["count"] for r in windows.groupBy("n").count().collect()}  # at most `size` rows
    lengths = sorted(count) or [size]
    keyed = windows.select("n", F.coalesce(*[F.when(F.col("n") == n, F.xxhash64(*[F.get("window", k) for k in range(n)])) for n in lengths]).alias("key"), "window", "items")
    d = docs.select(F.col(doc_id).alias("doc_id"), _copy(F.col(text)).alias("copy"), words(F.col(text)).alias("w"))
    few = sum(count.values()) <= MAX_BROADCAST
    hits = _looked_up(d, F.broadcast(keyed), lengths) if few else _shuffled(d, keyed, lengths)
    found = hits.groupBy("doc_id", "copy").agg(
        F.max("n_words").alias("n_words"),
        F.sum((F.col("pos") < 0).cast("int")).alias("rows"),
        F.sort_array(F.collect_set(F.when(F.col("pos") >= 0, F.struct(F.col("pos").alias("start"), (F.col("pos") + F.col("len")).alias("end"))))).alias("at"),
        F.collect_set(F.when(F.col("pos") >= 0, F.col("items"))).alias("item_sets"),
    )

    def merge(acc: Column, s: Column) -> Column:
        last = F.when(F.size(acc) > 0, F.element_at(acc, -1))
        longer = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when(last["end"] >= s["start"], longer).otherwise(F.concat(acc, F.array(s)))

    merged = F.aggregate("at", F.array().cast("array<struct<start:int,end:int>>"), merge)
    found = found.select("doc_id", "copy", "rows", "n_words", merged.alias("hits"), F.array_sort(F.array_distinct(F.flatten("item_sets"))).alias("items"))
    found = found.withColumn("n_hit", F.aggregate("hits", F.lit(0), lambda a, s: a + s["end"] - s["start"]))
    copies = F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))  # one row again for each equal row
    return found.select("doc_id", "copy", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"), "hits", "items", copies.alias("row")).drop("row")


def remove_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without those that hold a window of an item; all columns, whatever their names, and all other rows stay."""
    ident, copy = fresh_name(docs, "bad_id"), fresh_name(docs, "bad_copy")
    bad = contamination(docs, items, doc_id, text).filter("n_hit > 0").select(F.col("doc_id").alias(ident), F.col("copy").alias(copy)).distinct()
    return docs.join(bad, docs[doc_id].eqNullSafe(F.col(ident)) & (_copy(docs[text]) == F.col(copy)), "left_anti")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0
), ln AS (SELECT DISTINCT n FROM bw), dw AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM d, ln, unnest(range(1, len(w) - n + 2)) AS t(i)
), h AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (n, win)),
p AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS q FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)
"""
