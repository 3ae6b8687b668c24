"""N-gram Jaccard join: an exact metric-space join and its components.

Jaccard distance is a metric.  Documents are first dealt to *blocks*: a block
is the set of documents with a certain shingle among their least
`n - ceil(0.75 n) + l(n)` shingles, by one order for all (frequent shingles
last).  Any two within the distance t share l blocks or more, l being that of
the smaller one; so a document with fewer blocks in common with any others than
the smallest partner would ask for is linked with nothing, and of the others
each may leave some blocks, as long as these are fewer than half as many.  Then:

* Pivots and regions.  Each block's pivot is its document with the least id;
  all blocks of one pivot are one region.  So a document is in its nearest
  pivot's Voronoi region and, as a boundary document, in those of the other
  pivots of its blocks.  Its exact distance to each of these is computed.
* Windows.  Members within t of a pivot, and whatever else links have joined,
  are one component, and pairs of one component need no look.  By the triangle
  inequality x and y of a region can only link if |d(x, p) - d(y, p)| <= t: of
  a region's largest component only members in the window of the others stay.
* Recursion.  A region with much left to compare draws new pivots among the
  members outside of its largest component.  These are parted by their nearest
  new pivot q; with r the largest distance of such a home member to q, every
  other member with d(x, q) <= t + r is replicated to q's region, and none else
  can link to one at home there.  The new regions are joined in the same way.
  Where that does not halve the work (members that are all about equally far
  from each other cannot be parted), the region is compared as it is.
* Comparison.  What is left of a region is compared exactly, members outside of
  the largest component with all, in cells of at most about CELL by CELL
  members, so that no task gets a whole region.  A cell gives the links that
  join its components, not all of its pairs.

`jaccard_components` and `keep_first` stop there.  `jaccard_join` gives every
link between different sets: the same blocks, pivots, windows and recursion, but
no pair is passed over because its members are in one component already, so a
group of m different near copies takes m * m comparisons, in cells too.

Members are classes of equal sets, named by a digest of the set and not by an
id: rows that share an id, or have none, are different documents if their
texts differ.  Shingles are compared by 64 bits of hash, sets by sums of two
such: under the run's own secret key (see textvec) two given shingles meet with
a probability of about 2**-58, whatever their words are.

Defined results: a null or empty text has an empty set and is linked with
nothing; repeated rows each give a row; a null id counts as larger than any
other, and a component with null ids only has a null component_id (the id
2**63 - 1 counts as null); an empty table gives an empty one; a text may be of
any length that fits a task; ties of distance go to the pivot with the least
name; extra columns are not read by the join and kept by keep_first.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftstone.llm.components import components
from siftstone.llm.runtime import LAST_ID, fresh_name, remove, table, tidy, work_dir, written
from siftstone.llm.textvec import Key, gram_hashes, inside, mix, new_key, slices, words_of

GRAM, PERCENT = 5, 75
#: Frequent shingles that are ordered last; more would only be ordered less well.
MAX_FREQUENT = 400_000
#: A shingle is frequent if at least so many documents of some run of documents have it.
LEAST_FREQUENT = 3
#: Rows of shingles that at least so many documents have are spread over all tasks.
HOT = 200
#: Members of a side of a cell, on average.
CELL = 160
#: Pairs of a region beyond which it is parted by PIVOTS new pivots.
BIG, PIVOTS = 200_000, 16
#: A document's blocks beyond the fewest are one for so many of its shingles.
MORE_BLOCKS = 10
_RUN = 4_000_000  # shingles of a run
_OTHER = np.uint64(0xD6E8FEB86659FD93)
_TILE = 4096


def _by_document(doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Order by document (a few thousand at most), then the first key, then the next; a radix sort for small integers."""
    order = np.argsort(keys[-1], kind="stable")
    for key in (*keys[-2::-1], doc.astype(np.uint16) if doc.max(initial=0) < 1 << 16 else doc):
        order = order[np.argsort(key[order], kind="stable")]
    return order


def _sets(buf: np.ndarray, offsets: np.ndarray, gram: int, key: Key) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle hash), sorted and distinct."""
    w = words_of(buf, offsets, key, lower=True)
    starts = np.flatnonzero(inside(w.first, len(w.hashes), gram))
    doc, hashes = w.doc_of()[starts], gram_hashes(w.hashes, gram)
    hashes = hashes[starts] if len(starts) else np.empty(0, np.uint64)
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < gram))
    if len(short):  # the whole sequence is the one shingle
        more = np.array([gram_hashes(w.hashes[w.first[d] : w.first[d + 1]], int(count[d]))[0] for d in short], dtype=np.uint64)
        doc, hashes = np.concatenate([doc, short]), np.concatenate([hashes, more])
    order = _by_document(doc, hashes)
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


def _keys(doc: np.ndarray, hashes: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and 128-bit digest of each document's set."""
    size = np.bincount(doc, minlength=n_docs)
    sums = []
    for h in (mix(hashes), mix(hashes ^ _OTHER)):
        total = np.concatenate([[np.uint64(0)], np.cumsum(h)])
        end = np.cumsum(size)
        sums.append((total[end] - total[end - size]).view(np.int64))
    return size, sums[0], sums[1]


def _survey(docs: DataFrame, gram: int, key: Key) -> DataFrame:
    """docs: (id, text, digest).  A row for each with the size and keys of its set, and (shingle, count) rows of runs of documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, size = ["id", "digest", "n", "k1", "k2", "shingle", "count"], [], 0

        def flush() -> pa.RecordBatch:
            h = np.concatenate(held)
            held.clear()
            h.sort()
            head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
            c = np.diff(np.append(head, len(h)))
            head, c = head[c >= LEAST_FREQUENT], c[c >= LEAST_FREQUENT]
            none = pa.nulls(len(c), pa.int64())
            return pa.RecordBatch.from_arrays([none, pa.nulls(len(c), pa.binary()), none, none, none, pa.array(h[head].view(np.int64)), pa.array(c)], names)

        for b in batches:
            for first, end, buf, offsets in slices(b.column(1)):
                doc, h = _sets(buf, offsets, gram, key)
                none = pa.nulls(end - first, pa.int64())
                own = [b.column(k).slice(first, end - first) for k in (0, 2)]
                yield pa.RecordBatch.from_arrays([*own, *map(pa.array, _keys(doc, h, end - first)), none, none], names)
                held.append(h)
                size += len(h)
                if size >= _RUN:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return docs.mapInArrow(tidy(work), "id long, digest binary, n long, k1 long, k2 long, shingle long, count long")


def _frequent(survey: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of at most MAX_FREQUENT shingles, the logarithms of their counts, and which are hot.

    They only set an order (the rarer the earlier) and how rows are dealt; any list gives the same result.
    """
    rows = survey.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "shingle").limit(MAX_FREQUENT).toArrow()
    shingles, counts = rows["shingle"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(shingles)
    return shingles[order], (np.log2(np.maximum(counts, 1)) + 1).astype(np.int8)[order], (counts >= HOT)[order]


def _node(shift: int) -> Column:
    """The name of a class of equal sets, as _blocks makes it; shift is such that no two classes share one."""
    return F.col("k1").bitwiseXOR(F.shiftrightunsigned("k2", shift))


def _blocks(docs: DataFrame, gram: int, key: Key, percent: int, frequent: tuple[np.ndarray, np.ndarray, np.ndarray], shift: int) -> DataFrame:
    """docs: (at, text).  (token, hot, spread, at, x): the shingles by which classes are dealt to blocks; spread is the token, or for hot ones a part of it."""
    known, level, hot = frequent

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            for first, end, buf, offsets in slices(b.column(1)):
                doc, h = _sets(buf, offsets, gram, key)
                size, k1, k2 = _keys(doc, h, end - first)
                node = k1.view(np.uint64) ^ (k2.view(np.uint64) >> np.uint64(shift))
                once = np.zeros(end - first, dtype=bool)
                # Of equal sets in a slice one is enough.
                order = np.lexsort((ids[first:end], k2, k1))
                new = np.ones(len(order), dtype=bool)
                new[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
                once[order[new]] = True
                late, is_hot = np.zeros(len(h), dtype=np.int8), np.zeros(len(h), dtype=bool)
                if len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    same = known[at] == h
                    late, is_hot = np.where(same, level[at], late), same & hot[at]
                # h is in order already, so late and doc are stable sorts of small integers.
                order = _by_document(doc, late)
                place = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
                most = -(-percent * size // 100)
                least = size - most + np.minimum(1 + size // MORE_BLOCKS, most)
                order = order[(place < np.repeat(least, size)) & np.repeat(once, size)]
                token, x, is_hot = h[order], node[doc[order]], is_hot[order]
                spread = np.where(is_hot, mix(token ^ mix(x)), token)
                cols = [token.view(np.int64), is_hot, spread.view(np.int64), ids[first + doc[order]], x.view(np.int64)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, cols)), ["token", "hot", "spread", "at", "x"])

    return docs.mapInArrow(tidy(work), "token long, hot boolean, spread long, at long, x long")


def _first_of_blocks(dealt: DataFrame) -> DataFrame:
    """dealt: rows of _blocks in the order of (token, at, x), whole blocks in a partition but for hot ones.

    (x, p, c, token, at): x with the pivot p of c of its blocks (or more: repeated rows count), x = p too, token null; or a row of a hot block, p null.
    Blocks of one class are left out.  Streams: a block may be of any size.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, last, pivot = ["x", "p", "c", "token", "at"], None, None
        for b in batches:
            token, hot, at, x = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            if hot.any():
                n = int(hot.sum())
                yield pa.RecordBatch.from_arrays([pa.array(x[hot]), pa.nulls(n, pa.int64()), pa.array(np.ones(n, dtype=np.int64)), pa.array(token[hot]), pa.array(at[hot])], names)
                token, x = token[~hot], x[~hot]
            if not len(token):
                continue
            head = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            p = x[head]
            if token[0] == last:
                p[0] = pivot
            last, pivot = token[-1], p[-1]
            own, length = p, np.diff(np.append(head, len(token)))
            p = np.repeat(p, length)
            met = x != p
            own = own[np.add.reduceat(met, head) > 0]
            x, p = np.concatenate([x[met], own]), np.concatenate([p[met], own])
            order = np.lexsort((x, p))
            x, p = x[order], p[order]
            new = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (p[1:] != p[:-1])])) if len(x) else np.empty(0, np.int64)
            none = pa.nulls(len(new), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x[new]), pa.array(p[new]), pa.array(np.diff(np.append(new, len(x)))), none, none], names)

    return dealt.select("token", "hot", "at", "x").mapInArrow(tidy(work), "x long, p long, c long, token long, at long")


def _set_rows(texts: DataFrame, gram: int, key: Key) -> DataFrame:
    """texts: (x, text).  (x, s): the sorted shingle hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, end, buf, offsets in slices(b.column(1)):
                doc, h = _sets(buf, offsets, gram, key)
                bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=end - first))]).astype(np.int32) * np.int32(8)
                rows = pa.Array.from_buffers(pa.binary(), end - first, [None, pa.py_buffer(bounds), pa.py_buffer(h)])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, end - first), rows], ["x", "s"])

    return texts.mapInArrow(tidy(work), "x long, s binary")


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each of a with each of b, all sorted and distinct."""
    sizes = np.array(list(map(len, b)))
    if len(a) <= 8:
        values, owner, out = np.concatenate(b), np.repeat(np.arange(len(b)), sizes), []
        for x in a:
            at = np.minimum(np.searchsorted(x, values), len(x) - 1)
            out.append(np.bincount(owner[x[at] == values], minlength=len(b)))
        return np.array(out)
    # Members by shingles, a tile of shingles at a time; single shingles are left out.
    both = a + b
    values, owner = np.concatenate(both), np.repeat(np.arange(len(both)), list(map(len, both)))
    order = np.argsort(values)
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    lone = new & np.append(new[1:], True)
    owner, column = owner[~lone], np.cumsum(new[~lone]) - 1
    out = np.zeros((len(a), len(b)))
    for tile in range(0, int(column[-1]) + 1 if len(column) else 0, _TILE):
        lo, hi = np.searchsorted(column, [tile, tile + _TILE])
        has = np.zeros((len(both), _TILE), dtype=np.float32)
        has[owner[lo:hi], column[lo:hi] - tile] = 1
        out += has[: len(a)] @ has[len(a) :].T
    return out.astype(np.int64)


def _joins(u: np.ndarray, v: np.ndarray) -> list[int]:
    """Indices of pairs (u, v) that join all that the pairs join."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    out = []
    for k, (x, y) in enumerate(zip(u.tolist(), v.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            out.append(k)
    return out


def _compared(rows: DataFrame, sets: DataFrame, percent: int, distances: bool, every: bool = False) -> DataFrame:
    """Members of regions compared in cells.

    rows: (region, x, comp, d, asks, meets, ni, nj); those that ask are compared
    with those that are met, in ni by nj cells of the region.  Gives (region, x,
    q, d, linked) of each asking q and met x, or else (region, x, q) of links
    between different comps: every one, or enough to join what they join.
    """
    t = 1 - percent / 100 + 1e-9
    i, j = (F.pmod(F.xxhash64("x", F.lit(k)), F.col(c)).cast("int") for k, c in enumerate(("ni", "nj")))
    cell = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))
    none = F.array().cast("array<struct<i:int,j:int,side:int>>")
    asked = F.when(F.col("asks"), F.transform(F.sequence(F.lit(0), F.col("nj").cast("int") - 1), lambda k: cell(i, k, F.lit(1)))).otherwise(none)
    met = F.when(F.col("meets"), F.transform(F.sequence(F.lit(0), F.col("ni").cast("int") - 1), lambda k: cell(k, j, F.lit(2)))).otherwise(none)
    one = F.array(cell(F.lit(0), F.lit(0), F.col("asks").cast("int") + 2 * F.col("meets").cast("int")))
    cells = F.when((F.col("ni") == 1) & (F.col("nj") == 1), one).otherwise(F.concat(asked, met))
    dealt = rows.join(sets, "x").select("region", "x", "comp", "d", "s", F.explode(cells).alias("c")).select("region", "c.i", "c.j", "c.side", "x", "comp", "d", "s")
    dealt = dealt.repartition("region", "i", "j").sortWithinPartitions("region", "i", "j")
    names = ["region", "x", "q"] + ["d", "linked"] * distances

    def compared(members: list[tuple]) -> pa.RecordBatch | None:
        region = members[0][0]
        side, x, comp = (np.array([m[k] for m in members]) for k in (3, 4, 5))
        a, b = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
        if not len(a) or not len(b):
            return None
        sets = [np.frombuffer(m[7], dtype=np.uint64) for m in members]
        size = np.array(list(map(len, sets)))
        if not distances:
            d = np.array([m[6] for m in members])
            na, nb = size[a][:, None], size[b]
            may = (comp[a][:, None] != comp[b]) & (np.abs(d[a][:, None] - d[b]) <= t) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            a, b = a[may.any(axis=1)], b[may.any(axis=0)]
            if not len(a):
                return None
        common = _common([sets[k] for k in a], [sets[k] for k in b])
        union = size[a][:, None] + size[b] - common
        linked = 100 * common >= percent * union
        if distances:
            k, m = np.nonzero(x[a][:, None] != x[b])
            cols = [pa.array([region] * len(k), pa.string()), *map(pa.array, (x[b][m], x[a][k], 1 - common[k, m] / union[k, m], linked[k, m]))]
        else:
            k, m = np.nonzero(linked & (comp[a][:, None] != comp[b]))
            few = np.arange(len(k)) if every else _joins(comp[a][k], comp[b][m])
            cols = [pa.array([region] * len(few), pa.string()), pa.array(x[b][m][few]), pa.array(x[a][k][few])]
        return pa.RecordBatch.from_arrays(cols, names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[:3] != key:
                    if held and (out := compared(held)) is not None:
                        yield out
                    held, key = [], row[:3]
                held.append(row)
        if held and (out := compared(held)) is not None:
            yield out

    return dealt.mapInArrow(tidy(work), "region string, x long, q long" + ", d double, linked boolean" * distances)


class _Regions:
    """The recursion: regions of members (region, x, d, home), and the components that links make."""

    every = False

    def __init__(self, spark: SparkSession, path: str, sets: DataFrame, percent: int):
        self.spark, self.path, self.sets, self.percent = spark, path, sets, percent
        self.t, self.roots, self.links, self.steps = 1 - percent / 100 + 1e-9, None, 0, 0

    def write(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        self.steps += 1
        return written(df, f"{self.path}/{name}{self.steps}", rows)

    def add(self, links: DataFrame) -> None:
        """links: (x, q)."""
        links = links.select(F.col("x").alias("u"), F.col("q").alias("v"))
        if links.take(1):
            known = links if self.roots is None else links.union(self.roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
            self.roots = components(self.spark, known)

    def measured(self, rows: DataFrame) -> DataFrame:
        """(region, x, q, d, linked) of asking q and met x; links are added."""
        fresh = self.write(_compared(rows, self.sets, self.percent, True), "distances", 256)
        self.add(fresh.filter("linked"))
        return fresh

    def live(self, state: DataFrame) -> DataFrame:
        """Members of regions with anything left to compare, with comp, a (how many are at home) and m (how many there are)."""
        if self.roots is None:
            now = state.withColumn("comp", F.col("x"))
        else:
            now = state.join(self.roots.select(F.col("node").alias("x"), "root"), "x", "left").withColumn("comp", F.coalesce("root", "x")).drop("root")
        now = self.write(now, "now")
        by_comp = now.groupBy("region", "comp").agg(F.count("*").alias("k"), F.min("d").alias("lo"), F.max("d").alias("hi"))
        by_comp = self.write(by_comp, "comps")
        main = by_comp.groupBy("region").agg(F.max(F.struct("k", "comp")).alias("main"), F.count("*").alias("comps")).filter("comps > 1").select("region", F.col("main.comp").alias("main"))
        others = by_comp.join(main, "region").filter("comp != main").groupBy("region", "main").agg((F.min("lo") - self.t).alias("lo"), (F.max("hi") + self.t).alias("hi"))
        near = now.join(self.write(others, "windows"), "region").filter("comp != main OR d BETWEEN lo AND hi")
        near = self.write(near.select("region", "x", "comp", "d", F.coalesce("home", F.col("comp") != F.col("main")).alias("home"), (F.col("comp") != F.col("main")).alias("outside")), "near")
        size = self.write(near.groupBy("region").agg(F.sum(F.col("home").cast("long")).alias("a"), F.count("*").alias("m")).filter("a > 0 AND m > 1"), "sizes")
        return self.write(near.join(size, "region"), "live")

    def parted(self, big: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(members of new regions, members of regions that cannot be parted)."""
        chance = F.pmod(F.xxhash64("region", "x"), F.greatest(F.lit(1).cast("long"), (F.col("a") / PIVOTS).cast("long")))
        big = self.write(big.withColumn("pivot", F.col("home") & F.col("outside") & (chance == 0)), "big")
        fresh = self.measured(big.select("region", "x", "comp", "d", F.col("pivot").alias("asks"), F.lit(True).alias("meets"), F.lit(1).alias("ni"), F.ceil(F.col("m") / CELL).alias("nj")))
        rest = big.filter("NOT pivot")
        far = self.write(rest.select("region", "x", "home").join(fresh.select("region", "x", "q", F.col("d").alias("dq")), ["region", "x"]), "far")
        nearest = far.filter("home").groupBy("region", "x").agg(F.min(F.struct("dq", "q")).alias("near")).select("region", "x", "near.q", "near.dq")
        nearest = self.write(nearest, "nearest")
        radius = self.write(nearest.groupBy("region", "q").agg(F.max("dq").alias("r"), F.count("*").alias("h")), "radius")
        sub = far.join(radius, ["region", "q"]).filter(F.col("dq") <= F.col("r") + self.t).join(nearest.select("region", "x", F.col("q").alias("own")), ["region", "x"], "left")
        sub = self.write(sub.select("region", "x", "q", "dq", "h", (F.col("home") & (F.col("own") == F.col("q"))).alias("home")), "sub")
        work = sub.groupBy("region", "q").agg((F.first("h") * F.count("*")).alias("work")).groupBy("region").agg(F.sum("work").alias("work"))
        gain = self.write(work.join(big.groupBy("region").agg((F.first("a") * F.first("m")).alias("before")), "region").filter("2 * work <= before").select("region"), "gain")
        new = sub.join(gain, "region").select(F.concat_ws("/", "region", F.col("q").cast("string")).alias("region"), "x", F.col("dq").alias("d"), "home")
        return new, rest.join(gain, "region", "left_anti")

    def join(self, pairs: DataFrame) -> DataFrame | None:
        """pairs: (x, p), members and the pivots of their blocks, x = p too.  (node, root) of linked members, or None."""
        region = F.col("p").cast("string").alias("region")
        count = pairs.groupBy("p").agg(F.count("*").alias("m"), F.sum((F.col("x") != F.col("p")).cast("int")).alias("others")).filter("m > 1 AND others > 0")
        count = self.write(count.select("p", F.ceil(F.col("others") / CELL).alias("nj")), "counts")
        common = (F.lit(0).cast("long").alias("comp"), F.lit(0.0).alias("d"))
        met = pairs.filter("x != p").join(count, "p").select(region, "x", *common, F.lit(False).alias("asks"), F.lit(True).alias("meets"), F.lit(1).alias("ni"), "nj")
        asks = count.select(region, F.col("p").alias("x"), *common, F.lit(True).alias("asks"), F.lit(False).alias("meets"), F.lit(1).alias("ni"), "nj")
        state = self.measured(met.union(asks)).select("region", "x", "d", F.lit(None).cast("boolean").alias("home"))
        ready = []
        while True:
            live = self.live(state)
            work = F.col("a") * F.col("m")
            ready.append(live.filter(work <= BIG))
            big = live.filter(work > BIG)
            if not big.take(1):
                break
            state, dense = self.parted(big)
            ready.append(dense)
        found = []
        for rows in ready:
            cells = rows.select("region", "x", "comp", "d", F.col("home").alias("asks"), F.lit(True).alias("meets"), F.ceil(F.col("a") / CELL).alias("ni"), F.ceil(F.col("m") / CELL).alias("nj"))
            found.append(self.write(_compared(cells, self.sets, self.percent, False, self.every), "links", 256))
        for links in found[1:]:
            found[0] = found[0].union(links)
        self.add(found[0])
        return self.roots


class _EveryLink(_Regions):
    """The same recursion, in which each member is its own component for good and all links are kept."""

    every = True

    def __init__(self, spark: SparkSession, path: str, sets: DataFrame, percent: int):
        super().__init__(spark, path, sets, percent)
        self.kept: list[DataFrame] = []

    def add(self, links: DataFrame) -> None:
        self.kept.append(links.select(F.least("x", "q").alias("a"), F.greatest("x", "q").alias("b")))

    def live(self, state: DataFrame) -> DataFrame:
        own = (F.col("x").alias("comp"), "d", F.coalesce("home", F.lit(True)).alias("home"), F.lit(True).alias("outside"))
        near = state.select("region", "x", *own)
        size = self.write(near.groupBy("region").agg(F.sum(F.col("home").cast("long")).alias("a"), F.count("*").alias("m")).filter("a > 0 AND m > 1"), "sizes")
        return self.write(near.join(size, "region"), "live")

    def all_links(self, pairs: DataFrame) -> DataFrame:
        """(a, b), a < b, once each."""
        self.join(pairs)
        found = self.kept[0]
        for more in self.kept[1:]:
            found = found.union(more)
        return found.distinct()


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class _Dealt(NamedTuple):
    """Written tables below path: classes (rep, n, least), the rows (id, digest, n, rep) that are in them, and what _Regions takes."""

    path: str
    reps: DataFrame
    members: DataFrame
    pairs: DataFrame
    sets: DataFrame

    def done(self, *names: str) -> None:
        for name in names:
            remove(self.reps.sparkSession, f"{self.path}/{name}")


def _dealt(df: DataFrame, doc_id: str, text: str, gram: int, percent: int) -> _Dealt:
    """Classes of equal sets, dealt to the regions of their blocks."""
    spark, path, key = df.sparkSession, work_dir(df.sparkSession, "jaccard"), new_key()
    docs = df.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("digest", _digest(F.col("text")))
    survey = written(_survey(docs, gram, key), f"{path}/survey")
    digests = survey.filter("n IS NOT NULL")
    # The row (at, digest) gives the class its text; at is never compared with ids as such, so that LAST_ID may stand for null.
    at = F.coalesce("id", F.lit(LAST_ID))
    classes = digests.filter("n > 0").groupBy("n", "k1", "k2").agg(F.min("id").alias("least"), F.min(F.struct(at.alias("at"), "digest")).alias("row"))
    classes = written(classes, f"{path}/classes")
    shift = next(k for k in range(64) if not classes.groupBy(_node(k)).count().filter("count > 1").take(1))
    reps = written(classes.select(_node(shift).alias("rep"), "n", "least", "row.at", "row.digest"), f"{path}/reps")
    members = written(digests.select("id", "digest", "n", F.when(F.col("n") > 0, _node(shift)).otherwise(F.col("id")).alias("rep")), f"{path}/members")

    dealt = _blocks(docs.select(at.alias("at"), "text"), gram, key, percent, _frequent(survey), shift)
    met = written(_first_of_blocks(dealt.repartition("spread").sortWithinPartitions("token", "at", "x")), f"{path}/met")
    hot = met.filter("token IS NOT NULL").drop("p")
    heads = hot.groupBy("token").agg(F.min(F.struct("at", "x")).alias("m")).select("token", F.col("m.x").alias("p"))  # MAX_FREQUENT at most
    pairs = met.filter("token IS NULL").select("x", "p", "c").union(hot.join(F.broadcast(heads), "token").select("x", "p", "c"))
    pairs = written(pairs.groupBy("x", "p").agg(F.sum("c").alias("c")), f"{path}/met_pairs")
    most = F.ceil(percent * F.col("n") / 100)
    partner = F.ceil(percent * most / 100)  # of the smallest set that x could link with, and so its blocks
    shared = pairs.groupBy("x").agg(F.sum("c").alias("c")).join(reps.select(F.col("rep").alias("x"), "n"), "x")
    need = F.least(1 + F.floor(most / MORE_BLOCKS), partner)
    may_link = written(shared.filter(F.col("c") >= need).select("x", need.alias("need")), f"{path}/may_link")
    # Two that link share `need` blocks of each; regions by which both together leave fewer are left, those with the fewest blocks first.
    left = F.sum("c").over(Window.partitionBy("x").orderBy(F.col("x") == F.col("p"), "c", "p"))
    pairs = pairs.join(may_link, "x").withColumn("left", left).filter("x = p OR 2 * left > need - 1")
    pairs = written(pairs.select("x", "p"), f"{path}/pairs")
    met = pairs.filter("x != p")
    wanted = reps.join(met.select(F.col("x").alias("rep")).union(met.select("p")).distinct(), "rep", "left_semi").select("at", "digest", "rep")
    # Repeated rows are one text.
    found = docs.select(at.alias("at"), "digest", "text").join(wanted, ["at", "digest"]).dropDuplicates(["at", "digest"])
    sets = written(_set_rows(found.select(F.col("rep").alias("x"), "text"), gram, key), f"{path}/sets", 256)
    for name in ("survey", "classes", "met", "met_pairs", "may_link"):
        remove(spark, f"{path}/{name}")
    return _Dealt(path, reps, members, pairs, sets)


def _named(dealt: _Dealt, roots: DataFrame | None) -> DataFrame:
    """(rep, least) with the least id of the component of each class; a written table.  roots: (node, root) of linked classes."""
    own = dealt.reps.select("rep", "least")
    if roots is not None:
        linked = own.join(roots.withColumnRenamed("node", "rep"), "rep")
        heads = linked.groupBy("root").agg(F.min("least").alias("head"))
        named = linked.join(heads, "root").select("rep", "head")
        own = own.join(named, "rep", "left").select("rep", F.coalesce("head", "least").alias("least"))
    return written(own, f"{dealt.path}/own")


def _component() -> Column:
    return F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id")


def _joined(df: DataFrame, doc_id: str, text: str, gram: int, percent: int) -> DataFrame:
    """doc_id, digest of the text, n_shingles, component_id, a row for each row of df."""
    dealt = _dealt(df, doc_id, text, gram, percent)
    roots = _Regions(df.sparkSession, f"{dealt.path}/regions", dealt.sets, percent).join(dealt.pairs)
    dealt.done("pairs", "sets", "regions")
    own = _named(dealt, roots)
    dealt.done("reps")
    return dealt.members.join(own, "rep", "left").select(F.col("id").alias("doc_id"), "digest", F.col("n").alias("n_shingles"), _component())


def jaccard_components(df: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the least id reachable by links), a row for each row of df."""
    return _joined(df, doc_id, text, gram, percent).drop("digest")


def jaccard_join(df: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(documents, links), from which every linked pair of documents can be had.

    documents: doc_id, n_shingles, class_id (documents with equal sets share
    one; null for an empty set), component_id, and n_links, the number of other
    rows that the row links to; a row for each row of df.  links: class_a,
    class_b and both sizes in rows, class_a < class_b, one row for each two
    different sets that link.  A class_id holds within one result only.
    """
    dealt = _dealt(df, doc_id, text, gram, percent)
    links = written(_EveryLink(df.sparkSession, f"{dealt.path}/regions", dealt.sets, percent).all_links(dealt.pairs), f"{dealt.path}/every")
    dealt.done("pairs", "sets", "regions")
    size = written(dealt.members.filter("n > 0").groupBy("rep").agg(F.count("*").alias("size")), f"{dealt.path}/class_sizes")
    side = lambda k: size.select(F.col("rep").alias(k), F.col("size").alias(f"size_{k}"))
    sized = written(links.join(side("a"), "a").join(side("b"), "b"), f"{dealt.path}/links")
    own = _named(dealt, components(df.sparkSession, links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    dealt.done("reps", "every")
    ends = sized.select(F.col("a").alias("rep"), F.col("size_b").alias("met")).union(sized.select("b", "size_a"))
    count = own.join(size, "rep").join(ends.groupBy("rep").agg(F.sum("met").alias("met")), "rep", "left")
    count = count.select("rep", "least", (F.col("size") - 1 + F.coalesce("met", F.lit(0))).alias("n_links"))
    documents = dealt.members.withColumn("class_id", F.when(F.col("n") > 0, F.col("rep"))).join(count, "rep", "left")
    documents = documents.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "class_id", _component(), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    return documents, sized.select(F.col("a").alias("class_a"), F.col("b").alias("class_b"), "size_a", "size_b")


def keep_first(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df without the documents that are linked, directly or not, to one with a smaller id; all columns stay, whatever their names."""
    later = _joined(df, doc_id, text, GRAM, PERCENT).filter("component_id < doc_id OR (doc_id IS NULL AND component_id IS NOT NULL)")
    ident, digest = fresh_name(df, "later_id"), fresh_name(df, "later_digest")
    later = later.select(F.col("doc_id").alias(ident), F.col("digest").alias(digest)).distinct()
    own = _digest(F.coalesce(df[text].cast("string"), F.lit("")))
    return df.join(later, df[doc_id].cast("long").eqNullSafe(F.col(ident)) & (own == F.col(digest)), "left_anti")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS k FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM both_ JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT a, y FROM reach JOIN edge ON x = b),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN comp ON a = d.doc_id
"""
