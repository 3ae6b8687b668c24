"""Toxicity by a weighted lexicon.

Texts are folded (lower case, accents kept, look-alike letters and digit
substitutions mapped to plain letters, everything but letters and their marks
to one space; in scripts without spaces each character is a word) and searched
by an Aho-Corasick automaton.  Entries are words or stems at a word's begin, or
two to four characters of a script without spaces, weighted by the log-odds of
their occurrence in toxic and clean labelled documents; exception phrases (two
words around an entry that clean documents repeat and toxic ones don't have)
hide the entries inside them.  The weighted hits are normalised by a power of
the number of words, and a logistic curve fitted on the sample turns that to a
score.

Defined results: a null or empty text, or one without letters, has no hits and
the score of none; rows are independent, so repeated rows and ids give repeated
results, a null id is kept, and an empty table gives an empty one; of entries
that begin at one place the longest counts; a text may be of any length that
fits a task, searching it takes time in proportion; a score of just the
threshold is toxic; extra columns, of any name, are not read, and keep_clean
keeps them.  Labels without an id or a value are left out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.labelled import SAMPLE_ROWS, fit_logistic, remainder, sample
from siftstone.llm.runtime import table, tidy

THRESHOLD = 0.5
STEM, LONGEST = 4, 10
#: Entries and exception phrases of a lexicon at most.
MAX_ENTRIES, MAX_EXCEPTIONS = 400, 2_000
LEAST_DOCS, LEAST_ODDS = 6, 1.2

#: Letters that look like a plain one (Cyrillic, Greek, full width) and what is typed in place of a letter.
_ALIKE = dict(zip("аеорсухівкмнтԁѕјһαοερυνικτ", "aeopcyxibkmhtdsjhaoepuvikt", strict=True))
_ALIKE |= {chr(0xFF41 + k): chr(0x61 + k) for k in range(26)}
_DIGITS = dict(zip("013457@$!", "oieastasi", strict=True))
_FOLD, _LOOKS, _TYPES = str.maketrans(_ALIKE), re.compile(f"[{''.join(_ALIKE)}]"), re.compile("[013457@$!]")
_TYPED = re.compile(r"(?<=[^\W\d_])[013457@$!]+(?=[^\W\d_])|(?<![\w@$!])[013457@$]+(?=[^\W\d_])")
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
#: Han, kana, Thai, Lao, Burmese and Khmer.
_UNSPACED = re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]")
_FEW, _MANY = 2, 4  # characters of an entry of these


def fold(text: str) -> str:
    """Folded words, each led by a space, with a space at the end."""
    text = text.lower()
    if _LOOKS.search(text):
        text = text.translate(_FOLD)
    if _TYPES.search(text):
        text = _TYPED.sub(lambda m: "".join(map(_DIGITS.__getitem__, m[0])), text)
    text = _OTHER.sub(" ", text).strip()
    if _UNSPACED.search(text):
        text = " ".join(_UNSPACED.sub(r" \g<0> ", text).split())
    return f" {text} "


def stems(word: str) -> Iterator[str]:
    """' wor' for stems, ' word ' for the whole word."""
    for k in range(STEM, min(LONGEST, len(word)) + 1):
        yield " " + word[:k]
    if len(word) > 1:
        yield f" {word} "


def terms(folded: str) -> Iterator[str]:
    """What may be an entry."""
    words = folded.split()
    for w in set(words):
        yield from stems(w)
    if _UNSPACED.search(folded):
        alone = [bool(_UNSPACED.match(w)) for w in words]
        for k in range(len(words)):
            for n in range(_FEW, _MANY + 1):
                if k + n <= len(words) and all(alone[k : k + n]):
                    yield f" {' '.join(words[k : k + n])} "


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    power: float = 0.5
    slope: float = 0.0
    bias: float = -10.0

    def __post_init__(self):
        self._machine = None

    def __getstate__(self):
        return self.__dict__ | {"_machine": None}

    def hits(self, folded: str) -> Iterator[tuple[str, int]]:
        """(entry, position) outside of exception phrases; of entries that begin at one place the longest."""
        if not self.weights:
            return
        if self._machine is None:
            import ahocorasick

            self._machine = ahocorasick.Automaton()
            for e in self.weights:
                self._machine.add_word(e, (e, False))
            for e in self.exceptions:
                self._machine.add_word(e, (e, True))
            self._machine.make_automaton()
        best: dict[int, str] = {}
        hidden: list[tuple[int, int]] = []
        for end, (entry, exception) in self._machine.iter(folded):
            start = end - len(entry) + 1
            if exception:
                hidden.append((start, end))
            elif len(entry) > len(best.get(start, "")):
                best[start] = entry
        hidden.sort()
        k, cover = 0, -1  # the farthest end of the exceptions that begin so far
        for start in sorted(best):
            while k < len(hidden) and hidden[k][0] <= start:
                k, cover = k + 1, max(cover, hidden[k][1])
            if start + len(best[start]) - 1 > cover:
                yield best[start], start

    def total(self, text: str) -> tuple[float, int]:
        """(sum of weights, number of words)."""
        folded = fold(text)
        return sum(self.weights[e] for e, _ in self.hits(folded)), max(1, folded.count(" ") - 1)

    def score(self, text: str) -> float:
        total, n = self.total(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * total / n**self.power + self.bias))))


def _counts(texts: DataFrame, terms) -> DataFrame:
    """term, toxic and clean documents that have it; terms(text) gives those of a text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bad, good = Counter(), Counter()
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                (bad if y else good).update(set(terms(t or "")))
            names = list(bad | good)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([bad[k] for k in names], pa.int64()), pa.array([good[k] for k in names], pa.int64())], ["term", "toxic", "clean"])

    return texts.mapInArrow(tidy(work), "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, rows: int = SAMPLE_ROWS) -> Lexicon:
    """Without toxic (or clean) rows in the sample the lexicon is empty and scores are near 0."""
    texts = sample(docs, labels, "toxic", modulus, held_out, rows)
    size = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    n_bad, n_good = size.get(1, 0), size.get(0, 0)
    if not n_bad or not n_good:
        return Lexicon({})
    odds = F.log((F.col("toxic") + 0.5) / (n_bad + 1)) - F.log((F.col("clean") + 0.5) / (n_good + 1))
    gain = F.col("toxic") / n_bad - F.col("clean") / n_good
    found = _counts(texts, lambda t: terms(fold(t))).filter(f"toxic >= {LEAST_DOCS}")
    found = found.select("term", "toxic", "clean", odds.alias("odds"), gain.alias("gain")).filter(F.col("odds") >= LEAST_ODDS)
    top = found.orderBy(F.desc("gain"), "term").limit(20 * MAX_ENTRIES).collect()  # bounded
    chosen: dict[str, tuple[float, int, int]] = {}
    for r in sorted(top, key=lambda r: (-r["gain"], -len(r["term"]), r["term"])):
        # A stem's longer forms with the same documents come first; later ones that add nothing are left out.
        stem, known = r["term"].rstrip(), False
        for k in range(STEM + 1, len(stem) + 1):
            if (c := chosen.get(stem[:k])) and r["odds"] < c[0] + 0.7:
                known = True
        if not known and not any(e.startswith(stem) and abs(c[1] - r["toxic"]) <= 0.1 * r["toxic"] for e, c in chosen.items()):
            chosen[r["term"]] = (r["odds"], r["toxic"], r["clean"])
            if len(chosen) >= MAX_ENTRIES:
                break
    lexicon = Lexicon({e: c[0] for e, c in chosen.items()})

    def around(text: str) -> Iterator[str]:
        folded = fold(text)
        for _, start in lexicon.hits(folded):
            end = folded.index(" ", start + 1)
            nxt = folded.find(" ", end + 1)
            if nxt > 0:
                yield folded[start : nxt + 1]
            before = folded.rfind(" ", 0, start)
            if before >= 0 and start:
                yield folded[before : end + 1]

    # Phrases that clean documents have at least ten times as often, measured by the numbers of documents.
    phrases = _counts(texts, around).filter((F.col("clean") >= 4) & (F.col("toxic") * n_good * 10 <= F.col("clean") * n_bad))
    lexicon = Lexicon(lexicon.weights, [r["term"] for r in phrases.orderBy(F.desc("clean"), "term").limit(MAX_EXCEPTIONS).collect()])

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [lexicon.total(t or "") for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64()), b.column(1).cast(pa.int32())], ["total", "n", "label"])

    got = sorted(map(tuple, texts.mapInArrow(tidy(totals), "total double, n long, label int").collect()))  # at most `rows` short rows
    total, n, y = (np.array(c, dtype=float) for c in zip(*got, strict=True))
    best = None
    for power in (0.0, 0.25, 0.5, 0.75, 1.0):
        x = total / n**power
        scale = max(x.std(), 1e-9)
        slope, bias = fit_logistic((x / scale)[:, None], y, ridge=1e-4)
        wrong = ((slope * x / scale + bias >= 0) != (y == 1)).sum()
        if best is None or wrong < best[0]:
            best = (wrong, power, float(slope / scale), float(bias))
    return Lexicon(lexicon.weights, lexicon.exceptions, *best[1:])


def score_documents(df: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1), a row for each row of df; null and empty texts have no hits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([lexicon.score(t.as_py() or "") for t in b.column(1)], pa.float64())], ["doc_id", "score"])

    slim = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(tidy(work), f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double")


def keep_clean(df: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of df whose text scores below threshold, with all their columns."""
    at = df.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([lexicon.score(str(t.as_py() or "")) < threshold for t in b.column(at)], pa.bool_()))

    return df.mapInArrow(tidy(work), df.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
