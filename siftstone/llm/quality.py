"""Quality scores by Bradley-Terry ranking.

Every text has a vector of surface features.  From labelled documents pairs
(a better, a worse one) are drawn; the model is the weight vector that
minimises the logistic loss of the pairs' feature differences.  A text's score
is the quantile of its raw score among the sample, stretched so that the
quantile that best parts the labels lies at THRESHOLD.

Defined results: a null or empty text, or one without words, has the features
0; rows are independent, so repeated rows and ids give repeated results, a null
id is kept, and an empty table gives an empty one; equal raw scores have equal
scores, one of just THRESHOLD is predicted 1; a text may be of any length that
fits a task; extra columns, of any name, are not read.  Labels without an id or
a value are left out; without both labels in the sample every score is the same.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.labelled import SAMPLE_ROWS, fit_logistic, remainder, sample
from siftstone.llm.runtime import table, tidy

THRESHOLD = 0.7
#: Preference pairs that are drawn from the sample.
PAIRS = 60_000
_SYMBOLS = "#%$&*|@^~<>{}[]\\=+_"
_ENDS = ".!?…。！？"

NAMES = (
    "upper", "bang", "symbol", "bar", "digit", "space", "newline", "end", "comma",
    "same_next", "distinct", "distinct_log", "pair_distinct", "short", "long", "mean", "log_words", "no_letter", "capital", "top",
)


def features(text: str) -> list[float]:
    """Shares of characters and words of the whole text; all 0 for a text without words."""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    if not n:
        return [0.0] * len(NAMES)
    count = text.count
    letters_up = sum(map(str.isupper, text)) if not text.islower() else 0
    distinct = set(words)
    pairs = set(zip(words, words[1:], strict=False))
    lengths = list(map(len, words))
    return [
        letters_up / chars,
        min(1.0, count("!") / n),
        min(1.0, sum(map(count, _SYMBOLS)) / n),
        min(1.0, count("|") / n),
        sum(map(count, "0123456789")) / chars,
        (count(" ") + 1) / n - 1 if n else 0.0,
        min(1.0, count("\n") / n),
        min(1.0, sum(map(count, _ENDS)) / n),
        min(1.0, count(",") / n),
        sum(map(eq, words, words[1:])) / n,
        len(distinct) / n,
        np.log(len(distinct)) / np.log(n + 1.0),
        (len(pairs) + 1) / n,
        sum(k <= 3 for k in lengths) / n,
        sum(k > 14 for k in lengths) / n,
        min(2.0, sum(lengths) / n / 10),
        np.log1p(n) / 10,
        sum(1 for w in words if not w[0].isalpha() and not w[-1].isalpha()) / n,
        sum(w[0].isupper() for w in words) / n,
        max(Counter(words).values()) / n,
    ]


@dataclass
class Ranker:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores at the quantiles of levels
    levels: np.ndarray  # scores there

    def _wide(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        return np.hstack([z, np.abs(z), np.maximum(z - 1, 0), np.maximum(-1 - z, 0)])

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self._wide(x) @ self.weights, self.knots, self.levels)


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Ranker:
    """A sample with one label only gives a ranker that scores every text THRESHOLD or 0."""
    if len(set(y.tolist())) < 2:
        level = THRESHOLD if len(y) and y[0] == 1 else 0.0
        k = x.shape[1] if x.ndim == 2 else len(NAMES)
        return Ranker(np.zeros(k), np.ones(k), np.zeros(4 * k), np.array([0.0, 1.0]), np.array([level, level]))
    r = Ranker(np.median(x, axis=0), np.maximum(x.std(axis=0), 1e-3), np.empty(0), np.empty(0), np.empty(0))
    wide, rng = r._wide(x), np.random.default_rng(seed)
    better, worse = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    d = wide[rng.choice(better, pairs)] - wide[rng.choice(worse, pairs)]
    sign = np.where(np.arange(pairs) % 2, 1.0, -1.0)  # half of the pairs turned round
    r.weights = fit_logistic(d * sign[:, None], (sign > 0).astype(float), bias=False)
    raw = wide @ r.weights
    # The cut with the fewest errors, by its quantile; then quantiles on both sides of it are stretched.
    order = np.argsort(raw, kind="stable")
    ones_below = np.concatenate([[0], np.cumsum(y[order] == 1)])
    zeros_above = (y == 0).sum() - np.concatenate([[0], np.cumsum(y[order] == 0)])
    cut = int(np.argmin(ones_below + zeros_above))
    q = min(max(cut / len(y), 1e-3), 1 - 1e-3)
    at = np.unique(np.concatenate([np.linspace(0, q, 200), np.linspace(q, 1, 200)]))
    knots = np.quantile(raw, at)
    levels = np.where(at <= q, at / q * THRESHOLD, THRESHOLD + (at - q) / (1 - q) * (1 - THRESHOLD))
    keep = np.concatenate([[True], np.diff(knots) > 0])
    r.knots, r.levels = knots[keep], levels[keep]
    return r


def train(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2, rows: int = SAMPLE_ROWS) -> Ranker:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([features(t or "") for t in b.column(0).to_pylist()], pa.list_(pa.float64())), b.column(1).cast(pa.int32())], ["x", "label"])

    got = sample(docs, labels, "quality", modulus, held_out, rows).mapInArrow(tidy(work), "x array<double>, label int").collect()  # at most `rows` short rows
    got = sorted((tuple(r.x), r.label) for r in got)
    return fit(np.array([g[0] for g in got]).reshape(len(got), len(NAMES)), np.array([g[1] for g in got]))


def score_documents(df: DataFrame, ranker: Ranker, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1), a row for each row of df; null and empty texts score as texts without words do."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py() or "") for t in b.column(1)]).reshape(len(b), len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ranker.score(x), pa.float64())], ["doc_id", "score"])

    slim = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(tidy(work), f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double")


def op2_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
