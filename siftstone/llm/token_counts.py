"""Token counts under a unigram vocabulary by dynamic programming over a trie of pre-tokens.

Distinct pre-tokens (words, led by the word mark) are put in order, which is a
walk through their trie: two neighbours share the trie path of their common
prefix, and the forward score of each prefix - the best log-probability of a
segmentation of it, with its number of tokens - is computed once for all words
below it.  A word's terminal count is the count at its last node.

The vocabulary is a public one that comes with an order but without unigram
probabilities, so piece r (from 0) has log-probability -log(r + 1): the
rank-frequency law, up to a constant per token that is the parameter
`token_cost`.  Characters that no piece covers fall back to their bytes, one
token each.  Of segmentations with equal scores that with fewer tokens counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.runtime import table, tidy

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
#: Words whose counts are remembered from batch to batch; a full table is emptied, results stay the same.
MEMO = 200_000
TOKEN_COST = 8.0


class UnigramTrie:
    def __init__(self, pieces: dict[str, float], byte_score: float):
        """pieces: log-probabilities; byte_score: that of each byte of a character that isn't covered."""
        self.byte_score = byte_score
        self._ends: dict[tuple[int, str], int] = {}  # the pieces, reversed, as a trie
        self._score: list[float | None] = [None]
        for piece, score in pieces.items():
            node = 0
            for ch in reversed(piece):
                at = (node, ch)
                if at not in self._ends:
                    self._score.append(None)
                    self._ends[at] = len(self._score) - 1
                node = self._ends[at]
            self._score[node] = score
        self.steps = 0  # nodes computed, for tests

    def counts(self, words: list[str]) -> dict[str, tuple[int, float]]:
        """(tokens, log-probability) of each distinct word."""
        out, before = {}, ""
        best = [(0.0, 0)]  # by prefix length: score, -tokens
        ends, scores = self._ends, self._score
        for word in sorted(set(words)):
            k, most = 0, min(len(word), len(before))
            while k < most and word[k] == before[k]:
                k += 1
            del best[k + 1 :]
            for end in range(k + 1, len(word) + 1):
                self.steps += 1
                size = len(word[end - 1].encode())
                s, n = best[end - 1]
                top = (s + size * self.byte_score, n - size)
                node, i = 0, end
                while i > 0:
                    node = ends.get((node, word[i - 1]))
                    if node is None:
                        break
                    i -= 1
                    if (score := scores[node]) is not None:
                        s, n = best[i]
                        if (other := (s + score, n - 1)) > top:
                            top = other
                best.append(top)
            out[word] = (-best[-1][1], best[-1][0])
            before = word
        return out


@cache
def unigram(path: str, token_cost: float = TOKEN_COST) -> UnigramTrie:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, n = {}, model.get_piece_size()
    for i in range(n):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            pieces[model.id_to_piece(i)] = -math.log(i + 1) - token_cost
    return UnigramTrie(pieces, -math.log(n + 1) - token_cost)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def count_tokens(df: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens and log_prob (3 decimals), a row for each row of df.

    Null and empty texts count 0; rows are independent, so repeated rows and
    null ids give rows of their own and an empty table an empty one; a text may
    be of any length that fits a task; of equal scores that with fewer tokens
    counts; extra columns are not read.
    """
    path = vocabulary or default_vocabulary()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, memo = unigram(path), {}
        for batch in batches:
            n_words, n_tokens, log_prob = [], [], []
            values, begin = batch.column(1), 0
            while begin < len(values):  # some rows at a time, so that the words held are few
                chunk, size = [], 0
                while begin < len(values) and size < 2_000_000:
                    t = values[begin].as_py() or ""
                    chunk.append(t.split())
                    size, begin = size + len(t), begin + 1
                fresh = {w for words in chunk for w in words if w not in memo}
                if len(memo) + len(fresh) > MEMO:
                    memo.clear()
                    fresh = {w for words in chunk for w in words}
                memo.update((w[1:], v) for w, v in trie.counts([MARK + w for w in fresh]).items())
                for words in chunk:
                    got = list(map(memo.__getitem__, words))
                    n_words.append(len(words))
                    n_tokens.append(sum(g[0] for g in got))
                    log_prob.append(round(math.fsum(g[1] for g in got), 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(log_prob, pa.float64())], ["doc_id", "n_words", "n_tokens", "log_prob"])

    slim = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(tidy(work), f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_words long, n_tokens long, log_prob double")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
