"""The registered queries against plain Python, and what learned scores may depend on."""

import hashlib
import os
import random
import re
import struct
import zlib

import pytest

from test_operators import BASES, brute_components, labelled, words

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def run(spark, name, folder=DATA):
    import __spark_entry__ as entry

    return {r.doc_id: r for r in entry.queries()[name](spark, str(folder)).collect()}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@needs_data
def test_op1_and_op3(spark, texts):
    found, first = run(spark, "op1_substring_dedup"), {}
    for i in sorted(texts):
        w = words(texts[i])
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    for i, t in texts.items():
        w = words(t)
        gone = {p for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for p in range(k, k + 13)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        assert tuple(found[i])[:4] == (i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    expected = brute_components(sorted(texts.items()))
    assert {i: (r.n_shingles, r.component_id) for i, r in run(spark, "op3_jaccard_join").items()} == expected


@needs_data
def test_op4(spark, texts):
    import tiktoken

    from siftstone.llm import bpe

    path, pattern = bpe.default_vocabulary()
    ref = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.encoder(path, pattern).bpe.ranks, special_tokens={})
    for i, r in run(spark, "op4_byte_bpe").items():
        ids = ref.encode_ordinary(texts[i])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[i].encode()).hexdigest()


@needs_data
def test_op8_and_op10(spark, texts):
    from siftstone.llm import media

    for i, r in run(spark, "op8_transport_stream").items():
        data = texts[i].encode()
        payload = data + b"\xff" * (-len(data) % 576 or (0 if data else 576))
        stream = media.write_stream(payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(data), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.tail_crc32, r.media_bytes, r.media_sha256) == (zlib.crc32(payload[-32:]), len(stream), hashlib.sha256(stream).hexdigest())
    for i, r in run(spark, "op10_secret_scan").items():
        base = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(BASES) for m in p.finditer(texts[i]) if ok(m))
        shown = [f"{BASES[k][0]}:{a}:{b}" for a, k, b in base]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == j for _, k, _ in base) for j in range(3)]
        assert r.base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest() and set(shown) <= set(r.spans.split(","))


@pytest.mark.parametrize("name, label, modulus, held, level", [("op2_quality_ranking", "quality", 4, 2, 0.7), ("op9_toxicity", "toxic", 5, 0, 0.5)])
def test_learned_scores_see_only_what_they_may(spark, tmp_path, name, label, modulus, held, level):
    docs, labels = labelled(spark)
    clash = docs.selectExpr("*", "'en' AS lang", "'s' AS source", "doc_id AS n_chars", "0.5 AS score", "1 AS label", "1 AS predicted")
    held_out = lambda i: zlib.crc32(str(i).encode()) % modulus == held
    truth = [(r.doc_id, r.quality, r.toxic) for r in labels.collect() if r.doc_id is not None]
    flip = lambda v: None if v is None else 1 - v
    got = []
    for k, changed in enumerate(({}, {i: (flip(q), flip(t)) for i, q, t in truth if held_out(i)})):
        folder = tmp_path / f"{name}{k}"
        clash.union(clash.filter("doc_id IN (3, 900)")).write.parquet(str(folder / "documents.parquet"))  # repeated rows
        rows = [(i, *changed.get(i, (q, t))) for i, q, t in truth]
        spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        got.append(run(spark, name, folder))
    # Labels of held-out rows change nothing.
    assert {i: r.score for i, r in got[0].items()} == {i: r.score for i, r in got[1].items()}
    assert all(r.held_out == held_out(i) and r.predicted == (r.score >= level) and 0 <= r.score <= 1 for i, r in got[0].items())
    of = {i: (q, t)[label == "toxic"] for i, q, t in truth}
    right = [r.predicted == of[i] for i, r in got[0].items() if of.get(i) is not None and r.held_out]
    assert len(right) > 40 and sum(right) / len(right) > 0.95
    empty = tmp_path / f"{name}_empty"
    clash.limit(0).write.parquet(str(empty / "documents.parquet"))
    labels.write.parquet(str(empty / "labels.parquet"))
    assert run(spark, name, empty) == {}


def test_ranking_minimises_the_pairwise_loss():
    import numpy as np

    from siftstone.llm import quality as Q

    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, len(Q.NAMES)))
    y = (x[:, 0] + 0.5 * x[:, 3] + 0.3 * rng.normal(size=300) > 0).astype(float)
    r = Q.fit(x, y, pairs=4000)
    wide, draw = r._wide(x), np.random.default_rng(7)
    better, worse = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    d = wide[draw.choice(better, 4000)] - wide[draw.choice(worse, 4000)]
    loss = lambda w: np.log1p(np.exp(-d @ w)).mean() + 0.5e-3 * (w @ w)
    assert all(loss(r.weights) <= loss(r.weights + 0.01 * rng.normal(size=len(r.weights))) for _ in range(200))
    scores = r.score(x)
    assert (np.argsort(scores, kind="stable") == np.argsort(np.round(scores, 12), kind="stable")).all() and ((scores >= Q.THRESHOLD) == (y == 1)).mean() > 0.9
    # A score is the quantile of the raw score: it never falls as that rises.
    raw = wide @ r.weights
    assert (np.diff(scores[np.argsort(raw)]) >= -1e-12).all()


def test_features_against_plain_counts():
    from siftstone.llm import quality as Q

    text = "One two, two!  Three | THREE 45 ### x.\nlast averyveryverylongword"
    w = text.split()
    got = dict(zip(Q.NAMES, Q.features(text), strict=True))
    assert got["upper"] == sum(c.isupper() for c in text) / len(text) and got["digit"] == sum(c in "0123456789" for c in text) / len(text)
    assert got["distinct"] == len(set(w)) / len(w) and got["same_next"] == 0 and got["bar"] == 1 / len(w) and got["long"] == sum(len(x) > 14 for x in w) / len(w)
    assert got["short"] == sum(len(x) <= 3 for x in w) / len(w) and Q.features("") == Q.features(" \n") == [0.0] * len(Q.NAMES)


def test_lexicon_hits_against_plain_search():
    from siftstone.llm.toxicity import Lexicon, fold

    rng = random.Random(8)
    for _ in range(60):
        some = ["ab", "abc", "bad", "badly", "can", "trash", "cat"]
        entries = {f" {w}" + rng.choice(["", " "]): rng.random() for w in rng.sample(some, 4)}
        exceptions = [f" {rng.choice(some)} {rng.choice(some)} " for _ in range(3)]
        text = fold(" ".join(rng.choice([*some, "xx"]) for _ in range(60)))
        hidden = [(m.start(), m.start() + len(e)) for e in exceptions for m in re.finditer(f"(?={re.escape(e)})", text)]
        best = {}
        for e in entries:
            for m in re.finditer(f"(?={re.escape(e)})", text):
                best[m.start()] = max(best.get(m.start(), ""), e, key=len)
        expected = sorted((e, a) for a, e in best.items() if not any(x <= a and a + len(e) <= y for x, y in hidden))
        assert sorted(Lexicon(entries, exceptions).hits(text)) == expected


def test_folding_of_other_scripts():
    from siftstone.llm.toxicity import fold, terms

    assert fold("नमस्ते 123 안녕 !") == " नमस्ते 안녕 " and fold("笨蛋") == " 笨 蛋 " and " 笨 蛋 " in set(terms(fold("你笨蛋")))


@pytest.mark.parametrize("limit", [0, 500_000])
def test_decontamination_by_shuffle(spark, monkeypatch, limit):
    from siftstone.llm import decontaminate as D

    monkeypatch.setattr(D, "MAX_BROADCAST", limit)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = [f"w{i}" for i in range(40)]
        docs = [(1, " ".join(w)), (1, " ".join(w[20:])), (1, " ".join(w)), (None, "a b c"), (None, " ".join(w[:9])), (2, None), (3, ""), (4, "A  b, C")]
        items = [(1, " ".join(w[5:20])), (2, "a B c"), (3, " ".join(w[25:35])), (None, "c"), (5, None)]
        d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
        got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in D.contamination(d, i).collect()), key=str)
        expected = [(1, 40, 25, ["1", "3"]), (1, 20, 10, ["3"]), (1, 40, 25, ["1", "3"]), (None, 3, 3, ["2"]), (None, 9, 0, []), (2, 0, 0, []), (3, 0, 0, []), (4, 3, 3, ["2"])]
        assert got == sorted(expected, key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_archives_in_pieces(monkeypatch):
    import gzip

    from siftstone.llm import warc as W

    rng = random.Random(3)
    bodies = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 5, 300]))) for _ in range(50)]
    head = lambda b: f"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {len(b)}\r\n\r\n".encode()
    whole = b"".join(head(b) + b + b"\r\n\r\n" for b in bodies)
    packed = gzip.compress(whole[:1000]) + gzip.compress(whole[1000:])
    for piece in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(W, "PIECE", piece)
        assert [p for _, _, p in W.parse_archive(W._unpacked(packed))] == bodies
    assert [p for _, _, p in W.parse_archive(whole)] == bodies
    for bad in (packed[:-20], gzip.compress(whole[:-1]), gzip.compress(b"x" + whole)):
        with pytest.raises((ValueError, zlib.error)):
            list(W.parse_archive(W._unpacked(bad)))
