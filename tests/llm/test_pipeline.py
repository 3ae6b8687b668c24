import os

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_stages_against_their_operators(spark):
    import corpus_pipeline as P
    from siftstone.llm import bpe, decontaminate, jaccard_join, secrets, toxicity
    from siftstone.llm.runtime import table, work_dir, written

    docs, columns = table(spark, DATA, "documents"), table(spark, DATA, "documents").columns
    assert [n for n, _ in P.STAGES] == ["toxicity", "jaccard_join", "decontamination", "secret_scan", "byte_bpe"]
    for name, stage in P.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        after = written(stage(spark, docs, DATA), work_dir(spark, "test"))
        got = {r.doc_id: r for r in after.collect()}
        if name != "byte_bpe":
            assert after.columns == columns
        if name == "toxicity":
            lexicon = toxicity.train(table(spark, DATA, "documents"), table(spark, DATA, "labels"))
            assert set(got) == {i for i, r in before.items() if lexicon.score(r.text or "") < 0.5}
        elif name == "jaccard_join":
            assert set(got) == {r.doc_id for r in jaccard_join.jaccard_components(docs).collect() if r.doc_id == r.component_id}
        elif name == "decontamination":
            bad = decontaminate.contamination(docs, table(spark, DATA, "benchmark")).filter("n_hit > 0").collect()
            assert set(got) == set(before) - {r.doc_id for r in bad}
        elif name == "secret_scan":
            found = {r.doc_id for r in secrets.scan_secrets(docs).collect() if r.secrets.base or r.secrets.added}
            assert set(got) == set(before) and {i for i in got if got[i].text != before[i].text} == found
            assert all(got[i].n_chars == len(got[i].text) for i in found)
        else:
            enc = bpe.encoder(*bpe.default_vocabulary())
            assert all(enc.bpe.decode(r.ids).decode() == before[i].text for i, r in got.items())
        docs = after


def redacted(text):
    """Plain Python: base kinds by pattern, entropy windows by counting, spans that overlap as one."""
    import re

    from siftstone.llm import secrets as S
    from test_operators import BASES, hot_spans

    base = [(m.start(), m.end()) for _, p, ok in BASES for m in p.finditer(text) if ok(m)]
    spans = list(base)
    for m in re.finditer(S.CANDIDATE, text):
        if not any(re.fullmatch(a, m[0]) for a in S.ALLOW):
            kind = "hex" if re.fullmatch("[0-9a-fA-F]+", m[0]) else "lower" if re.fullmatch("[a-z0-9]+", m[0]) else "mixed"
            hot = [(m.start() + a, m.start() + b) for a, b in hot_spans(m[0], S.THRESHOLDS[kind])]
            spans += [s for s in hot if not any(a <= s[0] and s[1] <= b for a, b in base)]
    out, pos = "", 0
    for a, b in sorted(spans):
        if a >= pos:
            out += text[pos:a] + "[REDACTED]"
        pos = max(pos, b)
    return out + text[pos:]


def test_run_against_plain_python(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing columns: run() gives what five plain loops give."""
    import hashlib
    import random
    import re
    import struct

    import tiktoken

    import corpus_pipeline as P
    from siftstone.llm import bpe, toxicity
    from test_operators import brute_components

    r = random.Random(8)
    vocabulary = [f"w{k}" for k in range(400)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [("b1", prose(14)), ("b2", prose(4)), ("b3", None), ("b4", "")]
    texts: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (3, "one two"), (None, prose(60))]
    for k in range(10, 60):
        t = prose(r.randint(5, 80))
        kind = k % 10
        t = (
            f"{prose(20)} filthscum {t}" if kind == 1 else f"{t} password: hunter{k}xx and AKIA{'Q7Z' * 6}" if kind == 2 else f"{t} {items[0][1]}" if kind == 3 else f"{items[1][1].upper()}! {t}" if kind == 4
            else f"{t} kJ8fQ2zLx9VbT4mW7sYpR3aN6cHd{k} é" if kind == 5 else t
        )
        texts.append((k, t))
    texts += [(k, f"{prose(12)} {'filthscum' if k % 2 else 'kind'} {prose(12)}") for k in range(200, 320)]
    long = prose(30_000)
    texts += [(100, long), (101, long.replace("w7 ", "w8 ", 3)), (102, texts[12][1]), (None, texts[13][1]), (14, texts[8][1]), (103, "x" * 50_000)]
    columns = "doc_id long, text string, lang string, source string, n_chars long, secrets string, gaps int, digest string, copy long, `bad_id` string"
    rows = [(i, t, None, "s", None if t is None else len(t), "x", 1, None, 2, "y") for i, t in texts]
    folder = str(tmp_path)
    spark.createDataFrame(rows, columns).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int("filthscum" in t)) for i, t in texts if i and t is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")

    lexicon = toxicity.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    left = [(i, t or "") for i, t in texts if lexicon.score(t or "") < toxicity.THRESHOLD]
    assert sum("filthscum" in t for _, t in left) < sum("filthscum" in (t or "") for _, t in texts)
    # Rows without an id come after all others; a row is its place here, so that repeated ids stay apart.
    order = sorted(range(len(left)), key=lambda k: (left[k][0] is None, left[k][0] or 0, k))
    groups = brute_components([(at, left[k][1]) for at, k in enumerate(order)])
    left = [left[k] for at, k in enumerate(order) if groups[at][1] == at]
    tokens = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {tuple(w[k : k + 10]) for _, t in items if (w := tokens(t)) for k in range(max(1, len(w) - 9))}
    hit = lambda w: any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))
    left = [(i, redacted(t)) for i, t in left if not hit(tokens(t))]
    path, pattern = bpe.default_vocabulary()
    ref = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.encoder(path, pattern).bpe.ranks, special_tokens={})
    expected = []
    for i, t in left:
        ids = ref.encode_ordinary(t)
        expected.append((i is None, i or 0, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    found = [(x.doc_id is None, x.doc_id or 0, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in P.run(spark, folder).collect()]
    assert sorted(found) == sorted(expected) and len(expected) > 20


def test_run_on_empty_tables(spark, tmp_path):
    import corpus_pipeline as P

    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id string, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
