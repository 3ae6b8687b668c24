"""Dictionaries as tables, graphs in rounds and classes of groups against plain Python."""

import random
import time
from itertools import combinations

from pyspark.sql import functions as F

from siftstone.operators import dictionary as D
from siftstone.operators import graphs
from siftstone.operators import images as I
from siftstone.operators import offers as O

NAME = "name string, category string, idx long"


def test_occurrences(spark, monkeypatch):
    monkeypatch.setattr(D, "WINDOW", 7)
    monkeypatch.setattr(D, "MOST_LEVELS", 3)
    r = random.Random(1)
    texts = [None, "", "a"] + ["".join(r.choice("ab字c") for _ in range(r.randint(1, 40))) for _ in range(40)]
    keys = sorted({"".join(r.choice("ab字c") for _ in range(r.choice([1, 2, 3, 4, 5, 6, 7, 9, 12]))) for _ in range(60)}) + ["", None]
    rows, entries = spark.createDataFrame(list(enumerate(texts)), "id int, t string"), spark.createDataFrame([(k, f"v{k}") for k in keys], "key string, v string")
    found = sorted(tuple(x) for x in D.occurrences(rows, ["id"], "t", entries, "key").collect())
    expected = sorted((i, p + 1, k, f"v{k}") for i, t in enumerate(texts) if t for k in keys if k for p in range(len(t)) if t.startswith(k, p))
    assert found == expected and len(found) > 300
    assert D.occurrences(rows, ["id"], "t", entries.limit(0), "key").count() == 0


def test_levels():
    assert D.levels_of([3, 5, 5]) == [3, 5] and D.levels_of([]) == []
    levels = D.levels_of(range(2, 300))
    assert len(levels) <= D.MOST_LEVELS and levels[0] == 2 and levels == sorted(levels)


def rules(n):
    """n aliases, n category words and n done entries."""
    return O.Rules(
        brand_aliases={f"brand{k}": [f"alias{k}x"] for k in range(n)}, categories={f"c{k}": [f"word{k}w"] for k in range(n)}, done=tuple((f"done{k}z", "" if k % 2 else "series") for k in range(n)),
        done_policy={"same_brand_same_series": "exclude", "same_brand_other_series": "mark"},
    )


def test_large_dictionaries(spark):
    """A hundred thousand entries of each kind: the plan is as long as with two thousand, and the answers are right."""
    r, n = random.Random(2), 100_000
    rows = []
    for i in range(300):
        k = r.randrange(n)
        rows.append((r.choice([f"Alias{k}x tea word{k}w", f"done{k}z series", f"other thing {k}", f"the brand{k} word{k}w done{k}z"]), r.choice([None, f"c{k}", "none"]), i))
    df, sizes, began = spark.createDataFrame(rows, NAME), {}, time.time()
    for m in (2_000, n):
        out = O.categorised(O.named(df, rules(m)), rules(m))
        sizes[m] = len(out._jdf.queryExecution().optimizedPlan().toString())
    assert sizes[n] < 1.05 * sizes[2_000] + 500
    got = {x.idx: x for x in out.collect()}
    print(f"{time.time() - began:.1f} s, plan {sizes}")
    for name, category, i in rows:
        x, low = got[i], name.lower()
        brand = next((f"brand{w[5:-1]}" if w.startswith("alias") else w for w in low.split() if w.startswith(("alias", "brand"))), None)
        if brand is None and "done" in low:
            brand = next(w for w in low.split() if w.startswith("done"))
        # An alias that is a beginning of another one ends where the longer one goes on.
        assert x.brand == (brand or low.split()[0]), (name, x.brand)
        words = {f"c{w[4:-1]}" for w in name.split() if w.startswith("word")} | ({category} if category and category != "none" else set())
        assert set(x.cat_now) == words, (name, category, x.cat_now)
        assert [d.label for d in x.done] == [f"{w}｜series" if int(w[4:-1]) % 2 == 0 else w for w in name.split() if w.startswith("done")], (name, x.done)


def union_find(nodes, edges):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for g, a, b in edges:
        x, y = sorted((find((g, a)), find((g, b))))
        root[y] = x
    return {x: find(x)[1] for x in nodes}


def test_components(spark):
    r, nodes, edges = random.Random(3), [], []
    for g, n in (("path", 90), ("star", 60), ("random", 200), ("none", 5)):
        nodes += [(g, k) for k in range(n)]
        ids = list(range(n))
        r.shuffle(ids)
        if g == "path":
            edges += [(g, a, b) for a, b in zip(ids, ids[1:])]
        elif g == "star":
            edges += [(g, ids[0], b) for b in ids[1:]]
        elif g == "random":
            edges += [(g, r.randrange(n), r.randrange(n)) for _ in range(120)]
    found = graphs.components(spark.createDataFrame(nodes, "g string, id long"), spark.createDataFrame(edges + edges[:9], "g string, a long, b long"), "g")
    assert {(x.g, x.id): x.root for x in found.collect()} == union_find(nodes, edges)


def test_suppression(spark):
    r = random.Random(4)
    boxes = [(i % 3, i, r.randrange(5), x := r.randrange(60), y := r.randrange(60), x + r.randint(0, 90), y + r.randint(1, 80)) for i in range(150)]
    df = spark.createDataFrame(boxes, "img long, id long, n long, x0 long, y0 long, x1 long, y1 long")
    kept = {}
    for img, i, n, x0, y0, x1, y1 in sorted(boxes, key=lambda b: (b[0], -b[2], b[1])):
        area = lambda b: (b[2] - b[0]) * (b[3] - b[1])
        common = lambda a, b: max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
        box = (x0, y0, x1, y1)
        if not any(common(o, box) > 0.5 * (area(o) + area(box) - common(o, box)) for o in kept.get(img, {}).values()):
            kept.setdefault(img, {})[i] = box
    assert {(x.img, x.id) for x in I.suppress(df).collect()} == {(g, i) for g, k in kept.items() for i in k}


def test_pending_classes_say_what_the_pairs_say(spark):
    r = random.Random(5)
    groups = [(i, r.choice(["", "A", "a", "B"]), "".join(r.choice(["bolt", "x", "y", "ring"]) for _ in range(r.randint(0, 3))), r.choice(["", "red", "blue"])) for i in range(70)]
    df, rules_ = spark.createDataFrame(groups, "gid long, brand string, series string, flavour string"), O.Rules(categories={"h": ["bolt", "ring"]})
    expected = set()
    for (i, b, s, f), (j, c, t, g) in combinations(groups, 2):
        shared = [w for w in ("bolt", "ring") if w in s and w in t]
        contained = bool(s and t and (s in t or t in s))
        if b and b.lower() == c.lower() and (not f or not g or f == g) and (shared or contained):
            expected.add((i, j, "、".join(shared), contained))
    assert {tuple(x) for x in O.pending_pairs(df, rules_).collect()} == expected
    classes, links = O.pending_classes(df, rules_)
    assert classes.count() == len({(b.lower(), s, f) for _, b, s, f in groups if b})
    assert {(x.class_id, x.word) for x in links.filter(F.col("kind") == "word").collect()} == {(min(i for i, c, t, g in groups if (c.lower(), t, g) == (b.lower(), s, f)), w) for _, b, s, f in groups if b for w in ("bolt", "ring") if w in s}


def test_a_dictionary_of_the_data_does_not_pass_through_the_driver(spark):
    import __spark_entry__ as entry

    df = entry.queries()["dictionary_emails"](spark, "/root/testdata/sf0.001")
    df.collect()
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    # one from a rule file still is sent to all tasks
    texts, words = spark.createDataFrame([(1, "abcd"), (2, "bc")], "id long, t string"), D.dictionary(spark, [("bc",), ("cd",)], "w string")
    few = D.occurrences(texts, ["id"], "t", words, "w", [2])
    assert sorted(map(tuple, few.collect())) == [(1, 2, "bc"), (1, 3, "cd"), (2, 1, "bc")]
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
