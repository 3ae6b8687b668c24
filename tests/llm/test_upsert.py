"""The upsert's files against plain Python."""

import glob
import hashlib
import math
import os
import random
import zlib
from datetime import datetime

import pyarrow.parquet as pq
import pytest

DATA = "/root/testdata/sf0.001"
COLUMNS = "client_id long, master_id long, source string, updated_at timestamp, name string, email string, city string, nation_id int, segment string, balance double"
CHANGES = "change_id long, client_id long, seq long, op string, valid_at timestamp, source string, segment string, city string, balance double, home int, deletes string"
crc = lambda x: zlib.crc32(str(x).encode())


def brute(clients, changes):
    """(first_id, n_rows, cents, rows_crc, ids_sha256, rewritten) of each file; rows are dicts."""
    most = 1 + len(clients) // 1000
    null_last = lambda r: tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in r)
    rows = sorted((r for r in clients if r["client_id"] is not None and crc(r["client_id"]) % 7 > 3), key=lambda r: (r["client_id"], null_last(r)))
    start = [rows[i : i + most] for i in range(0, len(rows), most)]
    if not start:
        return []
    firsts = [f[0]["client_id"] for f in start]
    home = lambda i: max((k for k, f in enumerate(firsts) if f <= i), default=0)
    last = {}
    key = lambda c: ((c["seq"] is not None, c["seq"] or 0), (c["change_id"] is not None, c["change_id"] or 0))
    for c in changes:
        if c["client_id"] is not None and (c["client_id"] not in last or key(c) > key(last[c["client_id"]])):
            last[c["client_id"]] = c
    after = [list(f) for f in start]
    for i, c in last.items():
        h = crc(firsts[home(i)]) % 16
        if h > 7:
            continue
        gone = c["op"] == "D" or c["change_id"] is not None and crc(c["change_id"]) % 8 < h
        there = any(r["client_id"] == i for f in after for r in f)
        new = {x: c[x] for x in ("source", "segment", "city", "balance")}
        after = [[r if r["client_id"] != i else {**r, **new} for r in f if not (gone and r["client_id"] == i)] for f in after]
        if not gone and not there:
            after[home(i)].append({**dict.fromkeys(rows[0]), "client_id": i, **new})
    files = []  # rows, rewritten
    for old, new in zip(start, after, strict=True):
        if sorted(map(null_last, old)) == sorted(map(null_last, new)):
            files.append([old, False])
            continue
        new.sort(key=lambda r: (r["client_id"], null_last(r)))
        k = math.ceil(len(new) / most)
        sizes = [len(new) // k + (p < len(new) % k) for p in range(k)] if k else []
        for n in sizes:
            piece, new = new[:n], new[n:]
            if files and files[-1][1] and len(files[-1][0]) + n <= most:
                files[-1][0] = files[-1][0] + piece
            else:
                files.append([piece, True])
    out = []
    for f, rewritten in files:
        cents = sum(math.floor(100 * r["balance"] + 0.5) for r in f if r["balance"] is not None)
        sums = sum(zlib.crc32("|".join(r[c] or "" for c in ("source", "segment", "city")).encode()) for r in f)
        ids = hashlib.sha256(",".join(str(r["client_id"]) for r in f).encode()).hexdigest()
        out.append((f[0]["client_id"], len(f), cents, sums, ids, rewritten))
    return sorted(out)


def made(folder, spark, clients, changes):
    spark.createDataFrame([tuple(r.values()) for r in clients], COLUMNS + ", `home` string, `we``ird` int").write.parquet(f"{folder}/clients.parquet")
    spark.createDataFrame([tuple(r.values()) for r in changes], CHANGES).write.parquet(f"{folder}/client_changes.parquet")
    return str(folder)


def result(spark, folder, columns):
    import __spark_entry__ as entry

    rows = entry.queries()["op12_copy_on_write_upsert"](spark, folder).collect()
    assert all(r.columns == ",".join(columns) for r in rows)
    if rows:
        paths = {r.path.removeprefix("file:").replace("///", "/") for r in rows}
        assert paths == set(glob.glob(os.path.dirname(min(paths)) + "/*.parquet")) and len(paths) == len(rows)
        for r in rows:
            ids = pq.read_table(r.path.removeprefix("file:").replace("///", "/")).column("client_id").to_pylist()
            assert ids == sorted(ids) and (ids[0], len(ids)) == (r.first_id, r.n_rows)
    return sorted((r.first_id, r.n_rows, r.cents, r.rows_crc, r.ids_sha256, r.rewritten) for r in rows)


def case(seed, n, spread, m):
    r = random.Random(seed)
    word = lambda *xs: r.choice([None, *xs])
    clients = [
        dict(zip(("client_id", "master_id", "source", "updated_at", "name", "email", "city", "nation_id", "segment", "balance", "home", "odd"),
                 (i, r.randrange(9), word("web", "é"), datetime(2024, 1, 1), f"n{i}", word("e"), word("x", "y"), word(1, 2), word("a"), word(1.5, -2.345, 0.005), word("h"), word(7)), strict=True))
        for i in r.sample(range(-spread, spread), n)
    ]
    clients += [dict(clients[0]), {**clients[1], "client_id": None}] + [dict(c) for c in clients[5:9] for _ in range(2)]
    changes = [
        dict(zip(("change_id", "client_id", "seq", "op", "valid_at", "source", "segment", "city", "balance", "home", "deletes"),
                 (k, word(*range(-2 * spread, 2 * spread, 3)), word(0, 1, 2), word("U", "D", "I", "U"), None, word("web", "é"), word("a"), word("x"), word(1.5, 9.99), 1, "x"), strict=True))
        for k in range(m)
    ]
    return clients, changes + [dict(c) for c in changes[:5]]


@pytest.mark.parametrize("seed,n,spread,m", [(1, 120, 100, 60), (2, 2300, 4000, 3000), (3, 2200, 1500, 9000), (4, 40, 30, 0), (5, 5, 9, 30)])
def test_upsert(spark, tmp_path, seed, n, spread, m):
    clients, changes = case(seed, n, spread, m)
    folder = made(tmp_path, spark, clients, changes)
    columns = spark.read.parquet(f"{folder}/clients.parquet").columns
    assert result(spark, folder, columns) == brute(clients, changes)


def test_nothing(spark, tmp_path):
    assert result(spark, made(tmp_path / "a", spark, [], case(1, 5, 5, 20)[1]), []) == []
    assert result(spark, made(tmp_path / "b", spark, [], []), []) == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_tables(spark):
    clients, changes = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("clients", "client_changes"))
    assert result(spark, DATA, clients.columns) == brute(*[[r.asDict() for r in t.collect()] for t in (clients, changes)])
