"""The reader in parts against csv.reader over whole files."""

import csv
import io
import random

import pytest

from siftstone.operators.offers import FIELDS
from siftstone.sources.config import ConfigError
from siftstone.sources.readers import offer_rows
from siftstone.sources.split_csv import leaves_open, read_offers_in_parts

ALIASES = {"title": ["品名"], "price": ["價格"], "url": []}


def written_file(path, seed, n, encoding, ends="\n"):
    r = random.Random(seed)
    cell = lambda: r.choice(["", "a", "價", '"quoted"', '"a ""b"" c"', '"x,y"', '"line' + ends + 'two"', 'in"side', '"closed"tail', '"' + ends * 2 + '"', "5\" pipe", '""'])
    rows = ["品名,價格,url"] + ["" if r.random() < 0.05 else f"t{k},{cell()},{cell()}" for k in range(n)]
    path.write_bytes((ends.join(rows) + (ends if seed % 2 else "")).encode(encoding))


@pytest.mark.parametrize("size", ["40b", "128m"])
def test_parts_give_what_whole_files_give(spark, tmp_path, size):
    for k, (encoding, ends) in enumerate([("utf-8", "\n"), ("utf-8-sig", "\r\n"), ("cp950", "\n"), ("utf-8", "\r")]):
        written_file(tmp_path / f"{k}.csv", k, 300, encoding, ends)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b" if size == "40b" else size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        found = sorted(tuple(x) for x in read_offers_in_parts(spark, str(tmp_path), ALIASES).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    expected = []
    for k, encoding in enumerate(["utf-8", "utf-8-sig", "cp950", "utf-8"]):
        text = (tmp_path / f"{k}.csv").read_bytes().decode(encoding)
        expected += [(*[x[f] for f in FIELDS], f"file:{tmp_path}/{k}.csv", x["_line"]) for x in offer_rows(text, ALIASES)]
    assert found == sorted(expected) and len(found) > 1000


def test_open_quotes():
    for line in ['a,b', '"a', 'a"b', '"a""', '"a"",', '"a"b"', 'x,"y', '"a","b', '"a",b"c', '""', '"""', 'a,"b""c",""']:
        for inside in (False, True):
            rows = list(csv.reader(io.StringIO(('"' if inside else "") + line + "\nEND\n", newline="")))
            assert leaves_open(line.encode(), inside) == (len(rows) == 1), (line, inside)


@pytest.mark.parametrize("text,message", [("品名\n", "no data rows"), ("", "no data rows"), ("品名,價格\n ,1\n", "no titles"), ("品名,價格\na,1\n\nb\n", "row 4 has 1 cells, not 2"), ("神秘欄\na\n", "unknown columns")])
def test_errors(spark, tmp_path, text, message):
    (tmp_path / "a.csv").write_text(text, encoding="utf-8")
    with pytest.raises(Exception, match=message) as e:
        read_offers_in_parts(spark, str(tmp_path), ALIASES).collect()
    assert isinstance(e.value, ConfigError) or "ConfigError" in str(e.value)
