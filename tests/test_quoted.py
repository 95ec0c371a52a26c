"""Quoted files read by many tasks, against the reading of a whole file by one."""

import csv
import random

import pytest

from quayside.config import Dataset
from quayside.sources import bronze, quoted

FEED = Dataset("x", "x", "UTF-8", ("a", "b", "c"), "")


def cells(r):
    some = ["", "x", "two\nlines", 'say "hi"', "a,b", "\n\n", '"', 'end"\n', "é日本", "long " * r.randint(0, 30), "many\n" * r.randint(0, 20)]
    return [r.choice(some) + str(r.randint(0, 9)) for _ in range(3)]


def write(path, rows, ending="\n", encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        writer = csv.writer(f, lineterminator=ending, quoting=csv.QUOTE_ALL if "all" in path.name else csv.QUOTE_MINIMAL)
        writer.writerow(["a", "b", "c"])
        writer.writerows(rows)


def got(spark, folder, dataset=FEED):
    rows = bronze.read_feed(spark, str(folder), dataset)
    return sorted((r["_file"], r["a"], r["b"], r["c"]) for r in rows.collect())


@pytest.mark.parametrize(("size", "listed"), [("128m", quoted.LISTED), ("3000", 0), ("300", quoted.LISTED), ("64", quoted.LISTED)])
def test_many_splits_equal_one(spark, tmp_path, monkeypatch, size, listed):
    monkeypatch.setattr(quoted, "LISTED", listed)
    r = random.Random(5)
    want = []
    for name, ending in (("min.csv", "\n"), ("all.CSV", "\n"), ("crlf.csv", "\r\n")):
        rows = [cells(r) for _ in range(150)]
        write(tmp_path / name, rows, ending)
        want += [(name, *row) for row in rows]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        found = got(spark, tmp_path)
        if size == "300" and listed:
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == sorted(want)


def test_malformed_and_odd_records(spark, tmp_path):
    (tmp_path / "q.csv").write_bytes('a,b,c\n1,"x\ny",3\n\n4,5\n"6\n6",7,8,9\n"open,1,2\nto the end\n'.encode())
    rows = bronze.read_feed(spark, str(tmp_path), FEED).collect()
    good = {(r["a"], r["b"], r["c"]) for r in rows if r[bronze.MALFORMED] is None}
    assert good == {("1", "x\ny", "3")}
    assert {r[bronze.MALFORMED].split("\n")[0] for r in rows if r[bronze.MALFORMED] is not None} == {"4,5", '"6', '"open,1,2'}


def test_latin_1(spark, tmp_path):
    write(tmp_path / "l.csv", [["São", "x\ny", "ç"]], encoding="latin-1")
    assert got(spark, tmp_path, Dataset("x", "x", "ISO-8859-1", ("a", "b", "c"), "")) == [("l.csv", "São", "x\ny", "ç")]


def test_only_headers_and_picked_files(spark, tmp_path):
    (tmp_path / "h.csv").write_text('a,b,"c"\n')
    write(tmp_path / "one.csv", [["1", "x\ny", "2"]])
    write(tmp_path / "two.csv", [["3", "x\nz", "4"]])
    marks = bronze.file_marks(spark, str(tmp_path)).filter("file <> 'two.csv'")
    rows = bronze.read_feed(spark, str(tmp_path), FEED, marks).collect()
    assert {(r["_file"], r["a"]) for r in rows} == {("one.csv", "1")}
