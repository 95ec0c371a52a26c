"""States of a lake and of a bronze table: whole or not at all, as of a number, and their retention."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from quayside.session import new_folder, workspace_root
from quayside.sources import bronze, files
from quayside.sources.lake import Lake
from quayside.sources.snapshots import Conflict, Snapshots

NAMES = ("stg_order", "stg_product")


def store(spark, lake, value, names=NAMES):
    for name in names:
        lake.store(name, spark.range(1).select(F.lit(value).alias("v")))


def values(lake, names=NAMES):
    return [lake.table(n).first()["v"] for n in names]


def test_writers_never_share_a_number(spark):
    history = Snapshots(spark, new_folder(spark, "numbers"))
    assert history.read() == (0, {})
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda i: history.commit(lambda n, s: {"seen": [*s.get("seen", []), i]}), range(12)))
    assert sorted(got) == list(range(1, 13)) == history.numbers()
    number, state = history.read()
    assert number == 12 and sorted(state["seen"]) == list(range(12))
    assert not history.add(5, {"seen": "other"}) and len(history.read(5)[1]["seen"]) == 5
    with pytest.raises(KeyError):
        history.read(99)


def test_two_refreshes_one_wins_whole(spark):
    root = new_folder(spark, "race")
    first, second, other = Lake(spark, root), Lake(spark, root), Lake(spark, root)
    store(spark, first, 1)
    first.publish()
    store(spark, first, 2)
    store(spark, second, 3)
    store(spark, other, 9, ["dim_date"])
    second.publish()
    assert values(Lake(spark, root)) == [3, 3]
    with pytest.raises(Conflict, match="stg_order, stg_product"):
        first.publish()
    first.discard()
    other.publish()  # other tables do not conflict
    assert values(Lake(spark, root)) == [3, 3] and Lake(spark, root).table("dim_date").first()["v"] == 9


def test_a_publish_that_dies_halfway_shows_one_generation(spark, monkeypatch):
    lake = Lake(spark, new_folder(spark, "halfway"))
    store(spark, lake, 1)
    lake.publish()
    store(spark, lake, 2)
    monkeypatch.setattr(files, "rename_new", lambda *_: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError, match="killed"):
        lake.publish()
    monkeypatch.undo()
    second = Lake(spark, lake.root)
    assert values(second) == [1, 1]
    lake.publish()
    assert values(second) == [2, 2]


def test_as_of_pinned_and_retention(spark):
    lake = Lake(spark, new_folder(spark, "history"))
    for value in (1, 2, 3):
        store(spark, lake, value)
        lake.publish()
    old, pinned = Lake(spark, lake.root, as_of=1), lake.pinned()
    store(spark, lake, 4)
    lake.publish()
    assert values(old) == [1, 1] and values(pinned) == [3, 3] and values(lake) == [4, 4]
    with pytest.raises(ValueError, match="read only"):
        old.store("stg_order", spark.range(1))
    abandoned = Lake(spark, lake.root)
    store(spark, abandoned, 7)
    gone = lake.expire(keep=2)
    assert len(gone) == 4 and values(lake) == [4, 4] and values(pinned) == [3, 3]
    with pytest.raises(KeyError):
        old.table("stg_order")
    assert len(lake.expire(keep=2, unpublished_after=-1)) == 2  # the abandoned builds
    assert values(lake) == [4, 4]


def rows(spark, file, numbers, day="2024-05-01"):
    df = spark.createDataFrame([(n, file) for n in numbers], "n int, _source_file string")
    return df.withColumn("ingested_date", F.lit(day).cast("date"))


def numbers(spark, root, number=None):
    return sorted((r["_source_file"], r["n"]) for r in bronze.read_bronze(spark, root, number).collect())


def size(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_a_reloaded_file_replaces_its_rows_only(spark, tmp_path):
    root = str(tmp_path / "bronze")
    bronze.write_bronze(rows(spark, "a", range(1000)).unionByName(rows(spark, "b", range(5000))), root)
    before = size(root)
    bronze.write_bronze(rows(spark, "a", [7, 8]), root)
    after = size(root)
    assert all(after[f] == t for f, t in before.items())  # nothing is rewritten
    assert numbers(spark, root) == [("a", 7), ("a", 8)] + [("b", n) for n in range(5000)]
    assert len(numbers(spark, root, 1)) == 6000
    bronze.write_bronze(rows(spark, "a", [9], "2024-05-02").withColumn("extra", F.lit("x")), root)  # another day: added
    assert [n for f, n in numbers(spark, root) if f == "a"] == [7, 8, 9]
    bronze.write_bronze(rows(spark, "a", [1]), root)
    assert [n for f, n in numbers(spark, root) if f == "a"] == [1, 9]
    plan = bronze.read_bronze(spark, root).filter("ingested_date = '2024-05-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "ingested_date" in plan.split("PartitionFilters")[1][:200]


def test_compaction_and_vacuum(spark, tmp_path):
    root = str(tmp_path / "bronze")
    bronze.write_bronze(rows(spark, "a", range(10)).unionByName(rows(spark, "b", range(10))), root)
    for n in range(3):
        bronze.write_bronze(rows(spark, "a", [n]), root)
    want = numbers(spark, root)
    assert bronze.compact_bronze(spark, root) == 3 and numbers(spark, root) == want
    assert bronze.compact_bronze(spark, root) == 0
    assert Snapshots(spark, root).read()[1]["dirty"] == {}
    bronze.write_bronze(rows(spark, "a", [5]), root)
    assert [n for f, n in numbers(spark, root) if f == "a"] == [5]
    assert len(bronze.vacuum_bronze(spark, root, keep=1)) == 3 and [n for f, n in numbers(spark, root) if f == "a"] == [5]


def test_a_load_that_dies_is_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    bronze.write_bronze(rows(spark, "a", [1, 2]), root)
    monkeypatch.setattr(files, "rename_new", lambda *_: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        bronze.write_bronze(rows(spark, "a", [3]), root)
    monkeypatch.undo()
    assert numbers(spark, root) == [("a", 1), ("a", 2)]
    bronze.write_bronze(rows(spark, "a", [3]), root)
    assert numbers(spark, root) == [("a", 3)]
    assert len(bronze.vacuum_bronze(spark, root, unused_after=-1)) == 1


def test_loads_of_one_file_at_the_same_time(spark, tmp_path):
    root = str(tmp_path / "bronze")
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda n: bronze.write_bronze(rows(spark, "a", [n, n]), root), range(3)))
    found = numbers(spark, root)
    assert len(found) == 2 and len(set(found)) == 1


def test_a_load_is_written_once_and_not_sorted(spark, tmp_path):
    root, before = str(tmp_path / "bronze"), files.size(spark, workspace_root(spark))
    days = [rows(spark, "a", range(n, 4000, 4), f"2024-05-0{n + 1}") for n in range(4)]
    every = days[0].union(days[1]).union(days[2]).union(days[3]).repartition(2)
    added = bronze.write_bronze(every, root)
    # Besides the files and days of the load nothing is kept elsewhere: the rows are below the root alone.
    assert files.size(spark, workspace_root(spark)) - before < 10_000
    assert added.columns == every.columns and sorted(r["n"] for r in added.collect()) == list(range(4000))
    # Each of two tasks writes each day into one file, in the order of its rows.
    written = sorted(size(root))
    assert len(written) == 8 and files.names(spark, f"{root}/_writing") == []
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "64"
