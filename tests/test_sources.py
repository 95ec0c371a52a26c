"""Landing, change detection, refresh, stream, catalog and logs on real files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quayside.config import DATASETS, LAYER_TABLES, ORDER_FEED_COLUMNS, Dataset
from quayside.plans import refresh as r
from quayside.plans.refresh import meta_root
from quayside.session import new_folder
from quayside.sources import bronze, files, runlog
from quayside.sources.lake import Lake, preview, profile, query, register_views, save_managed
from quayside.streaming.incremental import load_new_files
from tests.conftest import BASE

ORDERS = DATASETS["orders"]


def write_feed(folder, name, rows, encoding="latin-1"):
    os.makedirs(folder, exist_ok=True)
    lines = [",".join(ORDER_FEED_COLUMNS)]
    for row in rows:
        lines.append(",".join({**BASE, **row}[c] for c in ORDER_FEED_COLUMNS))
    path = os.path.join(folder, name)
    with open(path, "w", encoding=encoding) as f:
        f.write("\n".join(lines) + "\n")
    return path


ROWS = [{"Order Item Id": str(i), "Order Id": str(i // 2), "Order City": "Tegucigalpa"} for i in range(6)]


def test_latin_1_text_and_blanks_survive(spark, tmp_path):
    write_feed(tmp_path, "orders.csv", [{"Order City": "São Paulo", "Order Region": "West of USA "}])
    row = bronze.read_csv(spark, str(tmp_path), ORDERS).first()
    assert (row["Order City"], row["Order Region"]) == ("São Paulo", "West of USA ")


def feed_rows(spark, folder):
    return bronze.read_feed(spark, str(folder), Dataset("x", "x", "UTF-8", ("a", "b"), ""))


def test_columns_come_from_each_header(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "turned.csv").write_text("b,a\n4,3\n")
    (tmp_path / "MORE.CSV").write_text("\ufeffa,c,b\r\n5,x,6\r\n")
    (tmp_path / "only_header.csv").write_text("a,b\n")
    rows = feed_rows(spark, tmp_path)
    assert rows.columns[-2:] == [bronze.MALFORMED, "_file"] and sorted(rows.columns[:-2]) == ["a", "b", "c"]
    got = {r["_file"]: (r["a"], r["b"], r["c"], r[bronze.MALFORMED]) for r in rows.collect()}
    assert got == {"one.csv": ("1", "2", None, None), "turned.csv": ("3", "4", None, None), "MORE.CSV": ("5", "6", "x", None)}


def test_header_names():
    assert bronze.column_names('a,"b, c",a,,a') == ["a", "b, c", "a.1", "Unnamed: 3", "a.2"]


def test_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b\n"say ""hi"" now","x, y"\n"two\nlines",2\n')
    (tmp_path / "plain.csv").write_text("a,b\n1,2\n")
    rows = feed_rows(spark, tmp_path).collect()
    assert {(r["a"], r["b"]) for r in rows} == {('say "hi" now', "x, y"), ("two\nlines", "2"), ("1", "2")}
    marks = bronze.file_marks(spark, str(tmp_path)).collect()
    assert {r["file"]: r["multi_line"] for r in marks} == {"q.csv": True, "plain.csv": False}


def test_validation(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "notes.txt").write_text("x")
    (tmp_path / "a+b c.csv").write_text("x\n")
    found = {f["file"]: (f["valid"], f["reason"]) for f in bronze.validate_files(spark, str(tmp_path), ["gone.csv", "notes.txt"]).collect()}
    assert found == {
        "empty.csv": (False, "empty"),
        "notes.txt": (False, "not a .csv file"),
        "a+b c.csv": (True, None),
        "gone.csv": (False, "missing"),
    }


def test_malformed_rows_are_counted(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n3\n,\n4,5,6\n")
    row = bronze.malformed_counts(spark, str(tmp_path), Dataset("x", "x", "UTF-8", ("a", "b"), "")).first()
    assert (row["row_count"], row["malformed_count"]) == (4, 2)


def test_marks_tell_changed_files(spark, tmp_path):
    folder = str(tmp_path)
    (tmp_path / "same.csv").write_text("x\n1\n2\n")
    (tmp_path / "other.CSV").write_text("x\n1\n2\n")
    (tmp_path / "notes.txt").write_text("x")

    def marks():
        return spark.createDataFrame(bronze.file_marks(spark, folder).withColumn("dataset_name", F.lit("d")).collect())

    first = marks()
    assert {(r["file"], r["header"]) for r in first.collect()} == {("same.csv", "x"), ("other.CSV", "x")}
    state = first.withColumnRenamed("file", "source_file")
    for text in ("x\n1\n3\n", "x\n2\n1\n", "x\n1\n2\n\n"):  # other bytes, other order, one more line
        (tmp_path / "other.CSV").write_text(text)
        assert [f["file"] for f in bronze.changed_files(marks(), state).collect()] == ["other.CSV"]


def test_a_mark_does_not_depend_on_splits(spark, tmp_path):
    (tmp_path / "long.csv").write_text("a,b\n" + "".join(f"{i},{i * i % 97}\n" for i in range(20_000)))
    found = set()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "50000", "7001"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            row = bronze.file_marks(spark, str(tmp_path)).first()
            found.add((row["file_hash"], row["header"]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 1


def test_ingest_sets_malformed_rows_aside_and_keeps_new_columns(spark, tmp_path):
    lake = Lake(spark, new_folder(spark, "real"))
    (tmp_path / "a.CSV").write_text('event_id,ts,note\n1,t,"x ""y"""\n2,t\n3,t,n,more\n')
    (tmp_path / "empty_feed.csv").write_text("event_id,ts\n")
    r.run_bronze(lake, {"clickstream": str(tmp_path)}, "2024-05-01")
    log = {x["source_file"]: x for x in runlog.history(spark, meta_root(lake), "ingestion_logs").collect()}
    assert (log["a.CSV"]["status"], log["a.CSV"]["rows_ingested"], log["a.CSV"]["rows_rejected"]) == ("SUCCESS", 1, 2)
    assert log["a.CSV"]["error_message"] == "2 malformed rows set aside"
    assert (log["empty_feed.csv"]["status"], log["empty_feed.csv"]["rows_ingested"]) == ("SUCCESS", 0)
    broken = runlog.history(spark, meta_root(lake), "rejected_rows").collect()
    assert {(x["source_file"], x["line"]) for x in broken} == {("a.CSV", "2,t"), ("a.CSV", "3,t,n,more")}
    (tmp_path / "b.csv").write_text("ts,event_id,other\nt,9,z\n")
    r.run_bronze(lake, {"clickstream": str(tmp_path)}, "2024-05-02")
    rows = {x["event_id"]: x for x in lake.table("bronze_clickstream").collect()}
    assert rows["1"]["note"] == 'x "y"' and rows["9"]["other"] == "z" and rows["1"]["other"] is None


def test_csv_copy_and_parquet_share_the_load_time(spark, tmp_path):
    lake = Lake(spark, new_folder(spark, "times"))
    write_feed(tmp_path / "in", "orders.csv", ROWS)
    run = r.run_bronze(lake, {"orders": str(tmp_path / "in")}, "2024-05-01")
    copy = spark.read.option("header", True).csv(f"{lake.root}/bronze/orders_csv/orders/run={run}")
    times = {x[0] for x in copy.select(F.to_timestamp("_ingested_at")).collect()}
    assert times == {x[0] for x in lake.table("bronze_orders").select("_ingested_at").collect()} and len(times) == 1


def test_a_load_keeps_a_packed_copy_and_no_parsed_rows(spark, tmp_path):
    lake = Lake(spark, new_folder(spark, "packed"))
    write_feed(tmp_path / "in", "orders.csv", ROWS)
    kept = lambda: [n for n in files.names(spark, new_folder(spark, "x").rsplit("/", 1)[0]) if n.startswith(("parsed-", "landing-"))]
    before = kept()
    run = r.run_bronze(lake, {"orders": str(tmp_path / "in")}, "2024-05-01")
    copies = [n for n in files.names(spark, f"{lake.root}/bronze/orders_csv/orders/run={run}") if n.startswith("part-")]
    assert copies and all(n.endswith(".csv.gz") for n in copies)
    assert kept() == before


def test_a_lake_outlives_its_process(spark, tmp_path):
    root = new_folder(spark, "reopened")
    write_feed(tmp_path / "in", "orders.csv", ROWS)
    landing = {"orders": str(tmp_path / "in")}
    accepted = {}
    first = r.refresh(Lake(spark, root), landing, "2024-05-01", accepted)
    again = Lake(spark, root)
    second = r.refresh(again, landing, "2024-05-02", accepted)
    key = lambda df: sorted((x["dataset_name"], x["row_count"]) for x in df.collect())
    assert key(first) == key(second)
    third = Lake(spark, root)
    assert query(third, "SELECT count(*) AS n FROM fact_order_items", ["facts"]).first()["n"] == 6
    assert third.table("bronze_orders").count() == 6
    assert r.gate(third, r.GOLD_RULES, "run-x").filter("NOT passed").count() == 0
    assert r.refresh(third, {}, stages=["silver"]).count() == len(LAYER_TABLES["silver"])


def test_a_failed_build_leaves_the_last_good_table(spark, tmp_path):
    from quayside.operators.quality import QualityError

    lake = Lake(spark, new_folder(spark, "good"))
    write_feed(tmp_path / "in", "orders.csv", ROWS)
    r.run_bronze(lake, {"orders": str(tmp_path / "in")}, "2024-05-01")
    r.run_silver(lake)
    write_feed(tmp_path / "in", "bad.csv", [{"Order Item Id": "77", "Order Id": "770", "Order Customer Id": "5"}])
    r.run_bronze(lake, {"orders": str(tmp_path / "in")}, "2024-05-02")
    with pytest.raises(QualityError):
        r.run_silver(lake)
    assert lake.table("stg_order_items").count() == 6 and Lake(spark, lake.root).table("stg_order_items").count() == 6
    with pytest.raises(KeyError, match="has not been built"):
        lake.table("dim_order")
    with pytest.raises(ValueError):
        r.gate(Lake(spark, new_folder(spark, "nothing")), [], "run")


def test_ingest_skips_unchanged_files_and_replaces_a_rerun(spark, tmp_path):
    lake = Lake(spark, new_folder(spark, "ingest"))
    folder = str(tmp_path / "in")
    write_feed(folder, "orders.csv", ROWS)

    def load():
        run = r.run_bronze(lake, {"orders": folder}, "2024-05-01")
        log = runlog.history(spark, meta_root(lake), "ingestion_logs").filter(F.col("run_id") == run)
        return [(x["source_file"], x["status"], x["rows_ingested"]) for x in log.collect()]

    assert load() == [("orders.csv", "SUCCESS", 6)]
    assert load() == [("orders.csv", "SKIPPED", None)]
    assert lake.table("bronze_orders").count() == 6
    # Changed bytes on the same day: the file's partition is replaced, not doubled.
    write_feed(folder, "orders.csv", ROWS[:4])
    assert load() == [("orders.csv", "SUCCESS", 4)]
    assert lake.table("bronze_orders").count() == 4
    # Another file of the day is added beside it; the broken one is logged.
    write_feed(folder, "more.csv", ROWS[4:])
    open(os.path.join(folder, "empty.csv"), "w").close()
    assert sorted(load()) == [("empty.csv", "FAILED", None), ("more.csv", "SUCCESS", 2), ("orders.csv", "SKIPPED", None)]
    table = lake.table("bronze_orders")
    assert table.count() == 6
    assert {x["_record_status"] for x in table.collect()} == {"ACTIVE"}
    assert str(table.first()["ingested_date"]) == "2024-05-01"

    meta = meta_root(lake)
    runs = runlog.current(spark, meta, "pipeline_runs")
    assert runs.count() == 4 and runs.filter("status = 'RUNNING'").count() == 0
    assert runs.filter("status = 'FAILED'").count() == 1
    entry = runlog.of_layer(runlog.current(spark, meta, "metadata_catalog"), "bronze").first()
    assert entry["column_count"] == len(ORDER_FEED_COLUMNS) and len(entry["column_names"]) == len(ORDER_FEED_COLUMNS) + 5
    assert entry["file_format"] == "parquet"
    assert runlog.current(spark, meta, "dataset_state").count() == 2


def test_datasets_can_skip_parquet(spark, tmp_path):
    lake = Lake(spark, new_folder(spark, "dictionary"))
    (tmp_path / "fields.csv").write_text("FIELDS,DESCRIPTION\nType,kind\n")
    r.run_bronze(lake, {"dictionary": str(tmp_path)})
    entry = runlog.current(spark, meta_root(lake), "metadata_catalog").first()
    assert (entry["file_format"], entry["row_count"]) == ("csv", 1)


def test_a_missing_folder_fails_its_dataset_only(spark, tmp_path):
    lake = Lake(spark, new_folder(spark, "missing"))
    write_feed(tmp_path / "in", "orders.csv", ROWS)
    r.run_bronze(lake, {"clickstream": str(tmp_path / "gone"), "orders": str(tmp_path / "in")})
    run = runlog.current(spark, meta_root(lake), "pipeline_runs").first()
    assert (run["status"], run["success_count"], run["failed_count"], run["total_rows"]) == ("FAILED", 1, 1, 6)
    assert "clickstream" in run["error_message"]


def test_stream_equals_batch(spark, tmp_path):
    folder, root, checkpoint = str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "cp")
    write_feed(folder, "a.csv", ROWS[:3])
    load_new_files(spark, folder, ORDERS, root, checkpoint, "run-1", "2024-05-01")
    write_feed(folder, "b.csv", ROWS[3:])
    load_new_files(spark, folder, ORDERS, root, checkpoint, "run-2", "2024-05-01", files_per_batch=1)
    streamed = bronze.read_bronze(spark, root)
    assert {x["_source_file"]: x["n"] for x in streamed.groupBy("_source_file").agg(F.count("*").alias("n")).collect()} == {
        "a.csv": 3,
        "b.csv": 3,
    }
    assert {x["_ingestion_run_id"] for x in streamed.filter("_source_file = 'a.csv'").collect()} == {"run-1"}
    write_feed(folder, "c.CSV", ROWS[:2])
    load_new_files(spark, folder, ORDERS, root, checkpoint, "run-3")
    streamed = bronze.read_bronze(spark, root)
    assert streamed.filter("_source_file = 'c.CSV'").select("ingested_date").distinct().count() == 1
    batch = bronze.read_csv(spark, folder, ORDERS)
    columns = [F.col(f"`{c}`") for c in ORDER_FEED_COLUMNS]
    assert sorted(streamed.select(*columns).collect()) == sorted(batch.select(*columns).collect())


def test_stream_lands_changed_files_and_sets_malformed_rows_aside(spark, tmp_path):
    folder, root, checkpoint = str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "cp")
    dataset = Dataset("x", "x", "UTF-8", ("a", "b"), "")
    os.makedirs(folder)

    def load(run):
        load_new_files(spark, folder, dataset, root, checkpoint, run, "2024-05-01", files_per_batch=2)
        log = runlog.history(spark, f"{checkpoint}-meta", "ingestion_logs").filter(F.col("run_id") == run).collect()
        rows = sorted((r["_source_file"], r["a"], r["b"]) for r in bronze.read_bronze(spark, root).collect())
        return {x["source_file"]: (x["status"], x["rows_ingested"], x["rows_rejected"]) for x in log}, rows

    for name in "stu":
        (tmp_path / "in" / f"{name}.csv").write_text("a,b\n1,2\n3\n4,5,6\n")
    log, rows = load("run-1")
    assert log == {f"{n}.csv": ("SUCCESS", 1, 2) for n in "stu"} and rows == [(f"{n}.csv", "1", "2") for n in "stu"]
    rejected = runlog.history(spark, f"{checkpoint}-meta", "rejected_rows")
    assert sorted(r["line"] for r in rejected.filter("source_file = 's.csv'").collect()) == ["3", "4,5,6"]
    assert load("run-2")[0] == {}
    (tmp_path / "in" / "s.csv").write_text("a,b\n7,8\n9,9\n")
    os.utime(tmp_path / "in" / "t.csv", (1, 1))  # touched, not changed
    log, rows = load("run-3")
    assert log == {"s.csv": ("SUCCESS", 2, 0), "t.csv": ("SKIPPED", None, None)}
    assert rows == [("s.csv", "7", "8"), ("s.csv", "9", "9"), ("t.csv", "1", "2"), ("u.csv", "1", "2")]
    # The batch load of the same folder has the same rows.
    assert sorted((r["a"], r["b"]) for r in bronze.read_csv(spark, folder, dataset).collect()) == sorted(x[1:] for x in rows)
    assert {(r["file"], r["line"]) for r in bronze.read_rejected(spark, folder, dataset).collect()} == {
        (f"{n}.csv", x) for n in "tu" for x in ("3", "4,5,6")
    }


def test_unchanged_files_are_not_opened(spark, tmp_path, monkeypatch):
    lake = Lake(spark, new_folder(spark, "listed"))
    path = tmp_path / "a.csv"
    path.write_text("event_id,ts\n1,t\n2,t\n")
    (tmp_path / "b.csv").write_text("event_id,ts\n9,t\n")
    opened = []
    real = bronze.file_marks
    monkeypatch.setattr(bronze, "file_marks", lambda s, f, e, paths: opened.append(sorted(p.rsplit("/", 1)[1] for p in paths)) or real(s, f, e, paths))

    def load(**how):
        opened.clear()
        run = r.run_bronze(lake, {"clickstream": str(tmp_path)}, "2024-05-01", **how)
        log = runlog.history(spark, meta_root(lake), "ingestion_logs").filter(F.col("run_id") == run).collect()
        return {x["source_file"]: x["status"] for x in log}

    assert load() == {"a.csv": "SUCCESS", "b.csv": "SUCCESS"} and opened == [["a.csv", "b.csv"]]
    assert load() == {"a.csv": "SKIPPED", "b.csv": "SKIPPED"} and opened == []
    os.utime(path, (5, 5))
    assert load() == {"a.csv": "SKIPPED", "b.csv": "SKIPPED"} and opened == [["a.csv"]]
    assert load() == {"a.csv": "SKIPPED", "b.csv": "SKIPPED"} and opened == []
    path.write_text("event_id,ts\n1,t\n3,t\n")
    os.utime(path, (5, 5))  # same length, same time: only an audit sees it
    assert load() == {"a.csv": "SKIPPED", "b.csv": "SKIPPED"} and opened == []
    assert load(audit=True) == {"a.csv": "SUCCESS", "b.csv": "SKIPPED"} and opened == [["a.csv", "b.csv"]]
    assert sorted(x["event_id"] for x in lake.table("bronze_clickstream").collect()) == ["1", "3", "9"]


def test_gate_stops_the_refresh(spark, tmp_path):
    from quayside.operators.quality import QualityError

    lake = Lake(spark, new_folder(spark, "gate"))
    write_feed(tmp_path / "in", "orders.csv", [{"Order Customer Id": "77"}])
    r.run_bronze(lake, {"orders": str(tmp_path / "in")})
    with pytest.raises(QualityError, match="relationships_stg_order_customer_id"):
        r.run_silver(lake)
    log = runlog.history(spark, meta_root(lake), "model_run_logs")
    assert log.filter("schema_name = 'test' AND status = 'fail'").count() == 1


def test_unreadable_dates_fail_or_are_set_aside(spark, tmp_path):
    lake = Lake(spark, new_folder(spark, "dates"))
    bad = {"Order Item Id": "50", "Order Id": "50", "order date (DateOrders)": "13/31/2018 22:56"}
    write_feed(tmp_path / "in", "orders.csv", [*ROWS, bad])
    r.run_bronze(lake, {"orders": str(tmp_path / "in")})
    with pytest.raises(Exception):
        r.run_silver(lake)
    r.run_silver(lake, lenient=True)
    assert lake.table("stg_order_items").count() == 6 and lake.table("stg_order").count() == 3
    line = runlog.history(spark, meta_root(lake), "rejected_rows").first()
    assert line["source_file"] == "orders.csv" and json.loads(line["line"])["Order Id"] == "50"


def test_views_sql_preview_and_profile(lake, spark):
    assert register_views(lake, ["dimensions"]) == list(LAYER_TABLES["dimensions"])
    rows = query(lake, "SELECT count(*) AS n FROM dim_order WHERE market = :market", ["dimensions"], {"market": "ASIA"})
    assert rows.first()["n"] == lake.table("dim_order").filter("market = 'ASIA'").count()
    with pytest.raises(KeyError, match="dim_orders"):
        lake.table("dim_orders")
    assert preview(lake.table("dim_order"), 5).count() == 5
    row = profile({"dim_date": lake.table("dim_date")}, "gold").first()
    assert (row["column_count"], row["column_names"][0], row["column_types"][0], row["has_rows"]) == (10, "date_key", "int", True)
    stored = save_managed(lake.table("dim_product"), "stored_products", new_folder(spark, "managed"))
    assert stored.count() == lake.table("dim_product").count()


def test_run_report_in_one_multi_line_file(spark, tmp_path):
    report = {
        "metadata": {"invocation_id": "i1"},
        "results": [
            {"unique_id": "model.shop.dim_order", "status": "success", "execution_time": 1.23456, "message": "OK",
             "adapter_response": {"materialization": "external", "rows_affected": 5}},
            {"unique_id": "test.shop.unique_dim_order.ab12", "status": "pass", "execution_time": 0.5, "message": None,
             "adapter_response": None},
        ],
    }
    (tmp_path / "run.json").write_text(json.dumps(report, indent=2))
    rows = runlog.flatten_run_reports(runlog.read_run_reports(spark, str(tmp_path))).orderBy("schema_name").collect()
    assert [(x["model_name"], x["schema_name"], x["execution_time"], x["rows_affected"]) for x in rows] == [
        ("dim_order", "model", 1.235, 5),
        ("unique_dim_order", "test", 0.5, None),
    ]
