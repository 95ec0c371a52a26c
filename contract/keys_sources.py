"""S: scans, sinks, change detection, catalog and logs. C: data tests. L: the layered refresh."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.keys_tables import feed_columns, feed_sql
from contract.oracle import big, r
from contract.registry import ORACLE, key
from quayside.config import ACCEPTED_VALUES, DATASETS, GOLD_LAYERS, LAYER_TABLES, Dataset
from quayside.functions import round_to, stable
from quayside.operators import quality
from quayside.operators.upsert import upsert
from quayside.plans.refresh import gate, meta_root, refresh, run_bronze
from quayside.sources import bronze, files, lake, runlog
from quayside.streaming.incremental import load_new_files
from quayside.fixtures import order_feed

ORDERS = DATASETS["orders"]
ALL_TABLES = [n for names in LAYER_TABLES.values() for n in names]


def table_sql(name: str) -> str:
    """The table in SQL; the feature table there has the item id besides."""
    return "(SELECT * EXCLUDE (order_item_id) FROM feat_items)" if name == "feat_delivery_risk" else name


def src(name: str):
    return F.col(f"`{name}`")


_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def landing(w) -> str:
    """The order feed as latin-1 text files, one folder per load year; written once per workspace.

    From 1996 on, the columns come in another order and with two more, one of them full of quotes, commas and line breaks.
    """
    if not hasattr(w, "_landing"):
        folder = w.scratch("landing")
        feed = order_feed(w.spark, w.sf_dir).withColumn("load_year", F.year("_ingested_at")).drop("_ingested_at")
        late = F.col("load_year") >= 1996
        said = F.concat(F.lit('say "'), src("Product Name"), F.lit('",\nthen more'))
        wider = feed.select(
            F.lit("a@b.c").alias("Customer Email"),
            *[src(c) for c in reversed(feed.columns)],
            # Line breaks are rare, as in real feeds.
            F.when(src("Order Item Id") % 50 == 0, said).otherwise(F.regexp_replace(said, "\n", " ")).alias("Product Description"),
        )
        for rows in (feed.filter(~late), wider.filter(late)):
            writer = rows.write.mode("append").partitionBy("load_year").options(**_BLANKS)
            writer.option("header", True).option("encoding", ORDERS.encoding).option("escape", '"').csv(folder)
        w._landing = folder
    return w._landing


@key(
    "s01_csv_scan",
    f"""SELECT {feed_sql()}, CASE WHEN year(_ingested_at) >= 1996 THEN 'say "' || product_name || '",' ||
    CASE WHEN order_item_id % 50 = 0 THEN chr(10) ELSE ' ' END || 'then more' END AS description,
  CASE WHEN year(_ingested_at) >= 1996 THEN 'a@b.c' END AS email FROM wide""",
)
def _s01(w):
    rows = bronze.read_csv(w.spark, landing(w), ORDERS)
    return stable(
        rows.select(*feed_columns(), src("Product Description").alias("description"), src("Customer Email").alias("email"))
    )


@key(
    "s02_source_validation",
    """SELECT TRUE AS all_valid, count(*) AS row_count, sum(CASE WHEN event_id % 100 < 2 THEN 1 ELSE 0 END)::BIGINT AS malformed_count,
  sum(CASE WHEN event_id % 100 >= 2 THEN event_id END)::BIGINT AS good_ids FROM events""",
)
def _s02(w):
    """Of a hundred lines one lacks a field and one has a field too many."""
    folder, line = w.scratch("malformed"), F.concat_ws(",", "event_id", "event_type", "user_id")
    short = F.concat_ws(",", "event_id", "event_type")
    of_hundred = F.col("event_id") % 100
    lines = w.source("events").select(
        F.when(of_hundred == 0, short).when(of_hundred == 1, F.concat(line, F.lit(",more"))).otherwise(line).alias("event_id,event_type,user_id")
    )
    lines.write.option("header", True).option("sep", "\u0001").csv(folder)
    dataset = Dataset("events", "events", "UTF-8", (), "")
    valid = bronze.validate_files(w.spark, folder).join(bronze.malformed_counts(w.spark, folder, dataset), "file")
    good = bronze.read_csv(w.spark, folder, dataset).agg(F.sum(F.col("event_id").cast("bigint")).alias("good_ids"))
    return valid.agg(
        F.every("valid").alias("all_valid"),
        F.sum("row_count").alias("row_count"),
        F.sum("malformed_count").alias("malformed_count"),
    ).withColumn("good_ids", good.scalar())


@key(
    "s03_change_detection",
    """SELECT 'orders_' || year(_ingested_at) AS dataset_name,
  CASE WHEN year(_ingested_at) >= 1999 THEN 'CHANGED' ELSE 'SKIPPED' END AS status, count(*) AS row_count
FROM wide GROUP BY 1, 2""",
)
def _s03(w):
    year = F.regexp_extract("path", r"load_year=(\d+)", 1)
    marks = bronze.file_marks(w.spark, landing(w), ORDERS.encoding).withColumn("dataset_name", F.concat(F.lit("orders_"), year))
    # The stored state knows the files of the older loads and other bytes for the newer ones.
    state = marks.select(
        "dataset_name",
        F.col("file").alias("source_file"),
        F.when(year < "1999", F.col("file_hash")).otherwise("other bytes").alias("file_hash"),
    )
    changed = bronze.changed_files(marks, state).select("dataset_name", F.lit("CHANGED").alias("status")).distinct()
    rows = bronze.read_feed(w.spark, landing(w), ORDERS).select(
        F.concat(F.lit("orders_"), F.regexp_extract("_file", r"load_year=(\d+)", 1)).alias("dataset_name"),
        src("Order Item Id"),
    )
    counts = rows.groupBy("dataset_name").agg(F.count(F.lit(1)).alias("row_count"))
    joined = counts.join(changed, "dataset_name", "left")
    return joined.select("dataset_name", F.coalesce("status", F.lit("SKIPPED")).alias("status"), "row_count")


def _landed(w):
    """A lake that has loaded the landing folder once, and the id of the run."""
    if not hasattr(w, "_first_load"):
        fresh = lake.Lake(w.spark, w.scratch("loaded"))
        w._first_load = (fresh, run_bronze(fresh, {"orders": landing(w)}, "2024-01-01"))
    return w._first_load


@key(
    "s04_lineage_columns",
    """SELECT year(_ingested_at) AS load_year, 'orders' AS _dataset_name, 'ACTIVE' AS _record_status, count(*) AS row_count,
  count(*) AS copied, TRUE AS same_run, 1::BIGINT AS load_times FROM wide GROUP BY 1""",
)
def _s04(w):
    """The Parquet rows and their CSV copy carry the same lineage, one load time for all."""
    loaded, run_id = _landed(w)
    rows = loaded.table("bronze_orders")
    copy = w.spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(
        f"{loaded.root}/bronze/orders_csv/orders/run={run_id}"
    )
    year = F.regexp_extract("_source_file", r"load_year=(\d+)", 1).cast("bigint").alias("load_year")
    keys = [year, "_dataset_name", "_record_status"]
    same = F.every(F.col("_ingestion_run_id") == run_id)
    stored = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), same.alias("same_run"), F.collect_set("_ingested_at").alias("times"))
    copied = copy.groupBy(*keys).agg(F.count(F.lit(1)).alias("copied"), F.collect_set(F.to_timestamp("_ingested_at")).alias("copy_times"))
    joined = stored.join(copied, ["load_year", "_dataset_name", "_record_status"])
    times = F.size(F.array_union("times", "copy_times")).cast("bigint").alias("load_times")
    return joined.select("load_year", "_dataset_name", "_record_status", "row_count", "copied", "same_run", times)


@key(
    "s05_partitioned_sink",
    f"""SELECT CAST(ts AS DATE) AS ingested_date, event_type || '.csv' AS _source_file, count(*) AS row_count,
  {r("sum(CASE WHEN event_type = 'click' AND CAST(ts AS DATE) >= DATE '2024-01-15' THEN value + 1 ELSE value END)")} AS total
FROM events GROUP BY 1, 2""",
)
def _s05(w):
    """A file per event type; one of them is loaded again for some days, with other values: only its rows of those days change."""
    path = w.scratch("sink")
    clicks = w.table("bronze_clickstream").withColumn("_source_file", F.concat("event_type", F.lit(".csv")))
    bronze.write_bronze(clicks, path)
    again = clicks.filter("ingested_date >= '2024-01-15' AND event_type = 'click'")
    bronze.write_bronze(again.withColumn("value", F.col("value") + 1), path)
    back = bronze.read_bronze(w.spark, path)
    return stable(
        back.groupBy("ingested_date", "_source_file").agg(F.count(F.lit(1)).alias("row_count"), F.sum("value").alias("total"))
    )


@key(
    "s06_csv_sink",
    f"SELECT event_type, count(*) AS row_count, {r('sum(value)')} AS total, min(props) AS first_props FROM events GROUP BY 1",
)
def _s06(w):
    path = w.scratch("csv")
    clicks = w.table("bronze_clickstream").drop("ingested_date")
    bronze.write_csv(clicks, path)
    back = w.spark.read.schema(bronze.feed_schema(clicks.columns)).option("header", True).option("escape", '"').csv(path)
    return stable(
        back.groupBy("event_type").agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col("value").cast("double")).alias("total"),
            F.min("props").alias("first_props"),
        )
    )


@key(
    "s07_partition_pruned_read",
    "SELECT ingested_date, count(*) AS row_count FROM wide WHERE ingested_date >= DATE '1999-01-01' GROUP BY 1",
)
def _s07(w):
    recent = w.table("bronze_orders").filter(F.col("ingested_date") >= F.lit("1999-01-01").cast("date"))
    return recent.groupBy("ingested_date").agg(F.count(F.lit(1)).alias("row_count"))


@key("s08_external_table", "SELECT order_status, count(*) AS orders FROM stg_order GROUP BY 1")
def _s08(w):
    stored = w.rebuild("stg_order")
    return stored.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))


@key("s09_catalog_table", "SELECT is_cross_border, count(*) AS customers FROM feat_customer GROUP BY 1")
def _s09(w):
    stored = lake.save_managed(w.table("feat_customer"), "feat_customer_table", w.scratch("table"))
    return stored.groupBy("is_cross_border").agg(F.count(F.lit(1)).alias("customers"))


_LAYER_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS view_name, count(*) AS row_count FROM {table_sql(n)}"
    for n in ALL_TABLES
)


@key("s10_layer_views", _LAYER_SQL)
def _s10(w):
    names = lake.register_views(w, list(LAYER_TABLES))
    listed = lake.list_tables(w.spark).filter("isTemporary").select(F.col("tableName").alias("view_name"))
    counts = None
    for name in names:
        one = w.spark.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("view_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts.join(listed, "view_name", "left_semi")


@key("s11_preview_100", "SELECT order_id, order_status, order_region FROM dim_order ORDER BY order_id LIMIT 100")
def _s11(w):
    return lake.preview(lake.load_table(w, "dim_order"), 100, by=["order_id"]).select(
        "order_id", "order_status", "order_region"
    )


@key("s11_table_size", "SELECT count(*) AS row_count, 14 AS column_count FROM fact_order_items")
def _s11_size(w):
    table = lake.load_table(w, "fact_order_items")
    return table.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.lit(len(table.columns)))


@key(
    "s12_named_parameters",
    f"""SELECT department_name, {r('sum(total_sales)')} AS total_sales FROM mart_executive_summary
WHERE order_region IN ('AFRICA 0', 'ASIA 2') GROUP BY 1""",
)
def _s12(w):
    return stable(
        lake.query(
            w,
            "SELECT department_name, sum(total_sales) AS total_sales FROM mart_executive_summary "
            "WHERE order_region IN (:region_0, :region_1) GROUP BY department_name",
            layers=["marts"],
            params={"region_0": "AFRICA 0", "region_1": "ASIA 2"},
        )
    )


_GOLD_TABLES = [n for layer in GOLD_LAYERS for n in LAYER_TABLES[layer]]
# DuckDB's name of each type, and Spark's.
_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "HUGEINT": "bigint",
}


def _profile_sql(name: str) -> str:
    kind = "CASE column_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _TYPES.items()) + " END"
    listed = f"(SELECT string_agg(column_name || ' ' || {kind}, ',' ORDER BY column_name) FROM (DESCRIBE SELECT * FROM {table_sql(name)}))"
    return (
        f"SELECT '{name}' AS dataset_name, 'gold' AS layer, count(*) AS row_count, count(*) > 0 AS has_rows, "
        f"{listed} AS columns FROM {table_sql(name)}"
    )


@key("s13_layer_profile", " UNION ALL ".join(_profile_sql(n) for n in _GOLD_TABLES))
def _s13(w):
    profiled = lake.profile({n: w.table(n) for n in _GOLD_TABLES}, "gold")
    pairs = F.transform(F.arrays_zip("column_names", "column_types"), lambda x: F.concat_ws(" ", x["column_names"], x["column_types"]))
    return profiled.select("dataset_name", "layer", "row_count", "has_rows", F.concat_ws(",", F.array_sort(pairs)).alias("columns"))


@key(
    "s14_keyed_upsert",
    f"""WITH sides AS (
  SELECT 0 AS side, event_id, CAST(ts AS DATE) AS day, user_id, event_type, {r('value')} AS value FROM events WHERE event_id % 2 = 0
  UNION ALL SELECT 1, event_id, CAST(ts AS DATE), user_id, event_type, {r('value')} FROM events WHERE event_id % 2 = 1)
SELECT user_id, event_type, event_id, day, value FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY user_id, event_type ORDER BY day DESC, side DESC, event_id) AS rn FROM sides) WHERE rn = 1""",
)
def _s14(w):
    """Events of odd number are the new side; by day, both sides often have the last one of a key."""
    events = w.source("events").select("event_id", F.to_date("ts").alias("day"), "user_id", "event_type", "value")
    odd = F.col("event_id") % 2 == 1
    return stable(upsert(events.filter(~odd), events.filter(odd), ["user_id", "event_type"], "day"))


def _load_logs(w):
    kind = F.col("event_type")
    return w.source("events").select(
        F.col("user_id").cast("string").alias("run_id"),
        kind.alias("dataset_name"),
        F.when(kind == "error", "FAILED").when(kind == "signup", "SKIPPED").otherwise("SUCCESS").alias("status"),
        F.when(~kind.isin("error", "signup"), F.floor("value")).alias("rows_ingested"),
        F.col("ts").alias("logged_at"),
        "event_id",
    )


@key(
    "s15_run_summary",
    f"""SELECT CAST(user_id AS VARCHAR) AS run_id, count(*) AS total_datasets,
  {big("sum(CASE WHEN event_type NOT IN ('error', 'signup') THEN 1 ELSE 0 END)")} AS success_count,
  {big("sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)")} AS skipped_count,
  {big("sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)")} AS failed_count,
  {big("coalesce(sum(CASE WHEN event_type NOT IN ('error', 'signup') THEN floor(value) END), 0)")} AS total_rows,
  CASE WHEN sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
FROM events GROUP BY 1""",
)
def _s15(w):
    return runlog.summarise_loads(_load_logs(w))


@key(
    "s15_latest_loads",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS run_id, event_type AS dataset_name, ts AS logged_at FROM events
ORDER BY ts DESC, event_id LIMIT 20""",
)
def _s15_latest(w):
    logs = _load_logs(w).select("event_id", "run_id", "dataset_name", "logged_at")
    return runlog.latest(logs, "logged_at", 20, tie=["event_id"])


@key(
    "s15_catalog_of_layer",
    "SELECT event_id AS entry_id, 'click' AS layer FROM events WHERE event_type = 'click'",
)
def _s15_layer(w):
    entries = w.source("events").select(F.col("event_id").alias("entry_id"), F.col("event_type").alias("layer"))
    return runlog.of_layer(entries, "click")


@key(
    "s16_run_report_flattening",
    f"""SELECT 'run-' || event_id AS invocation_id, event_type AS model_name, 'model' AS schema_name, 'external' AS materialization,
  'success' AS status, user_id AS rows_affected, {r('value / 7', 3)} AS execution_time, props AS message FROM events
UNION ALL SELECT 'run-' || event_id, 'not_null_' || event_type, 'test', 'none', 'pass', 0::BIGINT,
  {r('value / 9', 3)}, '-' FROM events""",
)
def _s16(w):
    def result(unique_id, status, seconds, message, materialization, rows):
        return F.struct(
            unique_id.alias("unique_id"),
            F.lit(status).alias("status"),
            seconds.alias("execution_time"),
            message.alias("message"),
            F.struct(F.lit(materialization).alias("materialization"), rows.alias("rows_affected")).alias("adapter_response"),
        )

    kind, value = F.col("event_type"), F.col("value")
    reports = w.source("events").select(
        F.struct(F.concat(F.lit("run-"), F.col("event_id")).alias("invocation_id")).alias("metadata"),
        F.array(
            result(F.concat(F.lit("model.shop."), kind), "success", value / 7, F.col("props"), "external", F.col("user_id")),
            result(
                F.concat(F.lit("test.shop.not_null_"), kind, F.lit(".0a1b2c")),
                "pass",
                value / 9,
                F.lit("-"),
                "none",
                F.lit(0).cast("bigint"),
            ),
        ).alias("results"),
    )
    path = w.scratch("reports")
    reports.write.json(path)
    return runlog.flatten_run_reports(runlog.read_run_reports(w.spark, path, multi_line=False))


@key(
    "s17_incremental_stream",
    f"SELECT order_region, count(*) AS row_count, {r('sum(sales)')} AS sales FROM wide GROUP BY 1",
)
def _s17(w):
    """The stream lands the files once; a second call finds nothing new."""
    root, checkpoint = w.scratch("stream"), w.scratch("stream-checkpoint")
    for run in ("run-1", "run-2"):
        load_new_files(w.spark, landing(w), ORDERS, root, checkpoint, run, "2024-01-01")
    rows = bronze.read_bronze(w.spark, root)
    return stable(
        rows.groupBy(F.trim(src("Order Region")).alias("order_region")).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum(F.col("Sales").cast("double")).alias("sales")
        )
    )


def _feed_files(w, folder, rows):
    """One feed file per event type, written by Spark and given its name; one that was there is replaced."""
    parts = w.scratch("feed-parts")
    # Some errors lack two fields: lines are written as they are.
    broken = (F.col("event_type") == "error") & (F.col("event_id") % 10 == 3)
    line = F.when(broken, F.col("event_id").cast("string")).otherwise(F.concat_ws(",", "event_id", "user_id", "event_type"))
    lines = rows.select(line.alias("event_id,user_id,event_type"), F.col("event_type").alias("kind")).repartition(8, "kind")
    lines.write.option("header", True).option("sep", "\u0001").partitionBy("kind").csv(parts)
    for kind in files.names(w.spark, parts):
        if "=" in kind:
            (written,) = [n for n in files.names(w.spark, f"{parts}/{kind}") if n.startswith("part-")]
            target = f"{folder}/{kind.split('=')[1]}.csv"
            files.make_folder(w.spark, folder)
            files.delete(w.spark, target)
            files.rename_new(w.spark, f"{parts}/{kind}/{written}", target)


@key(
    "s17_stream_versions",
    """SELECT event_type || '.csv' AS source_file, count(*) AS row_count, sum(event_id)::BIGINT AS ids,
  sum(CASE WHEN event_type = 'click' THEN 2 * user_id ELSE user_id END)::BIGINT AS users,
  CASE WHEN event_type = 'click' THEN 2 ELSE 1 END::BIGINT AS loads, 0::BIGINT AS rejected FROM events WHERE event_type <> 'error' GROUP BY event_type
UNION ALL SELECT 'error.csv', count(*), sum(event_id)::BIGINT, sum(user_id)::BIGINT, 1::BIGINT,
  (SELECT count(*) FROM events WHERE event_type = 'error' AND event_id % 10 = 3) FROM events WHERE event_type = 'error' AND event_id % 10 <> 3""",
)
def _s17_versions(w):
    """A file per event type; the one of errors has malformed lines, the one of clicks comes again with other values."""
    folder, root, checkpoint = w.scratch("versions"), w.scratch("versions-bronze"), w.scratch("versions-checkpoint")
    dataset = Dataset("events", "events", "UTF-8", (), "")
    events = w.source("events").select("event_id", "user_id", "event_type")
    _feed_files(w, folder, events)
    load_new_files(w.spark, folder, dataset, root, checkpoint, "run-1", "2024-01-01")
    clicks = events.filter("event_type = 'click'").withColumn("user_id", 2 * F.col("user_id"))
    _feed_files(w, folder, clicks)
    load_new_files(w.spark, folder, dataset, root, checkpoint, "run-2", "2024-01-01")
    meta = f"{checkpoint}-meta"
    rows = bronze.read_bronze(w.spark, root).groupBy(F.col("_source_file").alias("source_file")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("event_id").cast("bigint")).alias("ids"), F.sum(F.col("user_id").cast("bigint")).alias("users")
    )
    logs = runlog.history(w.spark, meta, "ingestion_logs").filter("status = 'SUCCESS'").groupBy("source_file").agg(F.count(F.lit(1)).alias("loads"))
    rejected = runlog.history(w.spark, meta, "rejected_rows").groupBy("source_file").agg(F.count(F.lit(1)).alias("rejected"))
    joined = rows.join(logs, "source_file").join(rejected, "source_file", "left")
    return joined.withColumn("rejected", F.coalesce("rejected", F.lit(0)))


# --- C ---------------------------------------------------------------------------------------


@key(
    "c01_unique",
    "SELECT order_item_id, count(*) AS occurrences FROM wide GROUP BY 1 HAVING count(*) > 1",
)
def _c01(w):
    ids = w.table("bronze_orders").select(src("Order Item Id").cast("bigint").alias("order_item_id"))
    return quality.duplicate_keys(ids, "order_item_id")


_NULLABLE = {"customer_zipcode": "Customer Zipcode", "customer_last_name": "Customer Lname", "order_id": "Order Id"}


@key(
    "c02_not_null",
    " UNION ALL ".join(
        f"SELECT '{alias}' AS column_name, count(*) AS missing FROM wide WHERE "
        f"{alias if alias == 'order_id' else alias + '_raw'} IS NULL"
        for alias in _NULLABLE
    ),
)
def _c02(w):
    columns = w.table("bronze_orders").select(*[src(name).alias(alias) for alias, name in _NULLABLE.items()])
    return quality.missing_value_counts(columns, list(_NULLABLE))


@key("c02_not_null_rows", "SELECT order_item_id, _ingested_at FROM wide WHERE customer_zipcode_raw IS NULL")
def _c02_rows(w):
    rows = w.table("bronze_orders").select(
        src("Order Item Id").cast("bigint").alias("order_item_id"), src("Customer Zipcode").alias("zipcode"), "_ingested_at"
    )
    return quality.missing_values(rows, "zipcode").drop("zipcode")


@key(
    "c03_relationships",
    "SELECT o_orderkey, count(*) AS row_count FROM orders WHERE o_orderkey NOT IN (SELECT order_id FROM stg_order_items) "
    "GROUP BY 1",
)
def _c03(w):
    return quality.orphan_keys(w.source("orders"), "o_orderkey", w.table("stg_order_items"), "order_id")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]


@key(
    "c04_accepted_values",
    "SELECT customer_segment, count(*) AS row_count FROM dim_customer WHERE customer_segment NOT IN "
    "('AUTOMOBILE', 'BUILDING', 'FURNITURE') GROUP BY 1",
)
def _c04(w):
    return quality.unaccepted_values(w.table("dim_customer"), "customer_segment", _SEGMENTS)


def _suite_sql(rules) -> str:
    parts = []
    for rule in rules:
        table = "(SELECT * EXCLUDE (order_item_id) FROM feat_items)" if rule.table == "feat_delivery_risk" else rule.table
        column = rule.column
        if rule.kind == "not_null":
            failing = f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
        elif rule.kind == "unique":
            failing = (
                f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 "
                "HAVING count(*) > 1)"
            )
        elif rule.kind == "relationships":
            failing = (
                f"SELECT count(*) FROM {table} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {rule.parent} p WHERE p.{rule.parent_column} = c.{column})"
            )
        else:
            accepted = ", ".join(repr(v) for v in ACCEPTED_VALUES[column])
            value = f"CAST({column} AS INTEGER)" if column == "late_delivery_risk" else column
            failing = f"SELECT count(*) FROM {table} WHERE {value} NOT IN ({accepted})"
        parts.append(
            f"SELECT '{rule.name}' AS test_name, '{rule.table}' AS table_name, '{rule.kind}' AS test_kind, "
            f"'{column}' AS column_name, ({failing}) AS failures"
        )
    return f"SELECT *, failures = 0 AS passed FROM ({' UNION ALL '.join(parts)})"


@key("c05_suite_silver", _suite_sql(quality.SILVER_RULES))
def _c05_silver(w):
    return quality.run_suite(w.table, quality.SILVER_RULES)


@key("c05_suite_gold", _suite_sql(quality.GOLD_RULES))
def _c05_gold(w):
    # The segments of the test data are not the accepted ones, so two of these rules fail, as they should.
    return quality.run_suite(w.table, quality.GOLD_RULES)


# --- L ---------------------------------------------------------------------------------------

# A column of each table whose sum stands for its content.
_MEASURES = {
    "stg_customer": "customer_id", "stg_department": "department_id", "stg_order": "days_actual", "stg_order_items": "sales",
    "stg_product": "product_price", "dim_customer": "customer_id", "dim_date": "date_key", "dim_order": "days_diff",
    "dim_product": "product_price", "fact_order_items": "order_profit", "mart_executive_summary": "total_sales",
    "mart_customer_summary": "total_customers", "mart_customer_segment_revenue": "avg_revenue_per_customer",
    "mart_product_category_sales": "total_sales", "mart_product_discount_impact": "avg_sales",
    "mart_product_discount_impact_by_category": "avg_sales", "mart_supply_chain_shipping_mode": "total_orders",
    "mart_supply_chain_region_delay": "avg_delay", "mart_ai_monitoring_summary": "violations",
    "mart_ai_monitoring_risk_by_region": "risk_orders", "mart_ai_monitoring_risk_by_mode_region": "actual_late",
    "mart_trend_monthly": "avg_delay", "feat_customer": "avg_days_late", "feat_delivery_risk": "profit_margin",
}
_DAY = "2024-01-01"


@key(
    "l01_full_refresh",
    " UNION ALL ".join(
        f"SELECT '{n}' AS dataset_name, count(*) AS row_count, {r(f'sum({c})', 2)} AS total FROM {table_sql(n)}"
        for n, c in _MEASURES.items()
    )
    + f""" UNION ALL SELECT 'bronze_orders', count(*), {r('sum(sales)', 2)} FROM wide
UNION ALL SELECT 'bronze_clickstream', count(*), {r('sum(value)', 2)} FROM events
UNION ALL SELECT 'dictionary', count(*), NULL FROM region
UNION ALL SELECT 'failed tests', 0, NULL UNION ALL SELECT 'files of the second run', 0, NULL""",
)
def _l01(w):
    """Three feeds land and are modelled; a second lake object on the same root finds nothing new, queries and tests the tables."""
    segments = {"customer_segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]}
    clicks, dictionary, root = w.scratch("clicks"), w.scratch("dictionary"), w.scratch("refresh")
    w.source("events").write.option("header", True).csv(clicks)
    fields = w.source("region").select(F.col("r_name").alias("FIELDS"), F.lit("a, b").alias("DESCRIPTION"))
    fields.write.option("header", True).csv(dictionary)
    folders = {"orders": landing(w), "clickstream": clicks, "dictionary": dictionary}
    refresh(lake.Lake(w.spark, root), folders, _DAY, segments)

    second = lake.Lake(w.spark, root)
    refresh(second, folders, "2024-01-02", segments)
    logs = runlog.history(w.spark, meta_root(second), "ingestion_logs")
    runs = runlog.current(w.spark, meta_root(second), "pipeline_runs").orderBy(F.desc("started_at")).limit(1)
    anew = logs.join(runs.select("run_id"), "run_id").filter("status <> 'SKIPPED'")
    failed = gate(second, [*quality.SILVER_RULES, *quality.GOLD_RULES], "check", segments).filter("NOT passed")
    entries = runlog.current(w.spark, meta_root(second), "metadata_catalog").filter("dataset_name = 'dictionary'")

    def line(name: str, df, total=F.lit(None).cast("double"), rows=F.count(F.lit(1))):
        return df.agg(rows.alias("row_count"), total.alias("total")).select(F.lit(name).alias("dataset_name"), "row_count", "total")

    lake.register_views(second, list(LAYER_TABLES))
    parts = [line(n, second.table(n), round_to(F.sum(c), 2)) for n, c in _MEASURES.items()]
    for name, column in (("bronze_orders", "Sales"), ("bronze_clickstream", "value")):
        parts.append(line(name, second.table(name), round_to(F.sum(src(column).cast("double")), 2)))
    parts.append(line("dictionary", entries, rows=F.sum("row_count")))
    parts += [line("failed tests", failed), line("files of the second run", anew)]
    return reduce(DataFrame.unionByName, parts)


# One load, one load time: versions of a row are ties there.
ORACLE["l01_full_refresh"] = ORACLE["l01_full_refresh"].replace("l_shipdate AS _ingested_at", f"DATE '{_DAY}' AS _ingested_at")
