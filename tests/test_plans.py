"""The physical plans: what is shuffled, pushed down and pruned, and what must not appear."""

import re

import pytest
from pyspark.sql import functions as F

from contract.registry import QUERIES
from quayside.plans import marts, silver
from tests.conftest import SF_DIR


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", [n for n in QUERIES if n[0] in "tqjapfw"]
)
def test_no_python_and_no_products(spark, lake, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for banned in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "PythonUDF", "CartesianProduct", "NestedLoopJoin"):
        assert banned not in plan


def scans(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_marts_read_only_their_columns(lake):
    plan = plan_of(marts.mart_product_category_sales(lake.table("fact_order_items"), lake.table("dim_product")))
    read = sorted(re.findall(r"(\w+):", " ".join(scans(plan))))
    assert read == ["category_name", "product_card_id", "product_card_id", "sales"]


def test_region_filter_reaches_the_scan(lake):
    plan = plan_of(lake.table("mart_executive_summary").filter(F.col("order_region").isin("ASIA 0", "ASIA 1")))
    assert "In(order_region, [ASIA 0,ASIA 1])" in plan


def test_load_date_filter_prunes_partitions(lake):
    plan = plan_of(lake.table("bronze_orders").filter(F.col("ingested_date") == F.lit("1998-12-31").cast("date")))
    assert re.search(r"PartitionFilters: \[[^]]*ingested_date", plan)
    assert "PushedFilters: []" in plan


def shuffled(spark, df) -> str:
    """Plan with broadcast joins off, as it is when dimensions are too large for them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan_of(df.select("*"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_trend_shuffles_the_fact_once(spark, lake):
    trend = marts.mart_trend_monthly(lake.table("fact_order_items"), lake.table("dim_date"), lake.table("dim_order"))
    plan = shuffled(spark, trend)
    by_order = re.findall(r"Exchange hashpartitioning\(order_id#\d+L", plan)
    # Once for the fact, after partial sums, and once for the orders it is joined with.
    assert len(by_order) == 2 and "partial_sum(sales" in plan


def test_segment_revenue_joins_folded_customers(spark, lake):
    plan = shuffled(spark, marts.mart_customer_segment_revenue(lake.table("fact_order_items"), lake.table("dim_customer")))
    # Read from the top: the join, under it one shuffle by customer, under that the partial sums.
    join = plan.index("SortMergeJoin")
    exchange = plan.index("Exchange hashpartitioning(customer_id", join)
    assert plan.index("partial_sum(sales", exchange) < plan.index("FileScan", exchange)


def test_hot_order_is_split_by_the_join(spark, lake):
    """A third of all items in one order: the sort-merge join splits that partition at run time."""
    fact = lake.table("fact_order_items")
    hot = fact.unionByName(fact).withColumn(
        "order_id", F.when(F.col("order_item_id") % 3 == 0, F.lit(5)).otherwise(F.col("order_id"))
    )
    # Sizes at which the small test table counts as skewed.
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "5000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        spread = hot.repartition(8)
        result = marts.mart_executive_summary(spread, lake.table("dim_order"), lake.table("dim_product"))
        rows = result.collect()
        assert "skew=true" in plan_of(result)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    total = hot.agg(F.sum("sales")).first()[0]
    assert sum(r["total_sales"] for r in rows) == pytest.approx(total)


def test_silver_scans_only_the_needed_feed_columns(lake):
    plan = plan_of(silver.stg_department(lake.table("bronze_orders")))
    assert scans(plan) == ["Department Id:string,Department Name:string,_ingested_at:timestamp_ntz"]
    assert re.search(r"PushedFilters: \[IsNotNull\(`?Department Id`?\)", plan)


def test_hot_product_is_summed_before_the_shuffle(spark, lake):
    """A third of all sales on one product: the result is right and no task sees the hot rows twice."""
    fact = lake.table("fact_order_items")
    hot = fact.withColumn(
        "product_card_id", F.when(F.col("order_item_id") % 3 == 0, F.lit(7)).otherwise(F.col("product_card_id"))
    )
    got = marts.mart_product_category_sales(hot, lake.table("dim_product"))
    expected = (
        hot.join(lake.table("dim_product"), "product_card_id", "left").groupBy("category_name").agg(F.sum("sales"))
    )
    assert {r[0]: round(r[1], 4) for r in got.collect()} == {r[0]: round(r[1], 4) for r in expected.collect()}
