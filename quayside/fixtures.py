"""The TPC-H-like test tables, reshaped into the wide order feed the bronze layer lands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import ORDER_FEED_COLUMNS


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FEED_SQL = """
SELECT
  CASE o_orderkey % 4 WHEN 0 THEN 'DEBIT' WHEN 1 THEN 'TRANSFER' WHEN 2 THEN 'PAYMENT' ELSE 'CASH' END AS `Type`,
  days_actual AS `Days for shipping (real)`,
  days_scheduled AS `Days for shipment (scheduled)`,
  l_extendedprice * profit_ratio AS `Benefit per order`,
  CASE WHEN l_linestatus = 'F' THEN 'Shipping on time' ELSE ' Late delivery ' END AS `Delivery Status`,
  CASE WHEN days_actual > days_scheduled AND o_orderkey % 11 <> 0 THEN 1 ELSE 0 END AS `Late_delivery_risk`,
  CAST(substring(p_brand, 7) AS INT) AS `Category Id`,
  p_brand AS `Category Name`,
  concat('City ', c_custkey % 50) AS `Customer City`,
  c_nation AS `Customer Country`,
  'Customer' AS `Customer Fname`,
  c_custkey AS `Customer Id`,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE concat('  ', c_name, ' ') END AS `Customer Lname`,
  c_mktsegment AS `Customer Segment`,
  concat('State ', c_nationkey) AS `Customer State`,
  concat(l_suppkey, ' Main Street') AS `Customer Street`,
  CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 13 = 1 THEN '  '
       ELSE CAST(c_custkey AS STRING) END AS `Customer Zipcode`,
  department_id AS `Department Id`,
  p_type AS `Department Name`,
  o_orderkey % 180 - 89.5D AS `Latitude`,
  o_orderkey % 360 - 179.75D AS `Longitude`,
  market AS `Market`,
  CASE o_orderkey % 3 WHEN 0 THEN 'São Paulo' WHEN 1 THEN 'Besançon' ELSE 'Tegucigalpa' END AS `Order City`,
  o_nation AS `Order Country`,
  o_custkey AS `Order Customer Id`,
  date_format(order_date, 'MM/dd/yyyy HH:mm') AS `order date (DateOrders)`,
  o_orderkey AS `Order Id`,
  l_partkey AS `Order Item Cardprod Id`,
  l_extendedprice * rate AS `Order Item Discount`,
  rate AS `Order Item Discount Rate`,
  l_orderkey * 10 + l_linenumber AS `Order Item Id`,
  l_extendedprice / l_quantity AS `Order Item Product Price`,
  profit_ratio AS `Order Item Profit Ratio`,
  l_quantity AS `Order Item Quantity`,
  l_extendedprice AS `Sales`,
  l_extendedprice - l_extendedprice * rate AS `Order Item Total`,
  l_extendedprice * profit_ratio AS `Order Profit Per Order`,
  concat(market, ' ', o_orderkey % 3, ' ') AS `Order Region`,
  concat('State ', o_orderkey % 10) AS `Order State`,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' WHEN 'O' THEN 'PENDING' ELSE 'PROCESSING' END AS `Order Status`,
  l_partkey AS `Product Card Id`,
  p_name AS `Product Name`,
  p_retailprice AS `Product Price`,
  (p_size + l_suppkey) % 2 AS `Product Status`,
  date_format(order_date + make_dt_interval(days_actual, 0, 0, 0), 'MM/dd/yyyy HH:mm')
    AS `shipping date (DateOrders)`,
  shipping_mode AS `Shipping Mode`,
  l_shipdate AS _ingested_at
FROM {lines}
"""


def typed_feed(spark: SparkSession, sf_dir: str, by_year: bool = False) -> DataFrame:
    """One row per line item version: the feed's columns with their natural types, plus `_ingested_at`.

    `by_year` has each task give its rows year by year. They are sorted while they are numbers, before they become texts.
    """
    t = {n: source_table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "part", "nation", "region")}
    mode = F.substring("o_orderpriority", 1, 1)
    departments = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    # Lines, by far the most rows, are joined while they are narrow: with the parts, then with orders that have their customers. Names of
    # nations come last, to all tasks.
    customers = t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", mode.alias("o_mode"))
    nations = t["nation"].select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("c_nation"))
    destinations = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("destination"),
        F.col("n_name").alias("o_nation"),
        F.col("r_name").alias("market"),
    )
    mode = F.col("o_mode")
    lines = (
        t["lineitem"]
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(orders.join(customers, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(nations, "c_nationkey")
        .join(destinations, F.col("o_orderkey") % 25 == F.col("destination"))
        .withColumns(
            {
                "rate": F.col("l_discount") * 4,
                "profit_ratio": F.col("l_tax") * 5 - F.lit(0.2),
                "days_actual": ((F.col("o_orderkey") * 7 + F.col("o_custkey")) % 7).cast("int"),
                "days_scheduled": F.when(mode == "1", 0).when(mode == "2", 1).when(mode == "3", 2).otherwise(4),
                "shipping_mode": F.when(mode == "1", "Same Day")
                .when(mode == "2", "First Class")
                .when(mode == "3", "Second Class")
                .otherwise("Standard Class"),
                "order_date": F.col("o_orderdate")
                + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int")),
                "department_id": F.array_position(F.array(*[F.lit(d) for d in departments]), F.col("p_type")),
            }
        )
    )
    if by_year:
        lines = lines.sortWithinPartitions(F.year("l_shipdate"))
    return spark.sql(_FEED_SQL, lines=lines)


def order_feed(spark: SparkSession, sf_dir: str, by_year: bool = False) -> DataFrame:
    """The feed as it comes out of text files: every source column a string, plus `_ingested_at`."""
    typed = typed_feed(spark, sf_dir, by_year)
    return typed.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in ORDER_FEED_COLUMNS], "_ingested_at")


def landed_order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze orders: all-string feed, lineage columns, and one yearly load date per version.

    A task writes one day's file after the other: rows in mixed order go from one file's column buffers to another's, 51 of them each,
    which was measured to cost more than sorting them.
    """
    return order_feed(spark, sf_dir, by_year=True).withColumns(
        {
            "_source_file": F.lit("orders.csv"),
            "_dataset_name": F.lit("orders"),
            "_ingestion_run_id": F.concat(F.lit("load-"), F.year("_ingested_at").cast("string")),
            "_record_status": F.lit("ACTIVE"),
            "ingested_date": F.make_date(F.year("_ingested_at"), F.lit(12), F.lit(31)),
        }
    )


def landed_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` stand in for the click log."""
    events = source_table(spark, sf_dir, "events")
    return events.withColumns(
        {
            "_ingested_at": F.col("ts"),
            "_source_file": F.lit("clicks.csv"),
            "_dataset_name": F.lit("clickstream"),
            "_ingestion_run_id": F.lit("load-1"),
            "_record_status": F.lit("ACTIVE"),
            "ingested_date": F.to_date("ts"),
        }
    )
