"""Gold marts: one pre-aggregated table per dashboard tile.

Facts are summed on the join key before a dimension is joined, wherever the measure allows it: the
shuffle then carries one row per key and map task, and a key that holds a third of all sales weighs
no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import discount_bucket, flag_sum, ratio, round_to


def mart_executive_summary(fact: DataFrame, dim_order: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Region x department. `total_orders` counts an order once per department it touches."""
    # The join clusters rows by order, so the distinct count needs no shuffle of its own for them.
    base = (
        fact.select("order_id", "product_card_id", "sales", "order_profit")
        .join(dim_product.select("product_card_id", "department_name"), "product_card_id", "left")
        .join(dim_order.select("order_id", "order_region"), "order_id", "left")
    )
    return base.groupBy("order_region", "department_name").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("sales").alias("total_sales"),
        F.sum("order_profit").alias("total_profit"),
        round_to(ratio(F.sum("order_profit"), F.sum("sales")) * 100, 2).alias("profit_margin_pct"),
    )


def region_orders_exact(fact: DataFrame, dim_order: DataFrame) -> DataFrame:
    """Orders per region, each counted once; summing the executive mart counts some twice."""
    ids = fact.select("order_id").distinct()
    return (
        ids.join(dim_order.select("order_id", "order_region"), "order_id", "left")
        .groupBy("order_region")
        .agg(F.count("order_id").alias("total_orders"))
    )


def mart_customer_summary(dim_customer: DataFrame) -> DataFrame:
    # customer_id is the key of the dimension, so the distinct count is a plain count.
    return dim_customer.groupBy("customer_segment", "customer_country").agg(
        F.count("customer_id").alias("total_customers")
    )


def mart_customer_segment_revenue(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    per_customer = fact.groupBy("customer_id").agg(
        F.sum("sales").alias("sales"), F.sum("order_profit").alias("order_profit")
    )
    # One row per customer from here on, so counting rows counts distinct customers.
    return (
        per_customer.join(dim_customer.select("customer_id", "customer_segment"), "customer_id", "left")
        .groupBy("customer_segment")
        .agg(
            F.count("customer_id").alias("total_customers"),
            F.sum("sales").alias("total_sales"),
            F.sum("order_profit").alias("total_profit"),
            round_to(ratio(F.sum("sales"), F.count("customer_id")), 2).alias("avg_revenue_per_customer"),
        )
    )


def mart_product_category_sales(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    per_product = fact.groupBy("product_card_id").agg(F.sum("sales").alias("sales"))
    return (
        per_product.join(dim_product.select("product_card_id", "category_name"), "product_card_id", "left")
        .groupBy("category_name")
        .agg(F.sum("sales").alias("total_sales"))
    )


def mart_product_discount_impact(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_item_discount_rate").agg(F.avg("sales").alias("avg_sales"))


def mart_product_discount_impact_by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    per_product = fact.groupBy(
        "product_card_id", discount_bucket("order_item_discount_rate").alias("discount_bucket")
    ).agg(
        F.count(F.lit(1)).alias("items"), F.sum("sales").alias("sales"), F.count("sales").alias("priced_items")
    )
    return (
        per_product.join(dim_product.select("product_card_id", "category_name"), "product_card_id", "left")
        .groupBy("category_name", "discount_bucket")
        .agg(
            F.sum("items").alias("order_item_count"),
            ratio(F.sum("sales"), F.sum("priced_items")).alias("avg_sales"),
        )
    )


def mart_supply_chain_shipping_mode(dim_order: DataFrame) -> DataFrame:
    return dim_order.groupBy("shipping_mode").agg(F.count(F.lit(1)).alias("total_orders"))


def mart_supply_chain_region_delay(dim_order: DataFrame) -> DataFrame:
    return dim_order.groupBy("order_region").agg(F.avg("days_diff").alias("avg_delay"))


def _label_counts() -> list:
    return [
        # "Predicted" is the label of the feed, not the output of a model.
        flag_sum(F.col("late_delivery_risk")).alias("predicted_late"),
        flag_sum(F.col("is_actual_late") == 1).alias("actual_late"),
        flag_sum(F.col("is_label_violation")).alias("violations"),
    ]


def mart_ai_monitoring_summary(dim_order: DataFrame) -> DataFrame:
    return dim_order.agg(*_label_counts())


def mart_ai_monitoring_risk_by_region(dim_order: DataFrame) -> DataFrame:
    return dim_order.groupBy("order_region").agg(flag_sum(F.col("late_delivery_risk")).alias("risk_orders"))


def mart_ai_monitoring_risk_by_mode_region(dim_order: DataFrame) -> DataFrame:
    return dim_order.groupBy("order_region", "shipping_mode").agg(
        F.count(F.lit(1)).alias("total_orders"), *_label_counts()
    )


def mart_trend_monthly(fact: DataFrame, dim_date: DataFrame, dim_order: DataFrame) -> DataFrame:
    """Sales per item, delay per order: an order counts once in the average whatever its items.

    An order has one order date, so rows fold to orders, orders to days, and only the days (a few
    thousand) meet the calendar. Days outside the calendar form the NULL month, whose delay is NULL.
    Grouping by the order alone clusters rows the way the join needs them: one shuffle of the fact.
    """
    per_order = fact.groupBy("order_id").agg(
        F.max("order_date_key").alias("order_date_key"),
        F.sum("sales").alias("sales"),
        F.sum("order_profit").alias("order_profit"),
    )
    per_day = (
        per_order.join(dim_order.select("order_id", "days_diff"), "order_id", "left")
        .groupBy("order_date_key")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("sales").alias("sales"),
            F.sum("order_profit").alias("order_profit"),
            F.sum("days_diff").alias("delay"),
            F.count("days_diff").alias("delayed_orders"),
        )
    )
    calendar = dim_date.select("date_key", "year", "month", "month_name")
    return (
        per_day.join(calendar, F.col("order_date_key") == F.col("date_key"), "left")
        .groupBy("year", "month", "month_name")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("sales").alias("total_sales"),
            F.sum("order_profit").alias("total_profit"),
            F.when(F.col("year").isNotNull(), ratio(F.sum("delay"), F.sum("delayed_orders"))).alias("avg_delay"),
        )
        .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"))
    )
