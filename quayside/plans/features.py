"""Feature tables: the customer risk profile and the item-grain training input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import flag, flag_sum, iso_day, ratio, round_to
from quayside.plans.star import ITEM_MEASURES

# Order columns of the training input: known when the order is placed, and the label.
ORDER_FEATURES = (
    "payment_type",
    "market",
    "order_region",
    "order_country",
    "order_state",
    "order_city",
    "shipping_mode",
    "days_scheduled",
    "late_delivery_risk",
)


def feat_customer(fact: DataFrame, dim_order: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """One row per customer: orders, average days late, late rate, any cross-border order.

    Orders are folded to (customer, country) before customers are joined: a customer with a third of
    all orders is then a handful of rows.
    """
    # An order has one customer, so grouping by the order gives the distinct pairs.
    orders = (
        fact.groupBy("order_id")
        .agg(F.max("customer_id").alias("customer_id"))
        .join(
            dim_order.select("order_id", "days_actual", "days_scheduled", "late_delivery_risk", "order_country"),
            "order_id",
            "left",
        )
    )
    late_by = F.col("days_actual") - F.col("days_scheduled")
    per_country = orders.groupBy("customer_id", "order_country").agg(
        F.count("order_id").alias("orders"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(late_by).alias("late_days"),
        F.count(late_by).alias("dated_orders"),
        flag_sum(F.col("late_delivery_risk")).alias("late_orders"),
    )
    return (
        per_country.join(
            dim_customer.select("customer_id", "customer_segment", "customer_country"), "customer_id", "left"
        )
        .groupBy("customer_id", "customer_segment", "customer_country")
        .agg(
            F.sum("orders").alias("total_orders"),
            round_to(ratio(F.sum("late_days"), F.sum("dated_orders")), 3).alias("avg_days_late"),
            round_to(ratio(F.sum("late_orders"), F.sum("rows")), 3).alias("late_delivery_rate"),
            F.max(flag(F.col("customer_country") != F.col("order_country"))).alias("is_cross_border"),
        )
    )


def feat_delivery_risk(
    fact: DataFrame,
    dim_order: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    keep: Sequence[str] = (),
) -> DataFrame:
    """32 columns per item; items without an order drop out. `keep` adds key columns in front."""
    hour = F.hour("order_date")
    joined = (
        fact.join(dim_order.select("order_id", *ORDER_FEATURES, "order_date", "shipping_date"), "order_id")
        .join(dim_product.select("product_card_id", "category_name", "department_name"), "product_card_id", "left")
        .join(dim_customer.select("customer_id", "customer_segment", "customer_country"), "customer_id", "left")
    )
    return joined.select(
        *keep,
        *ITEM_MEASURES,
        *ORDER_FEATURES,
        "category_name",
        "department_name",
        "customer_segment",
        "customer_country",
        iso_day("order_date").isin(6, 7).cast("int").alias("is_weekend"),
        F.month("order_date").cast("bigint").alias("order_month"),
        F.quarter("order_date").cast("bigint").alias("order_quarter"),
        iso_day("shipping_date").cast("bigint").alias("ship_day_of_week"),
        hour.cast("bigint").alias("order_hour"),
        ((hour >= 18) | (hour < 6)).cast("int").alias("is_night_order"),
        # NULL when either country is unknown, unlike the customer profile.
        (F.col("customer_country") != F.col("order_country")).cast("int").alias("is_cross_border"),
        ratio(F.col("order_profit"), F.col("sales")).alias("profit_margin"),
        ratio(F.col("sales"), F.col("order_item_quantity")).alias("unit_price"),
        (F.col("days_scheduled") <= 2).cast("int").alias("is_urgent_shipping"),
        (F.col("order_item_discount_rate") > 0.15).cast("int").alias("is_high_discount"),
    )
