"""Gold star schema: four dimensions and the order-item fact.

No join here is forced to broadcast: dimensions grow with the business. Spark broadcasts a side whose
measured size is under its threshold and otherwise shuffles both, splitting hot keys at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import date_key, sunday_based_day

ORDER_ATTRIBUTES = (
    "order_id",
    "payment_type",
    "order_status",
    "market",
    "order_region",
    "order_country",
    "order_state",
    "order_city",
    "delivery_latitude",
    "delivery_longitude",
    "order_date",
    "shipping_date",
    "shipping_mode",
    "delivery_status",
    "days_scheduled",
    "days_actual",
    "days_diff",
    "late_delivery_risk",
    "is_actual_late",
    "is_label_violation",
)
ITEM_MEASURES = (
    "order_item_quantity",
    "order_item_product_price",
    "order_item_discount_amount",
    "order_item_discount_rate",
    "sales",
    "order_item_total",
    "order_item_profit_ratio",
    "order_profit",
)


def dim_customer(stg_customer: DataFrame) -> DataFrame:
    return stg_customer.drop("_loaded_at")


def date_spine(stg_order: DataFrame) -> DataFrame:
    """Every day from the first order to the last shipment, both included."""
    bounds = stg_order.agg(
        F.min("order_date").cast("date").alias("first_day"), F.max("shipping_date").cast("date").alias("last_day")
    )
    return bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("date_day")
    )


def calendar_columns(days: DataFrame) -> DataFrame:
    d = F.col("date_day")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        sunday_based_day(d).cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).cast("bigint").alias("week_of_year"),
    )


def dim_date(stg_order: DataFrame) -> DataFrame:
    return calendar_columns(date_spine(stg_order))


def dim_order(stg_order: DataFrame) -> DataFrame:
    return stg_order.select(*ORDER_ATTRIBUTES)


def dim_product(stg_product: DataFrame, stg_department: DataFrame) -> DataFrame:
    return stg_product.drop("_loaded_at").join(
        stg_department.select("department_id", "department_name"), "department_id", "left"
    ).select(
        "product_card_id",
        "product_name",
        "product_price",
        "product_status",
        "product_status_label",
        "category_id",
        "category_name",
        "department_id",
        "department_name",
    )


def fact_order_items(stg_order_items: DataFrame, stg_order: DataFrame) -> DataFrame:
    """Items without an order stay, with NULL customer and dates."""
    headers = stg_order.select(
        "order_id",
        "customer_id",
        date_key("order_date").alias("order_date_key"),
        date_key("shipping_date").alias("shipping_date_key"),
    )
    return stg_order_items.join(headers, "order_id", "left").select(
        "order_item_id",
        "order_id",
        "product_card_id",
        "customer_id",
        "order_date_key",
        "shipping_date_key",
        *ITEM_MEASURES,
    )
