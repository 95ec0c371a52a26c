"""Silver: the wide feed cleaned into five tables, one latest row per key.

Each table scans only the feed columns it needs; in columnar storage the five scans together read
each column about once, so the feed is never cached. Keys are 64-bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import (
    blank_to_unknown,
    feed_time,
    full_name,
    text_to_bigint,
    text_to_flag,
    text_to_int,
    trimmed,
)
from quayside.operators.latest import latest_attributes, latest_rows

VERSION = "_ingested_at"


def _src(name: str) -> Column:
    return F.col(f"`{name}`")


def _double(name: str) -> Column:
    return _src(name).cast("double")


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("_loaded_at", F.current_timestamp())


def clean_customer(feed: DataFrame) -> DataFrame:
    return feed.filter(_src("Customer Id").isNotNull()).select(
        text_to_bigint(_src("Customer Id")).alias("customer_id"),
        trimmed(_src("Customer Fname")).alias("customer_first_name"),
        F.coalesce(trimmed(_src("Customer Lname")), F.lit("")).alias("customer_last_name"),
        full_name(_src("Customer Fname"), _src("Customer Lname")).alias("customer_full_name"),
        trimmed(_src("Customer Segment")).alias("customer_segment"),
        trimmed(_src("Customer City")).alias("customer_city"),
        trimmed(_src("Customer State")).alias("customer_state"),
        trimmed(_src("Customer Country")).alias("customer_country"),
        trimmed(_src("Customer Street")).alias("customer_street"),
        blank_to_unknown(_src("Customer Zipcode")).alias("customer_zipcode"),
        VERSION,
    )


def stg_customer(feed: DataFrame) -> DataFrame:
    return _stamped(latest_rows(clean_customer(feed), ["customer_id"], VERSION))


def clean_department(feed: DataFrame) -> DataFrame:
    return feed.filter(_src("Department Id").isNotNull()).select(
        text_to_bigint(_src("Department Id")).alias("department_id"),
        trimmed(_src("Department Name")).alias("department_name"),
        VERSION,
    )


def stg_department(feed: DataFrame) -> DataFrame:
    return _stamped(latest_attributes(clean_department(feed), ["department_id"], VERSION))


def clean_order(feed: DataFrame, lenient: bool = False) -> DataFrame:
    """`lenient` turns unreadable dates into NULL instead of failing the load."""
    actual = text_to_int(_src("Days for shipping (real)"))
    scheduled = text_to_int(_src("Days for shipment (scheduled)"))
    late = actual > scheduled
    labelled = text_to_flag(_src("Late_delivery_risk"))
    return feed.filter(_src("Order Id").isNotNull()).select(
        text_to_bigint(_src("Order Id")).alias("order_id"),
        text_to_bigint(_src("Order Customer Id")).alias("customer_id"),
        trimmed(_src("Type")).alias("payment_type"),
        trimmed(_src("Order Status")).alias("order_status"),
        trimmed(_src("Market")).alias("market"),
        trimmed(_src("Order Region")).alias("order_region"),
        trimmed(_src("Order Country")).alias("order_country"),
        trimmed(_src("Order State")).alias("order_state"),
        trimmed(_src("Order City")).alias("order_city"),
        _double("Latitude").alias("delivery_latitude"),
        _double("Longitude").alias("delivery_longitude"),
        feed_time(_src("order date (DateOrders)"), lenient).alias("order_date"),
        feed_time(_src("shipping date (DateOrders)"), lenient).alias("shipping_date"),
        trimmed(_src("Shipping Mode")).alias("shipping_mode"),
        trimmed(_src("Delivery Status")).alias("delivery_status"),
        scheduled.alias("days_scheduled"),
        actual.alias("days_actual"),
        (actual - scheduled).alias("days_diff"),
        labelled.alias("late_delivery_risk"),
        F.when(late, 1).otherwise(0).alias("is_actual_late"),
        # One-sided by design: late in fact but labelled as not late; unknown days are no violation.
        F.when(late & ~labelled, True).otherwise(False).alias("is_label_violation"),
        VERSION,
    )


def stg_order(feed: DataFrame, lenient: bool = False) -> DataFrame:
    return _stamped(latest_rows(clean_order(feed, lenient), ["order_id"], VERSION))


def _unreadable() -> Column:
    bad = [
        _src(c).isNotNull() & feed_time(_src(c), lenient=True).isNull()
        for c in ("order date (DateOrders)", "shipping date (DateOrders)")
    ]
    return bad[0] | bad[1]


def unreadable_orders(feed: DataFrame) -> DataFrame:
    """Feed rows whose dates cannot be read."""
    return feed.filter(_unreadable())


def readable_orders(feed: DataFrame) -> DataFrame:
    """The other rows."""
    return feed.filter(~_unreadable())


def clean_order_items(feed: DataFrame) -> DataFrame:
    return feed.filter(_src("Order Item Id").isNotNull()).select(
        text_to_bigint(_src("Order Item Id")).alias("order_item_id"),
        text_to_bigint(_src("Order Id")).alias("order_id"),
        text_to_bigint(_src("Order Item Cardprod Id")).alias("product_card_id"),
        text_to_bigint(_src("Department Id")).alias("department_id"),
        text_to_int(_src("Order Item Quantity")).alias("order_item_quantity"),
        _double("Order Item Product Price").alias("order_item_product_price"),
        _double("Order Item Discount").alias("order_item_discount_amount"),
        _double("Order Item Discount Rate").alias("order_item_discount_rate"),
        _double("Sales").alias("sales"),
        _double("Order Item Total").alias("order_item_total"),
        _double("Order Item Profit Ratio").alias("order_item_profit_ratio"),
        _double("Benefit per order").alias("order_benefit"),
        _double("Order Profit Per Order").alias("order_profit"),
        VERSION,
    )


def stg_order_items(feed: DataFrame) -> DataFrame:
    return _stamped(latest_rows(clean_order_items(feed), ["order_item_id"], VERSION))


def clean_product(feed: DataFrame) -> DataFrame:
    status = text_to_int(_src("Product Status"))
    return feed.filter(_src("Product Card Id").isNotNull()).select(
        text_to_bigint(_src("Product Card Id")).alias("product_card_id"),
        trimmed(_src("Product Name")).alias("product_name"),
        _double("Product Price").alias("product_price"),
        status.alias("product_status"),
        F.when(status == 1, "Active").otherwise("Inactive").alias("product_status_label"),
        text_to_bigint(_src("Category Id")).alias("category_id"),
        trimmed(_src("Category Name")).alias("category_name"),
        text_to_bigint(_src("Department Id")).alias("department_id"),
        VERSION,
    )


def stg_product(feed: DataFrame) -> DataFrame:
    return _stamped(latest_rows(clean_product(feed), ["product_card_id"], VERSION))
