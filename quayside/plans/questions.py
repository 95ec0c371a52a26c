"""Dashboard tiles and business questions over the marts and the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import flag_sum, period_label, ratio, round_to


def _in_regions(df: DataFrame, regions: Sequence[str] | None) -> DataFrame:
    return df if regions is None else df.filter(F.col("order_region").isin(list(regions)))


def top(df: DataFrame, k: int, measure: str, *tie: str) -> DataFrame:
    """Largest `measure` first, NULL last; `tie` makes the cut unique."""
    return df.orderBy(F.desc_nulls_last(measure), *[F.asc_nulls_last(c) for c in tie]).limit(k)


def _ordered(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order)


def region_list(executive: DataFrame) -> DataFrame:
    return _ordered(executive.select("order_region").distinct(), F.asc_nulls_last("order_region"))


def kpi_totals(executive: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    sales, profit = total("total_sales"), total("total_profit")
    return _in_regions(executive, regions).agg(
        sales.alias("total_sales"),
        profit.alias("total_profit"),
        total("total_orders").alias("total_orders"),
        F.coalesce(ratio(profit, sales) * 100, F.lit(0.0)).alias("profit_margin_pct"),
    )


def sales_by_department(executive: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    sums = _in_regions(executive, regions).groupBy("department_name").agg(F.sum("total_sales").alias("total_sales"))
    return _ordered(sums, F.desc_nulls_last("total_sales"))


def customers_by_segment(customer_summary: DataFrame) -> DataFrame:
    return customer_summary.groupBy("customer_segment").agg(F.sum("total_customers").alias("total_customers"))


def orders_by_region(executive: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """Sums the mart, so an order counts once per department it touches."""
    sums = _in_regions(executive, regions).groupBy("order_region").agg(F.sum("total_orders").alias("total_orders"))
    return _ordered(sums, F.desc_nulls_last("total_orders"))


def top_countries(customer_summary: DataFrame, k: int = 10) -> DataFrame:
    sums = customer_summary.groupBy("customer_country").agg(F.sum("total_customers").alias("total_customers"))
    return top(sums, k, "total_customers", "customer_country")


def top_categories(category_sales: DataFrame, k: int = 15) -> DataFrame:
    return top(category_sales.select("category_name", "total_sales"), k, "total_sales", "category_name")


def shipping_mode_split(shipping_mode: DataFrame) -> DataFrame:
    return _ordered(shipping_mode, F.desc_nulls_last("total_orders"))


def discount_curve(discount_impact: DataFrame) -> DataFrame:
    return _ordered(discount_impact, F.asc_nulls_last("order_item_discount_rate"))


def delay_by_region(region_delay: DataFrame) -> DataFrame:
    return _ordered(region_delay, F.desc_nulls_last("avg_delay"))


def monitoring_totals(monitoring: DataFrame) -> DataFrame:
    return monitoring.select(*[F.coalesce(c, F.lit(0)).alias(c) for c in monitoring.columns])


def high_risk_regions(risk_by_region: DataFrame) -> DataFrame:
    return _ordered(risk_by_region, F.desc_nulls_last("risk_orders"))


def margin_by_department(executive: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    sums = (
        _in_regions(executive, regions)
        .groupBy("department_name")
        .agg(
            F.sum("total_sales").alias("total_sales"),
            F.sum("total_profit").alias("total_profit"),
            round_to(ratio(F.sum("total_profit"), F.sum("total_sales")) * 100, 2).alias("profit_margin_pct"),
        )
    )
    return _ordered(sums, F.asc_nulls_last("profit_margin_pct"))


def discount_sensitivity(by_category: DataFrame, category_sales: DataFrame, k: int = 8) -> DataFrame:
    """Average sale per discount bucket for the k best-selling categories."""
    best = top(category_sales, k, "total_sales", "category_name").select("category_name")
    kept = by_category.join(best, "category_name", "left_semi")
    return _ordered(kept.select("category_name", "discount_bucket", "avg_sales"), F.asc_nulls_last("discount_bucket"))


def segment_revenue(segment: DataFrame) -> DataFrame:
    return _ordered(segment, F.desc_nulls_last("total_sales"))


def monthly_trend(trend: DataFrame) -> DataFrame:
    labelled = trend.select(
        "year",
        "month",
        "month_name",
        "total_sales",
        "total_profit",
        "avg_delay",
        period_label("month_name", "year").alias("period"),
    )
    return _ordered(labelled, F.asc_nulls_last("year"), F.asc_nulls_last("month"))


def violations_by_mode_region(by_mode_region: DataFrame) -> DataFrame:
    return by_mode_region.select("order_region", "shipping_mode", "violations")


def top_products(fact: DataFrame, dim_product: DataFrame, k: int = 5) -> DataFrame:
    """Sums per product and takes the top k before the product names are looked up."""
    per_product = fact.groupBy("product_card_id").agg(F.sum("sales").alias("revenue"))
    best = top(per_product, k, "revenue", "product_card_id")
    named = best.join(dim_product.select("product_card_id", "product_name"), "product_card_id", "left")
    return _ordered(named, F.desc_nulls_last("revenue"), F.asc_nulls_last("product_card_id"))


def revenue_by_market(fact: DataFrame, dim_order: DataFrame) -> DataFrame:
    # Summing per order first uses the shuffle the join needs anyway.
    per_order = fact.groupBy("order_id").agg(F.sum("sales").alias("sales"))
    markets = per_order.join(dim_order.select("order_id", "market"), "order_id", "left")
    sums = markets.groupBy("market").agg(F.sum("sales").alias("revenue"))
    return _ordered(sums, F.desc_nulls_last("revenue"))


def late_rate_by_shipping_mode(dim_order: DataFrame) -> DataFrame:
    return _late_rate(dim_order, "shipping_mode")


def _late_rate(dim_order: DataFrame, key: str) -> DataFrame:
    late = F.col("is_actual_late") == 1
    return dim_order.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_orders"),
        flag_sum(late).alias("late_orders"),
        round_to(ratio(flag_sum(late).cast("double"), F.count(F.lit(1))), 4).alias("late_rate"),
    )


def top_customers(fact: DataFrame, dim_customer: DataFrame, k: int = 10) -> DataFrame:
    per_customer = fact.groupBy("customer_id").agg(
        F.sum("sales").alias("revenue"), F.count(F.lit(1)).alias("items")
    )
    best = top(per_customer.filter("customer_id IS NOT NULL"), k, "revenue", "customer_id")
    named = best.join(dim_customer.select("customer_id", "customer_full_name"), "customer_id", "left")
    return _ordered(named, F.desc_nulls_last("revenue"), F.asc_nulls_last("customer_id"))


def revenue_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = fact.groupBy("order_date_key").agg(F.sum("sales").alias("sales"), F.sum("order_profit").alias("profit"))
    months = per_day.join(dim_date, F.col("order_date_key") == F.col("date_key"), "left").groupBy("year", "month")
    sums = months.agg(F.sum("sales").alias("revenue"), F.sum("profit").alias("profit"))
    return _ordered(sums, F.asc_nulls_last("year"), F.asc_nulls_last("month"))


def most_profitable_segment(fact: DataFrame, dim_customer: DataFrame, k: int = 1) -> DataFrame:
    per_customer = fact.groupBy("customer_id").agg(F.sum("order_profit").alias("profit"))
    sums = (
        per_customer.join(dim_customer.select("customer_id", "customer_segment"), "customer_id", "left")
        .groupBy("customer_segment")
        .agg(F.sum("profit").alias("profit"))
    )
    return top(sums, k, "profit", "customer_segment")


def latest_region(dim_order: DataFrame, k: int = 1) -> DataFrame:
    """Region with the highest share of orders that were late in fact."""
    return top(_late_rate(dim_order, "order_region"), k, "late_rate", "order_region")


def best_selling_category(fact: DataFrame, dim_product: DataFrame, k: int = 1) -> DataFrame:
    per_product = fact.groupBy("product_card_id").agg(F.sum("order_item_quantity").alias("quantity"))
    sums = (
        per_product.join(dim_product.select("product_card_id", "category_name"), "product_card_id", "left")
        .groupBy("category_name")
        .agg(F.sum("quantity").alias("quantity"))
    )
    return top(sums, k, "quantity", "category_name")
