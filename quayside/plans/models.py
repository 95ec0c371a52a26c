"""Name -> table definition. Each takes a lookup that returns upstream tables by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from quayside.plans import features, marts, silver, star

Lookup = Callable[[str], DataFrame]

MODELS: dict[str, Callable[[Lookup], DataFrame]] = {
    "stg_customer": lambda t: silver.stg_customer(t("bronze_orders")),
    "stg_department": lambda t: silver.stg_department(t("bronze_orders")),
    "stg_order": lambda t: silver.stg_order(t("bronze_orders")),
    "stg_order_items": lambda t: silver.stg_order_items(t("bronze_orders")),
    "stg_product": lambda t: silver.stg_product(t("bronze_orders")),
    "dim_customer": lambda t: star.dim_customer(t("stg_customer")),
    "dim_date": lambda t: star.dim_date(t("stg_order")),
    "dim_order": lambda t: star.dim_order(t("stg_order")),
    "dim_product": lambda t: star.dim_product(t("stg_product"), t("stg_department")),
    "fact_order_items": lambda t: star.fact_order_items(t("stg_order_items"), t("stg_order")),
    "mart_executive_summary": lambda t: marts.mart_executive_summary(
        t("fact_order_items"), t("dim_order"), t("dim_product")
    ),
    "mart_customer_summary": lambda t: marts.mart_customer_summary(t("dim_customer")),
    "mart_customer_segment_revenue": lambda t: marts.mart_customer_segment_revenue(
        t("fact_order_items"), t("dim_customer")
    ),
    "mart_product_category_sales": lambda t: marts.mart_product_category_sales(
        t("fact_order_items"), t("dim_product")
    ),
    "mart_product_discount_impact": lambda t: marts.mart_product_discount_impact(t("fact_order_items")),
    "mart_product_discount_impact_by_category": lambda t: marts.mart_product_discount_impact_by_category(
        t("fact_order_items"), t("dim_product")
    ),
    "mart_supply_chain_shipping_mode": lambda t: marts.mart_supply_chain_shipping_mode(t("dim_order")),
    "mart_supply_chain_region_delay": lambda t: marts.mart_supply_chain_region_delay(t("dim_order")),
    "mart_ai_monitoring_summary": lambda t: marts.mart_ai_monitoring_summary(t("dim_order")),
    "mart_ai_monitoring_risk_by_region": lambda t: marts.mart_ai_monitoring_risk_by_region(t("dim_order")),
    "mart_ai_monitoring_risk_by_mode_region": lambda t: marts.mart_ai_monitoring_risk_by_mode_region(
        t("dim_order")
    ),
    "mart_trend_monthly": lambda t: marts.mart_trend_monthly(t("fact_order_items"), t("dim_date"), t("dim_order")),
    "feat_customer": lambda t: features.feat_customer(t("fact_order_items"), t("dim_order"), t("dim_customer")),
    "feat_delivery_risk": lambda t: features.feat_delivery_risk(
        t("fact_order_items"), t("dim_order"), t("dim_product"), t("dim_customer")
    ),
}
