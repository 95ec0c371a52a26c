"""Datasets, layers and the fixed values the layers rely on."""

from __future__ import annotations

from dataclasses import dataclass

LINEAGE_COLUMNS = (
    "_ingested_at",
    "_source_file",
    "_dataset_name",
    "_ingestion_run_id",
    "_record_status",
)

# Columns of the wide order feed that the layers read. A file may have more; its header tells.
ORDER_FEED_COLUMNS = (
    "Type",
    "Days for shipping (real)",
    "Days for shipment (scheduled)",
    "Benefit per order",
    "Delivery Status",
    "Late_delivery_risk",
    "Category Id",
    "Category Name",
    "Customer City",
    "Customer Country",
    "Customer Fname",
    "Customer Id",
    "Customer Lname",
    "Customer Segment",
    "Customer State",
    "Customer Street",
    "Customer Zipcode",
    "Department Id",
    "Department Name",
    "Latitude",
    "Longitude",
    "Market",
    "Order City",
    "Order Country",
    "Order Customer Id",
    "order date (DateOrders)",
    "Order Id",
    "Order Item Cardprod Id",
    "Order Item Discount",
    "Order Item Discount Rate",
    "Order Item Id",
    "Order Item Product Price",
    "Order Item Profit Ratio",
    "Order Item Quantity",
    "Sales",
    "Order Item Total",
    "Order Profit Per Order",
    "Order Region",
    "Order State",
    "Order Status",
    "Product Card Id",
    "Product Name",
    "Product Price",
    "Product Status",
    "shipping date (DateOrders)",
    "Shipping Mode",
)

CLICKSTREAM_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
DICTIONARY_COLUMNS = ("FIELDS", "DESCRIPTION")


@dataclass(frozen=True)
class Dataset:
    """A landed feed. Its columns come from its files; `columns` are those of an empty landing folder."""

    name: str
    prefix: str
    encoding: str
    columns: tuple[str, ...]
    description: str
    skip_parquet: bool = False


DATASETS = {
    "orders": Dataset("orders", "bronze/orders", "ISO-8859-1", ORDER_FEED_COLUMNS, "Orders, one row per order item"),
    "clickstream": Dataset("clickstream", "bronze/clickstream", "UTF-8", CLICKSTREAM_COLUMNS, "Clickstream events"),
    "dictionary": Dataset(
        "dictionary", "bronze/orders", "UTF-8", DICTIONARY_COLUMNS, "Field dictionary", skip_parquet=True
    ),
}

# Accepted values of the declared tests.
ACCEPTED_VALUES = {
    "payment_type": ["DEBIT", "TRANSFER", "PAYMENT", "CASH"],
    "shipping_mode": ["Standard Class", "Second Class", "First Class", "Same Day"],
    "customer_segment": ["Consumer", "Corporate", "Home Office"],
    "product_status_label": ["Active", "Inactive"],
    "order_quarter": [1, 2, 3, 4],
    "is_weekend": [0, 1],
    "is_urgent_shipping": [0, 1],
    "late_delivery_risk": [0, 1],
    "is_cross_border": [0, 1],
}

# Tables of each layer, in the order they are built.
LAYER_TABLES = {
    "silver": ("stg_customer", "stg_department", "stg_order", "stg_order_items", "stg_product"),
    "dimensions": ("dim_customer", "dim_date", "dim_order", "dim_product"),
    "facts": ("fact_order_items",),
    "marts": (
        "mart_executive_summary",
        "mart_customer_summary",
        "mart_customer_segment_revenue",
        "mart_product_category_sales",
        "mart_product_discount_impact",
        "mart_product_discount_impact_by_category",
        "mart_supply_chain_shipping_mode",
        "mart_supply_chain_region_delay",
        "mart_ai_monitoring_summary",
        "mart_ai_monitoring_risk_by_region",
        "mart_ai_monitoring_risk_by_mode_region",
        "mart_trend_monthly",
    ),
    "features": ("feat_customer", "feat_delivery_risk"),
}
GOLD_LAYERS = ("dimensions", "facts", "marts", "features")

# Inputs of the scoring template, in its order.
TEMPLATE_NUMERIC = (
    "order_item_product_price",
    "order_item_discount_amount",
    "order_item_discount_rate",
    "sales",
    "order_item_total",
    "order_item_profit_ratio",
    "order_profit",
    "order_month",
    "order_quarter",
    "ship_day_of_week",
    "profit_margin",
    "unit_price",
)
TEMPLATE_TEXT = (
    "payment_type",
    "market",
    "order_region",
    "order_country",
    "order_state",
    "order_city",
    "shipping_mode",
    "category_name",
    "department_name",
    "customer_segment",
    "customer_country",
)
# Further numeric inputs of the full feature set.
FULL_NUMERIC = TEMPLATE_NUMERIC + (
    "order_item_quantity",
    "days_scheduled",
    "order_hour",
    "is_weekend",
    "is_night_order",
    "is_cross_border",
    "is_urgent_shipping",
    "is_high_discount",
)
FEATURE_SETS = {"template": (TEMPLATE_NUMERIC, TEMPLATE_TEXT), "full": (FULL_NUMERIC, TEMPLATE_TEXT)}
LABEL = "late_delivery_risk"
