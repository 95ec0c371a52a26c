"""T: the tables themselves. Q: dashboard tiles and business questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.oracle import BUCKET, big, r
from contract.registry import key
from quayside.functions import stable
from quayside.plans import features, marts, questions, silver, star
from quayside.plans.models import MODELS

_SQL = {
    "stg_customer": "SELECT * FROM stg_customer",
    "stg_department": "SELECT * FROM stg_department",
    "stg_order": "SELECT * FROM stg_order",
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_date": "SELECT * FROM dim_date",
    "dim_order": "SELECT * FROM dim_order",
    "dim_product": "SELECT * FROM dim_product",
    "stg_product": "SELECT * FROM stg_product",
    "mart_customer_summary": "SELECT * FROM mart_customer_summary",
    "mart_supply_chain_shipping_mode": "SELECT * FROM mart_supply_chain_shipping_mode",
    "mart_ai_monitoring_summary": "SELECT * FROM mart_ai_monitoring_summary",
    "mart_ai_monitoring_risk_by_region": "SELECT * FROM mart_ai_monitoring_risk_by_region",
    "mart_ai_monitoring_risk_by_mode_region": "SELECT * FROM mart_ai_monitoring_risk_by_mode_region",
    "feat_customer": "SELECT * FROM feat_customer",
}


def _rounded(table: str, *columns: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{r(c)} AS {c}' for c in columns)}) FROM {table}"


_ITEM_DOUBLES = (
    "order_item_product_price",
    "order_item_discount_amount",
    "order_item_discount_rate",
    "sales",
    "order_item_total",
    "order_item_profit_ratio",
    "order_profit",
)
_SQL |= {
    "stg_order_items": _rounded("stg_order_items", *_ITEM_DOUBLES, "order_benefit"),
    "fact_order_items": _rounded("fact_order_items", *_ITEM_DOUBLES),
    "mart_executive_summary": _rounded("mart_executive_summary", "total_sales", "total_profit"),
    "mart_customer_segment_revenue": _rounded("mart_customer_segment_revenue", "total_sales", "total_profit"),
    "mart_product_category_sales": _rounded("mart_product_category_sales", "total_sales"),
    "mart_product_discount_impact": _rounded("mart_product_discount_impact", "order_item_discount_rate", "avg_sales"),
    "mart_product_discount_impact_by_category": _rounded("mart_product_discount_impact_by_category", "avg_sales"),
    "mart_supply_chain_region_delay": _rounded("mart_supply_chain_region_delay", "avg_delay"),
    "mart_trend_monthly": _rounded("mart_trend_monthly", "total_sales", "total_profit", "avg_delay"),
    "feat_delivery_risk": f"SELECT * EXCLUDE (order_item_id) REPLACE ("
    f"{', '.join(f'{r(c)} AS {c}' for c in (*_ITEM_DOUBLES, 'profit_margin', 'unit_price'))}) FROM feat_items",
}

_NUMBERS = {
    "stg_customer": 3,
    "stg_department": 4,
    "stg_order": 5,
    "stg_order_items": 6,
    "stg_product": 7,
    "dim_customer": 8,
    "dim_date": 9,
    "dim_order": 10,
    "dim_product": 11,
    "fact_order_items": 12,
    "mart_executive_summary": 13,
    "mart_customer_summary": 14,
    "mart_customer_segment_revenue": 15,
    "mart_product_category_sales": 16,
    "mart_product_discount_impact": 17,
    "mart_product_discount_impact_by_category": 18,
    "mart_supply_chain_shipping_mode": 19,
    "mart_supply_chain_region_delay": 20,
    "mart_ai_monitoring_summary": 21,
    "mart_ai_monitoring_risk_by_region": 22,
    "mart_ai_monitoring_risk_by_mode_region": 23,
    "mart_trend_monthly": 24,
    "feat_customer": 25,
    "feat_delivery_risk": 26,
}


def _register(name: str) -> None:
    # Computed from the stored tables one layer below; the load time is not comparable.
    @key(f"t{_NUMBERS[name]:02d}_{name}", _SQL[name])
    def _(w):
        return stable(MODELS[name](w.table).drop("_loaded_at"))


# Feed column, its type here, and the same value in SQL.
_FEED = (
    ("Type", "string", "payment_type"),
    ("Days for shipping (real)", "int", "days_actual"),
    ("Days for shipment (scheduled)", "int", "days_scheduled"),
    ("Benefit per order", "double", "order_benefit"),
    ("Delivery Status", "string", "CASE WHEN delivery_status = 'Late delivery' THEN ' Late delivery ' ELSE delivery_status END"),
    ("Late_delivery_risk", "int", "CAST(late_delivery_risk AS INTEGER)"),
    ("Category Id", "bigint", "category_id"),
    ("Category Name", "string", "category_name"),
    ("Customer City", "string", "customer_city"),
    ("Customer Country", "string", "customer_country"),
    ("Customer Fname", "string", "customer_first_name"),
    ("Customer Id", "bigint", "customer_id"),
    ("Customer Lname", "string", "customer_last_name_raw"),
    ("Customer Segment", "string", "customer_segment"),
    ("Customer State", "string", "customer_state"),
    ("Customer Street", "string", "customer_street"),
    ("Customer Zipcode", "string", "customer_zipcode_raw"),
    ("Department Id", "bigint", "department_id"),
    ("Department Name", "string", "department_name"),
    ("Latitude", "double", "delivery_latitude"),
    ("Longitude", "double", "delivery_longitude"),
    ("Market", "string", "market"),
    ("Order City", "string", "order_city"),
    ("Order Country", "string", "order_country"),
    ("Order Customer Id", "bigint", "customer_id"),
    ("order date (DateOrders)", "string", "strftime(order_date, '%m/%d/%Y %H:%M')"),
    ("Order Id", "bigint", "order_id"),
    ("Order Item Cardprod Id", "bigint", "product_card_id"),
    ("Order Item Discount", "double", "order_item_discount_amount"),
    ("Order Item Discount Rate", "double", "order_item_discount_rate"),
    ("Order Item Id", "bigint", "order_item_id"),
    ("Order Item Product Price", "double", "order_item_product_price"),
    ("Order Item Profit Ratio", "double", "order_item_profit_ratio"),
    ("Order Item Quantity", "int", "order_item_quantity"),
    ("Sales", "double", "sales"),
    ("Order Item Total", "double", "order_item_total"),
    ("Order Profit Per Order", "double", "order_profit"),
    ("Order Region", "string", "order_region_raw"),
    ("Order State", "string", "order_state"),
    ("Order Status", "string", "order_status"),
    ("Product Card Id", "bigint", "product_card_id"),
    ("Product Name", "string", "product_name"),
    ("Product Price", "double", "product_price"),
    ("Product Status", "int", "product_status"),
    ("shipping date (DateOrders)", "string", "strftime(shipping_date, '%m/%d/%Y %H:%M')"),
    ("Shipping Mode", "string", "shipping_mode"),
)


def _feed_name(place: int) -> str:
    return f"c{place:02d}"


def feed_sql() -> str:
    return ", ".join(f"{r(x) if kind == 'double' else x} AS {_feed_name(i)}" for i, (_, kind, x) in enumerate(_FEED))


def feed_columns() -> list:
    # Whole numbers come out of the fixture as decimals where the test table has them so.
    def typed(name: str, kind: str):
        column = F.col(f"`{name}`")
        return column.cast("double").cast(kind) if kind == "int" else column.cast(kind)

    return [typed(name, kind).alias(_feed_name(i)) for i, (name, kind, _) in enumerate(_FEED)]


@key(
    "t01_bronze_orders",
    f"""SELECT {feed_sql()}, _ingested_at, 'orders.csv' AS _source_file, 'orders' AS _dataset_name,
  'load-' || year(_ingested_at) AS _ingestion_run_id, 'ACTIVE' AS _record_status, ingested_date FROM wide""",
)
def _t01(w):
    lineage = ("_ingested_at", "_source_file", "_dataset_name", "_ingestion_run_id", "_record_status", "ingested_date")
    return stable(w.table("bronze_orders").select(*feed_columns(), *lineage))


@key(
    "t02_bronze_clickstream",
    f"""SELECT event_id, ts, user_id, event_type, {r('value')} AS value, props, ts AS _ingested_at,
  'clicks.csv' AS _source_file, 'clickstream' AS _dataset_name, 'load-1' AS _ingestion_run_id,
  'ACTIVE' AS _record_status, CAST(ts AS DATE) AS ingested_date FROM events""",
)
def _t02(w):
    return stable(w.table("bronze_clickstream"))


for _name in _NUMBERS:
    _register(_name)


REGIONS = ["AFRICA 0", "ASIA 1", "EUROPE 2", "AMERICA 0", "MIDDLE EAST 1"]
_IN = "order_region IN (" + ", ".join(f"'{x}'" for x in REGIONS) + ")"


@key("q01_region_list", "SELECT DISTINCT order_region FROM mart_executive_summary")
def _q01(w):
    return questions.region_list(w.table("mart_executive_summary"))


@key(
    "q02_kpi_totals",
    f"""SELECT {r('coalesce(sum(total_sales), 0)')} AS total_sales, {r('coalesce(sum(total_profit), 0)')} AS total_profit,
  {big('coalesce(sum(total_orders), 0)')} AS total_orders,
  {r('coalesce(sum(total_profit) / nullif(sum(total_sales), 0) * 100, 0)')} AS profit_margin_pct
FROM mart_executive_summary WHERE {_IN}""",
)
def _q02(w):
    return stable(questions.kpi_totals(w.table("mart_executive_summary"), REGIONS))


@key(
    "q02_kpi_totals_all_regions",
    f"""SELECT {r('coalesce(sum(total_sales), 0)')} AS total_sales, {r('coalesce(sum(total_profit), 0)')} AS total_profit,
  {big('coalesce(sum(total_orders), 0)')} AS total_orders,
  {r('coalesce(sum(total_profit) / nullif(sum(total_sales), 0) * 100, 0)')} AS profit_margin_pct
FROM mart_executive_summary""",
)
def _q02_all(w):
    return stable(questions.kpi_totals(w.table("mart_executive_summary")))


@key(
    "q03_sales_by_department",
    f"SELECT department_name, {r('sum(total_sales)')} AS total_sales FROM mart_executive_summary WHERE {_IN} GROUP BY 1",
)
def _q03(w):
    return stable(questions.sales_by_department(w.table("mart_executive_summary"), REGIONS))


@key(
    "q04_customers_by_segment",
    f"SELECT customer_segment, {big('sum(total_customers)')} AS total_customers FROM mart_customer_summary GROUP BY 1",
)
def _q04(w):
    return questions.customers_by_segment(w.table("mart_customer_summary"))


@key(
    "q05_orders_by_region",
    f"SELECT order_region, {big('sum(total_orders)')} AS total_orders FROM mart_executive_summary WHERE {_IN} GROUP BY 1",
)
def _q05(w):
    return questions.orders_by_region(w.table("mart_executive_summary"), REGIONS)


@key(
    "q05_orders_by_region_exact",
    "SELECT order_region, count(DISTINCT f.order_id) AS total_orders FROM fact_order_items f "
    "LEFT JOIN dim_order o ON f.order_id = o.order_id GROUP BY 1",
)
def _q05_exact(w):
    return marts.region_orders_exact(w.table("fact_order_items"), w.table("dim_order"))


@key(
    "q06_top_countries",
    f"SELECT customer_country, {big('sum(total_customers)')} AS total_customers FROM mart_customer_summary GROUP BY 1 "
    "ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10",
)
def _q06(w):
    return questions.top_countries(w.table("mart_customer_summary"))


@key(
    "q07_top_categories",
    f"SELECT category_name, {r('total_sales')} AS total_sales FROM (SELECT * FROM mart_product_category_sales "
    "ORDER BY total_sales DESC NULLS LAST, category_name LIMIT 15)",
)
def _q07(w):
    return stable(questions.top_categories(w.table("mart_product_category_sales")))


@key("q08_shipping_mode_split", "SELECT * FROM mart_supply_chain_shipping_mode")
def _q08(w):
    return questions.shipping_mode_split(w.table("mart_supply_chain_shipping_mode"))


@key("q09_discount_curve", _SQL["mart_product_discount_impact"])
def _q09(w):
    return stable(questions.discount_curve(w.table("mart_product_discount_impact")))


@key("q10_delay_by_region", _SQL["mart_supply_chain_region_delay"])
def _q10(w):
    return stable(questions.delay_by_region(w.table("mart_supply_chain_region_delay")))


@key(
    "q11_monitoring_totals",
    "SELECT coalesce(predicted_late, 0) AS predicted_late, coalesce(actual_late, 0) AS actual_late, "
    "coalesce(violations, 0) AS violations FROM mart_ai_monitoring_summary",
)
def _q11(w):
    return questions.monitoring_totals(w.table("mart_ai_monitoring_summary"))


@key("q12_high_risk_regions", "SELECT * FROM mart_ai_monitoring_risk_by_region")
def _q12(w):
    return questions.high_risk_regions(w.table("mart_ai_monitoring_risk_by_region"))


@key(
    "q13_margin_by_department",
    f"""SELECT department_name, {r('sum(total_sales)')} AS total_sales, {r('sum(total_profit)')} AS total_profit,
  {r('sum(total_profit) / nullif(sum(total_sales), 0) * 100', 2)} AS profit_margin_pct
FROM mart_executive_summary WHERE {_IN} GROUP BY 1""",
)
def _q13(w):
    return stable(questions.margin_by_department(w.table("mart_executive_summary"), REGIONS))


@key(
    "q14_discount_sensitivity_top8",
    f"""SELECT category_name, discount_bucket, {r('avg_sales')} AS avg_sales
FROM mart_product_discount_impact_by_category WHERE category_name IN (
  SELECT category_name FROM mart_product_category_sales ORDER BY total_sales DESC NULLS LAST, category_name LIMIT 8)""",
)
def _q14(w):
    return stable(
        questions.discount_sensitivity(
            w.table("mart_product_discount_impact_by_category"), w.table("mart_product_category_sales")
        )
    )


@key("q15_segment_revenue", _SQL["mart_customer_segment_revenue"])
def _q15(w):
    return stable(questions.segment_revenue(w.table("mart_customer_segment_revenue")))


@key(
    "q16_monthly_trend",
    f"""SELECT year, month, month_name, {r('total_sales')} AS total_sales, {r('total_profit')} AS total_profit,
  {r('avg_delay')} AS avg_delay, substr(month_name, 1, 3) || ' ' || year AS period FROM mart_trend_monthly""",
)
def _q16(w):
    return stable(questions.monthly_trend(w.table("mart_trend_monthly")))


@key(
    "q17_violations_by_mode_region",
    "SELECT order_region, shipping_mode, violations FROM mart_ai_monitoring_risk_by_mode_region",
)
def _q17(w):
    return questions.violations_by_mode_region(w.table("mart_ai_monitoring_risk_by_mode_region"))


@key(
    "q18_top_products",
    f"""SELECT f.product_card_id, p.product_name, {r('sum(f.sales)')} AS revenue FROM fact_order_items f
LEFT JOIN dim_product p ON f.product_card_id = p.product_card_id GROUP BY 1, 2
ORDER BY sum(f.sales) DESC NULLS LAST, 1 LIMIT 5""",
)
def _q18(w):
    return stable(questions.top_products(w.table("fact_order_items"), w.table("dim_product")))


@key(
    "q19_revenue_by_market",
    f"SELECT market, {r('sum(sales)')} AS revenue FROM fact_order_items f LEFT JOIN dim_order o "
    "ON f.order_id = o.order_id GROUP BY 1",
)
def _q19(w):
    return stable(questions.revenue_by_market(w.table("fact_order_items"), w.table("dim_order")))


_LATE = "CAST(sum(is_actual_late) AS DOUBLE) / nullif(count(*), 0)"


@key(
    "q20_late_rate_by_shipping_mode",
    f"SELECT shipping_mode, count(*) AS total_orders, {big('sum(is_actual_late)')} AS late_orders, {r(_LATE)} AS late_rate "
    "FROM dim_order GROUP BY 1",
)
def _q20(w):
    return questions.late_rate_by_shipping_mode(w.table("dim_order"))


@key(
    "q21_top_customers",
    f"""SELECT f.customer_id, c.customer_full_name, {r('sum(f.sales)')} AS revenue, count(*) AS items
FROM fact_order_items f LEFT JOIN dim_customer c ON f.customer_id = c.customer_id
WHERE f.customer_id IS NOT NULL GROUP BY 1, 2 ORDER BY sum(f.sales) DESC NULLS LAST, 1 LIMIT 10""",
)
def _q21(w):
    return stable(questions.top_customers(w.table("fact_order_items"), w.table("dim_customer")))


@key(
    "q22_revenue_by_month",
    f"SELECT year, month, {r('sum(sales)')} AS revenue, {r('sum(order_profit)')} AS profit FROM month_base GROUP BY 1, 2",
)
def _q22(w):
    return stable(questions.revenue_by_month(w.table("fact_order_items"), w.table("dim_date")))


@key(
    "q23_most_profitable_segment",
    f"""SELECT customer_segment, {r('sum(order_profit)')} AS profit FROM fact_order_items f
LEFT JOIN dim_customer c ON f.customer_id = c.customer_id GROUP BY 1 ORDER BY sum(order_profit) DESC NULLS LAST, 1 LIMIT 1""",
)
def _q23(w):
    return stable(questions.most_profitable_segment(w.table("fact_order_items"), w.table("dim_customer")))


@key(
    "q24_latest_region",
    f"SELECT order_region, count(*) AS total_orders, {big('sum(is_actual_late)')} AS late_orders, {r(_LATE)} AS late_rate "
    "FROM dim_order GROUP BY 1 ORDER BY 4 DESC NULLS LAST, 1 LIMIT 1",
)
def _q24(w):
    return questions.latest_region(w.table("dim_order"))


@key(
    "q25_best_selling_category",
    f"""SELECT category_name, {big('sum(order_item_quantity)')} AS quantity FROM fact_order_items f
LEFT JOIN dim_product p ON f.product_card_id = p.product_card_id GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 1""",
)
def _q25(w):
    return questions.best_selling_category(w.table("fact_order_items"), w.table("dim_product"))
