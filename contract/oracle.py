"""The tables in plain SQL, written from their definition and independent of the Spark plans."""

from __future__ import annotations

import re


def r(x: str, digits: int = 4) -> str:
    """Rounding on the decimal value, as the compared columns use it."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def _latest(columns: str, key: str) -> str:
    rest = ", ".join(f"{c} ASC NULLS FIRST" for c in columns.replace(",", " ").split() if c != key)
    return (
        f"SELECT {columns} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} "
        f"ORDER BY _ingested_at DESC NULLS LAST, {rest}) AS rn FROM (%s)) WHERE rn = 1"
    )


_CUSTOMER = (
    "customer_id, customer_first_name, customer_last_name, customer_full_name, customer_segment, customer_city, "
    "customer_state, customer_country, customer_street, customer_zipcode"
)
_ORDER = (
    "order_id, customer_id, payment_type, order_status, market, order_region, order_country, order_state, order_city, "
    "delivery_latitude, delivery_longitude, order_date, shipping_date, shipping_mode, delivery_status, "
    "days_scheduled, days_actual, days_diff, late_delivery_risk, is_actual_late, is_label_violation"
)
_ITEM = (
    "order_item_id, order_id, product_card_id, department_id, order_item_quantity, order_item_product_price, "
    "order_item_discount_amount, order_item_discount_rate, sales, order_item_total, order_item_profit_ratio, "
    "order_benefit, order_profit"
)
_PRODUCT = (
    "product_card_id, product_name, product_price, product_status, product_status_label, category_id, "
    "category_name, department_id"
)
_MEASURES = (
    "order_item_quantity, order_item_product_price, order_item_discount_amount, order_item_discount_rate, sales, "
    "order_item_total, order_item_profit_ratio, order_profit"
)

BUCKET = (
    "CASE WHEN order_item_discount_rate = 0 THEN '0%' WHEN order_item_discount_rate <= 0.10 THEN '1-10%' "
    "WHEN order_item_discount_rate <= 0.20 THEN '11-20%' WHEN order_item_discount_rate <= 0.30 THEN '21-30%' "
    "ELSE '31%+' END"
)

CTES = {
    # One row per line item version; names ending in _raw keep blanks as the feed has them.
    "wide": """
SELECT
  CASE o_orderkey % 4 WHEN 0 THEN 'DEBIT' WHEN 1 THEN 'TRANSFER' WHEN 2 THEN 'PAYMENT' ELSE 'CASH' END AS payment_type,
  da AS days_actual, ds AS days_scheduled, da - ds AS days_diff,
  CASE WHEN da > ds THEN 1 ELSE 0 END AS is_actual_late,
  (da > ds AND o_orderkey % 11 <> 0) AS late_delivery_risk,
  (da > ds AND NOT (da > ds AND o_orderkey % 11 <> 0)) AS is_label_violation,
  l_extendedprice * ratio AS order_benefit, l_extendedprice * ratio AS order_profit,
  CASE WHEN l_linestatus = 'F' THEN 'Shipping on time' ELSE 'Late delivery' END AS delivery_status,
  CAST(substr(p_brand, 7) AS BIGINT) AS category_id, p_brand AS category_name,
  'City ' || (c_custkey % 50) AS customer_city, cn.n_name AS customer_country,
  'Customer' AS customer_first_name, o_custkey AS customer_id,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE '  ' || c_name || ' ' END AS customer_last_name_raw,
  CASE WHEN c_custkey % 17 = 0 THEN '' ELSE c_name END AS customer_last_name,
  CASE WHEN c_custkey % 17 = 0 THEN 'Customer' ELSE 'Customer ' || c_name END AS customer_full_name,
  c_mktsegment AS customer_segment, 'State ' || c_nationkey AS customer_state,
  l_suppkey || ' Main Street' AS customer_street,
  CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 13 = 1 THEN '  ' ELSE CAST(c_custkey AS VARCHAR) END
    AS customer_zipcode_raw,
  CASE WHEN c_custkey % 13 IN (0, 1) THEN 'Unknown' ELSE CAST(c_custkey AS VARCHAR) END AS customer_zipcode,
  CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4
    WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END AS BIGINT) AS department_id, p_type AS department_name,
  CAST(o_orderkey % 180 AS DOUBLE) - 89.5 AS delivery_latitude,
  CAST(o_orderkey % 360 AS DOUBLE) - 179.75 AS delivery_longitude,
  r_name AS market,
  CASE o_orderkey % 3 WHEN 0 THEN 'São Paulo' WHEN 1 THEN 'Besançon' ELSE 'Tegucigalpa' END AS order_city,
  onn.n_name AS order_country,
  od AS order_date, od + to_days(da) AS shipping_date,
  o_orderkey AS order_id, l_partkey AS product_card_id,
  l_extendedprice * (l_discount * 4) AS order_item_discount_amount, l_discount * 4 AS order_item_discount_rate,
  l_orderkey * 10 + l_linenumber AS order_item_id, l_extendedprice / l_quantity AS order_item_product_price,
  ratio AS order_item_profit_ratio, CAST(l_quantity AS INTEGER) AS order_item_quantity, l_extendedprice AS sales,
  l_extendedprice - l_extendedprice * (l_discount * 4) AS order_item_total,
  r_name || ' ' || (o_orderkey % 3) || ' ' AS order_region_raw, r_name || ' ' || (o_orderkey % 3) AS order_region,
  'State ' || (o_orderkey % 10) AS order_state,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' WHEN 'O' THEN 'PENDING' ELSE 'PROCESSING' END AS order_status,
  p_name AS product_name, p_retailprice AS product_price,
  CAST((p_size + l_suppkey) % 2 AS INTEGER) AS product_status,
  CASE WHEN (p_size + l_suppkey) % 2 = 1 THEN 'Active' ELSE 'Inactive' END AS product_status_label,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Same Day' WHEN '2' THEN 'First Class'
    WHEN '3' THEN 'Second Class' ELSE 'Standard Class' END AS shipping_mode,
  l_shipdate AS _ingested_at, make_date(year(l_shipdate), 12, 31) AS ingested_date
FROM (SELECT *, l_tax * 5 - CAST(0.2 AS DOUBLE) AS ratio FROM lineitem)
JOIN (SELECT *, CAST((o_orderkey * 7 + o_custkey) % 7 AS INTEGER) AS da,
        CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 0 WHEN '2' THEN 1 WHEN '3' THEN 2 ELSE 4 END AS ds,
        o_orderdate + to_minutes(o_orderkey % 1440) AS od FROM orders) ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey
JOIN nation cn ON cn.n_nationkey = c_nationkey
JOIN nation onn ON onn.n_nationkey = o_orderkey % 25
JOIN region ON r_regionkey = onn.n_regionkey""",
    "stg_customer": _latest(_CUSTOMER, "customer_id") % "SELECT * FROM wide",
    "stg_department": _latest("department_id, department_name", "department_id") % "SELECT * FROM wide",
    "stg_order": _latest(_ORDER, "order_id") % "SELECT * FROM wide",
    "stg_order_items": _latest(_ITEM, "order_item_id") % "SELECT * FROM wide",
    "stg_product": _latest(_PRODUCT, "product_card_id") % "SELECT * FROM wide",
    "dim_customer": "SELECT * FROM stg_customer",
    "dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day, year(d) AS year, quarter(d) AS quarter,
  month(d) AS month, strftime(d, '%B') AS month_name, day(d) AS day_of_month, dayofweek(d) AS day_of_week,
  strftime(d, '%A') AS day_name, weekofyear(d) AS week_of_year
FROM (SELECT CAST(unnest(generate_series(
    (SELECT CAST(min(order_date) AS DATE) FROM stg_order),
    (SELECT CAST(max(shipping_date) AS DATE) FROM stg_order), INTERVAL 1 DAY)) AS DATE) AS d)""",
    "dim_order": f"SELECT {_ORDER.replace('customer_id, ', '')} FROM stg_order",
    "dim_product": "SELECT p.*, d.department_name FROM stg_product p LEFT JOIN stg_department d "
    "ON p.department_id = d.department_id",
    "fact_order_items": f"""
SELECT i.order_item_id, i.order_id, i.product_card_id, o.customer_id,
  CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS order_date_key,
  CAST(strftime(o.shipping_date, '%Y%m%d') AS INTEGER) AS shipping_date_key, {_MEASURES}
FROM stg_order_items i LEFT JOIN stg_order o ON i.order_id = o.order_id""",
    "mart_executive_summary": f"""
SELECT o.order_region, p.department_name, count(DISTINCT f.order_id) AS total_orders, sum(f.sales) AS total_sales,
  sum(f.order_profit) AS total_profit,
  {r('sum(f.order_profit) / nullif(sum(f.sales), 0) * 100', 2)} AS profit_margin_pct
FROM fact_order_items f LEFT JOIN dim_order o ON f.order_id = o.order_id
LEFT JOIN dim_product p ON f.product_card_id = p.product_card_id GROUP BY 1, 2""",
    "mart_customer_summary": "SELECT customer_segment, customer_country, count(DISTINCT customer_id) AS total_customers "
    "FROM dim_customer GROUP BY 1, 2",
    "mart_customer_segment_revenue": f"""
SELECT c.customer_segment, count(DISTINCT f.customer_id) AS total_customers, sum(f.sales) AS total_sales,
  sum(f.order_profit) AS total_profit,
  {r('sum(f.sales) / nullif(count(DISTINCT f.customer_id), 0)', 2)} AS avg_revenue_per_customer
FROM fact_order_items f LEFT JOIN dim_customer c ON f.customer_id = c.customer_id GROUP BY 1""",
    "mart_product_category_sales": "SELECT p.category_name, sum(f.sales) AS total_sales FROM fact_order_items f "
    "LEFT JOIN dim_product p ON f.product_card_id = p.product_card_id GROUP BY 1",
    "mart_product_discount_impact": "SELECT order_item_discount_rate, avg(sales) AS avg_sales FROM fact_order_items "
    "GROUP BY 1",
    "mart_product_discount_impact_by_category": f"""
SELECT p.category_name, {BUCKET} AS discount_bucket, count(*) AS order_item_count, avg(f.sales) AS avg_sales
FROM fact_order_items f LEFT JOIN dim_product p ON f.product_card_id = p.product_card_id GROUP BY 1, 2""",
    "mart_supply_chain_shipping_mode": "SELECT shipping_mode, count(*) AS total_orders FROM dim_order GROUP BY 1",
    "mart_supply_chain_region_delay": "SELECT order_region, avg(days_diff) AS avg_delay FROM dim_order GROUP BY 1",
    "mart_ai_monitoring_summary": f"""
SELECT {big('sum(CASE WHEN late_delivery_risk THEN 1 ELSE 0 END)')} AS predicted_late,
  {big('sum(CASE WHEN is_actual_late = 1 THEN 1 ELSE 0 END)')} AS actual_late,
  {big('sum(CASE WHEN is_label_violation THEN 1 ELSE 0 END)')} AS violations FROM dim_order""",
    "mart_ai_monitoring_risk_by_region": f"""
SELECT order_region, {big('sum(CASE WHEN late_delivery_risk THEN 1 ELSE 0 END)')} AS risk_orders
FROM dim_order GROUP BY 1""",
    "mart_ai_monitoring_risk_by_mode_region": f"""
SELECT order_region, shipping_mode, count(*) AS total_orders,
  {big('sum(CASE WHEN late_delivery_risk THEN 1 ELSE 0 END)')} AS predicted_late,
  {big('sum(CASE WHEN is_actual_late = 1 THEN 1 ELSE 0 END)')} AS actual_late,
  {big('sum(CASE WHEN is_label_violation THEN 1 ELSE 0 END)')} AS violations FROM dim_order GROUP BY 1, 2""",
    "month_base": """
SELECT f.order_id, f.sales, f.order_profit, d.year, d.month, d.month_name
FROM fact_order_items f LEFT JOIN dim_date d ON f.order_date_key = d.date_key""",
    "mart_trend_monthly": """
SELECT s.*, d.avg_delay FROM (
  SELECT year, month, month_name, count(DISTINCT order_id) AS total_orders, sum(sales) AS total_sales,
    sum(order_profit) AS total_profit FROM month_base GROUP BY 1, 2, 3) s
LEFT JOIN (SELECT year, month, month_name, avg(days_diff) AS avg_delay FROM (
    SELECT DISTINCT b.order_id, b.year, b.month, b.month_name, o.days_diff
    FROM month_base b LEFT JOIN dim_order o ON b.order_id = o.order_id) GROUP BY 1, 2, 3) d
ON s.year = d.year AND s.month = d.month AND s.month_name = d.month_name""",
    "feat_customer": f"""
SELECT l.customer_id, c.customer_segment, c.customer_country, count(DISTINCT order_id) AS total_orders,
  {r('avg(days_actual - days_scheduled)', 3)} AS avg_days_late,
  {r('CAST(sum(CASE WHEN late_delivery_risk THEN 1 ELSE 0 END) AS DOUBLE) / nullif(count(*), 0)', 3)}
    AS late_delivery_rate,
  max(CASE WHEN customer_country <> order_country THEN 1 ELSE 0 END) AS is_cross_border
FROM (SELECT DISTINCT f.customer_id, f.order_id, o.days_actual, o.days_scheduled, o.late_delivery_risk,
        o.order_country FROM fact_order_items f LEFT JOIN dim_order o ON f.order_id = o.order_id) l
LEFT JOIN dim_customer c ON l.customer_id = c.customer_id GROUP BY 1, 2, 3""",
    "feat_items": f"""
SELECT f.order_item_id, {_MEASURES}, payment_type, market, order_region, order_country, order_state, order_city,
  shipping_mode, days_scheduled, late_delivery_risk, category_name, department_name, customer_segment,
  customer_country, CAST(isodow(order_date) IN (6, 7) AS INTEGER) AS is_weekend, month(order_date) AS order_month,
  quarter(order_date) AS order_quarter, isodow(shipping_date) AS ship_day_of_week, hour(order_date) AS order_hour,
  CAST(hour(order_date) >= 18 OR hour(order_date) < 6 AS INTEGER) AS is_night_order,
  CAST(customer_country <> order_country AS INTEGER) AS is_cross_border,
  order_profit / nullif(sales, 0) AS profit_margin, sales / nullif(order_item_quantity, 0) AS unit_price,
  CAST(days_scheduled <= 2 AS INTEGER) AS is_urgent_shipping,
  CAST(order_item_discount_rate > 0.15 AS INTEGER) AS is_high_discount
FROM fact_order_items f JOIN dim_order o ON f.order_id = o.order_id
LEFT JOIN dim_product p ON f.product_card_id = p.product_card_id
LEFT JOIN dim_customer c ON f.customer_id = c.customer_id""",
    "coded": "SELECT o.order_id, o.order_country, o.order_city, o.order_date, c.customer_zipcode FROM stg_order o "
    "LEFT JOIN stg_customer c ON o.customer_id = c.customer_id",
    # Item-grain label with three scores of differing quality; the formulas are exact in double.
    "scored": """
SELECT i.order_item_id, CAST(o.late_delivery_risk AS INTEGER) AS label,
  ((i.order_item_id * 31) % 997 + CASE WHEN o.late_delivery_risk THEN 400 ELSE 0 END) / 1397.0::DOUBLE AS score_a,
  ((i.order_item_id * 17) % 499 + CASE WHEN o.late_delivery_risk THEN 100 ELSE 0 END) / 599.0::DOUBLE AS score_b,
  ((i.order_item_id * 13) % 101) / 101.0::DOUBLE AS score_c
FROM stg_order_items i JOIN stg_order o ON i.order_id = o.order_id""",
}


def with_tables(body: str) -> str:
    """Put the tables a query names in front of it, in order of definition."""

    def named(text: str) -> set[str]:
        return {n for n in CTES if re.search(rf"\b{n}\b", text)}

    needed = named(body)
    while True:
        more = needed | {m for n in needed for m in named(CTES[n])}
        if more == needed:
            break
        needed = more
    parts = [f"{n} AS ({CTES[n]})" for n in CTES if n in needed]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
