"""P projections, J joins, A aggregations, W windows, O order and limits, F functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.oracle import BUCKET, big, r
from contract.registry import key
from quayside.functions import (
    blank_to_unknown,
    date_key,
    discount_bucket,
    double_to_int,
    feed_time,
    flag,
    flag_rate,
    flag_sum,
    full_name,
    id_part,
    iso_day,
    lenient_double,
    period_label,
    ratio,
    round_to,
    stable,
    sunday_based_day,
    text_to_bigint,
    text_to_flag,
    text_to_int,
    trimmed,
)
from quayside.ml import evaluate
from quayside.ml.score import predicted_late
from quayside.operators.latest import latest_attributes, latest_rows, latest_rows_by_window
from quayside.operators.quality import orphan_keys
from quayside.plans import questions, silver, star
from quayside.sources.lake import preview


def src(name: str):
    return F.col(f"`{name}`")


def scored(w):
    """Item-grain label with three scores of differing quality, derived from the item ids."""
    item = F.col("order_item_id")
    late = F.col("late_delivery_risk")
    rows = w.table("stg_order_items").join(w.table("stg_order").select("order_id", "late_delivery_risk"), "order_id")
    return rows.select(
        item,
        late.cast("int").alias("label"),
        ((item * 31 % 997 + F.when(late, 400).otherwise(0)) / F.lit(1397.0)).alias("score_a"),
        ((item * 17 % 499 + F.when(late, 100).otherwise(0)) / F.lit(599.0)).alias("score_b"),
        ((item * 13 % 101) / F.lit(101.0)).alias("score_c"),
    )


# --- P ---------------------------------------------------------------------------------------


@key(
    "p01_projection_rename",
    "SELECT order_item_id, order_id, payment_type, order_status, order_city, product_name FROM wide",
)
def _p01(w):
    return w.table("bronze_orders").select(
        src("Order Item Id").cast("bigint").alias("order_item_id"),
        src("Order Id").cast("bigint").alias("order_id"),
        src("Type").alias("payment_type"),
        src("Order Status").alias("order_status"),
        src("Order City").alias("order_city"),
        src("Product Name").alias("product_name"),
    )


@key(
    "p02_casts",
    f"""SELECT order_item_id, order_item_quantity, {r('sales')} AS sales, late_delivery_risk,
  CAST(CAST(order_item_quantity / 2.0::DOUBLE AS VARCHAR) AS INTEGER) AS half_from_text,
  CAST(order_item_quantity / 2.0::DOUBLE AS INTEGER) AS half_from_double,
  CAST(order_date AS DATE) AS order_day, CAST(order_id AS VARCHAR) AS order_text FROM wide""",
)
def _p02(w):
    half = src("Order Item Quantity").cast("double") / 2
    return stable(
        w.table("bronze_orders").select(
            text_to_bigint(src("Order Item Id")).alias("order_item_id"),
            text_to_int(src("Order Item Quantity")).alias("order_item_quantity"),
            src("Sales").cast("double").alias("sales"),
            text_to_flag(src("Late_delivery_risk")).alias("late_delivery_risk"),
            text_to_int(half.cast("string")).alias("half_from_text"),
            double_to_int(half).alias("half_from_double"),
            feed_time(src("order date (DateOrders)")).cast("date").alias("order_day"),
            src("Order Id").cast("string").alias("order_text"),
        )
    )


@key("p03_drop_columns", "SELECT * EXCLUDE (customer_street, customer_zipcode) FROM stg_customer")
def _p03(w):
    return w.table("stg_customer").drop("_loaded_at", "customer_street", "customer_zipcode")


@key(
    "p04_qualified_star",
    f"""SELECT f.order_item_id, f.order_id, f.product_card_id, f.customer_id, f.order_date_key, f.shipping_date_key,
  {r('f.sales')} AS sales, o.* EXCLUDE (order_id, order_status, delivery_status, days_actual, days_diff,
    is_actual_late, is_label_violation, delivery_latitude, delivery_longitude)
FROM fact_order_items f JOIN dim_order o ON f.order_id = o.order_id""",
)
def _p04(w):
    facts = w.table("fact_order_items").select(
        "order_item_id", "order_id", "product_card_id", "customer_id", "order_date_key", "shipping_date_key", "sales"
    )
    orders = w.table("dim_order").drop(
        "order_status",
        "delivery_status",
        "days_actual",
        "days_diff",
        "is_actual_late",
        "is_label_violation",
        "delivery_latitude",
        "delivery_longitude",
    )
    return stable(facts.join(orders, "order_id"))


@key(
    "p05_not_null_filter",
    "SELECT customer_segment, count(*) AS row_count FROM wide WHERE customer_zipcode_raw IS NOT NULL "
    "AND customer_last_name_raw IS NOT NULL GROUP BY 1",
)
def _p05(w):
    kept = w.table("bronze_orders").filter(src("Customer Zipcode").isNotNull() & src("Customer Lname").isNotNull())
    return kept.groupBy(src("Customer Segment").alias("customer_segment")).agg(F.count(F.lit(1)).alias("row_count"))


@key("p06_cte_chain", "SELECT order_status, count(*) AS orders, min(order_date) AS first_order FROM stg_order GROUP BY 1")
def _p06(w):
    cleaned = silver.clean_order(w.table("bronze_orders"))
    final = latest_rows(cleaned, ["order_id"], silver.VERSION)
    return final.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"), F.min("order_date").alias("first_order"))


@key(
    "p07_case_labels",
    f"""SELECT product_status_label, is_actual_late, is_label_violation, {BUCKET} AS discount_bucket,
  count(*) AS row_count FROM wide GROUP BY 1, 2, 3, 4""",
)
def _p07(w):
    feed = w.table("bronze_orders")
    actual = text_to_int(src("Days for shipping (real)"))
    scheduled = text_to_int(src("Days for shipment (scheduled)"))
    labels = feed.select(
        F.when(text_to_int(src("Product Status")) == 1, "Active").otherwise("Inactive").alias("product_status_label"),
        F.when(actual > scheduled, 1).otherwise(0).alias("is_actual_late"),
        F.when((actual > scheduled) & ~text_to_flag(src("Late_delivery_risk")), True)
        .otherwise(False)
        .alias("is_label_violation"),
        discount_bucket(src("Order Item Discount Rate").cast("double")).alias("discount_bucket"),
    )
    return labels.groupBy(*labels.columns).agg(F.count(F.lit(1)).alias("row_count"))


@key("p08_blank_to_unknown", "SELECT customer_zipcode, count(*) AS row_count FROM wide GROUP BY 1")
def _p08(w):
    zipcode = blank_to_unknown(src("Customer Zipcode")).alias("customer_zipcode")
    return w.table("bronze_orders").groupBy(zipcode).agg(F.count(F.lit(1)).alias("row_count"))


@key(
    "p09_in_list",
    "SELECT order_id, order_region, isodow(order_date) AS iso_day FROM dim_order "
    "WHERE isodow(order_date) IN (6, 7) AND order_region IN ('ASIA 0', 'EUROPE 1')",
)
def _p09(w):
    day = iso_day("order_date")
    kept = w.table("dim_order").filter(day.isin(6, 7) & F.col("order_region").isin("ASIA 0", "EUROPE 1"))
    return kept.select("order_id", "order_region", day.cast("bigint").alias("iso_day"))


@key(
    "p10_in_top_k",
    f"""SELECT p.product_card_id, p.category_name, {r('p.product_price')} AS product_price FROM dim_product p
WHERE category_name IN (SELECT category_name FROM mart_product_category_sales
  ORDER BY total_sales DESC NULLS LAST, category_name LIMIT 8)""",
)
def _p10(w):
    best = questions.top(w.table("mart_product_category_sales"), 8, "total_sales", "category_name")
    products = w.table("dim_product").select("product_card_id", "category_name", "product_price")
    return stable(products.join(best.select("category_name"), "category_name", "left_semi"))


@key(
    "p11_scalar_subqueries",
    "SELECT order_id, order_date, shipping_date FROM stg_order WHERE order_date = (SELECT min(order_date) FROM stg_order) "
    "OR shipping_date = (SELECT max(shipping_date) FROM stg_order)",
)
def _p11(w):
    return w.spark.sql(
        """SELECT order_id, order_date, shipping_date FROM {o} WHERE order_date = (SELECT min(order_date) FROM {o})
        OR shipping_date = (SELECT max(shipping_date) FROM {o})""",
        o=w.table("stg_order").drop("_loaded_at"),
    )


@key(
    "p12_three_valued_flags",
    """SELECT is_weekend, is_night_order, is_cross_border, is_urgent_shipping, is_high_discount,
  coalesce(CAST(nullif(days_scheduled, 4) <= 2 OR is_weekend = 1 AS INTEGER), -1) AS quick_or_weekend, count(*) AS row_count
FROM feat_items GROUP BY 1, 2, 3, 4, 5, 6""",
)
def _p12(w):
    flags = w.table("feat_delivery_risk").select(
        "is_weekend",
        "is_night_order",
        "is_cross_border",
        "is_urgent_shipping",
        "is_high_discount",
        # NULL or true is true, NULL or false is NULL, shown as -1.
        F.coalesce(
            ((F.nullif("days_scheduled", F.lit(4)) <= 2) | (F.col("is_weekend") == 1)).cast("int"), F.lit(-1)
        ).alias("quick_or_weekend"),
    )
    return flags.groupBy(*flags.columns).agg(F.count(F.lit(1)).alias("row_count"))


@key(
    "p13_score_predicates",
    "SELECT order_item_id, label, CAST(score_a >= 0.6 AS INTEGER) AS predicted_late FROM scored WHERE score_a >= 0.6 "
    "AND label = 1",
)
def _p13(w):
    rows = scored(w).select("order_item_id", "label", "score_a", predicted_late(0.6, "score_a"))
    return rows.filter("predicted_late = 1 AND label = 1 AND score_a >= 0.6D").drop("score_a")


# --- J ---------------------------------------------------------------------------------------


@key(
    "j01_left_join_dimension",
    "SELECT department_name, count(*) AS products FROM dim_product GROUP BY 1",
)
def _j01(w):
    joined = star.dim_product(w.table("stg_product"), w.table("stg_department"))
    return joined.groupBy("department_name").agg(F.count(F.lit(1)).alias("products"))


@key(
    "j02_left_join_line_header",
    "SELECT i.order_item_id, i.order_id, o.customer_id, o.order_status FROM stg_order_items i "
    "LEFT JOIN stg_order o ON i.order_id = o.order_id",
)
def _j02(w):
    headers = w.table("stg_order").select("order_id", "customer_id", "order_status")
    return w.table("stg_order_items").select("order_item_id", "order_id").join(headers, "order_id", "left")


@key(
    "j03_star_join",
    f"""SELECT o.market, p.category_name, c.customer_segment, count(*) AS items, {r('sum(f.sales)')} AS sales
FROM fact_order_items f LEFT JOIN dim_order o ON f.order_id = o.order_id
LEFT JOIN dim_product p ON f.product_card_id = p.product_card_id
LEFT JOIN dim_customer c ON f.customer_id = c.customer_id GROUP BY 1, 2, 3""",
)
def _j03(w):
    joined = (
        w.table("fact_order_items")
        .select("order_id", "product_card_id", "customer_id", "sales")
        .join(w.table("dim_product").select("product_card_id", "category_name"), "product_card_id", "left")
        .join(w.table("dim_customer").select("customer_id", "customer_segment"), "customer_id", "left")
        .join(w.table("dim_order").select("order_id", "market"), "order_id", "left")
    )
    return stable(
        joined.groupBy("market", "category_name", "customer_segment").agg(
            F.count(F.lit(1)).alias("items"), F.sum("sales").alias("sales")
        )
    )


@key(
    "j04_inner_join",
    "SELECT o.o_orderkey AS order_id, count(*) AS items FROM orders o JOIN stg_order_items i ON i.order_id = o.o_orderkey "
    "GROUP BY 1",
)
def _j04(w):
    orders = w.source("orders").select(F.col("o_orderkey").alias("order_id"))
    items = w.table("stg_order_items").groupBy("order_id").agg(F.count(F.lit(1)).alias("items"))
    return orders.join(items, "order_id")


@key(
    "j05_role_playing_dates",
    f"""SELECT od.year AS order_year, od.month AS order_month, sd.month AS shipping_month, count(*) AS items,
  {r('sum(f.sales)')} AS sales FROM fact_order_items f LEFT JOIN dim_date od ON f.order_date_key = od.date_key
LEFT JOIN dim_date sd ON f.shipping_date_key = sd.date_key GROUP BY 1, 2, 3""",
)
def _j05(w):
    # Facts fold to date pairs first, so only those meet the calendar.
    pairs = w.table("fact_order_items").groupBy("order_date_key", "shipping_date_key").agg(
        F.count(F.lit(1)).alias("items"), F.sum("sales").alias("sales")
    )
    days = w.table("dim_date")
    ordered = days.select(
        F.col("date_key").alias("order_date_key"), F.col("year").alias("order_year"), F.col("month").alias("order_month")
    )
    shipped = days.select(F.col("date_key").alias("shipping_date_key"), F.col("month").alias("shipping_month"))
    joined = pairs.join(ordered, "order_date_key", "left").join(shipped, "shipping_date_key", "left")
    return stable(
        joined.groupBy("order_year", "order_month", "shipping_month").agg(
            F.sum("items").alias("items"), F.sum("sales").alias("sales")
        )
    )


def _month_base(w):
    days = w.table("dim_date").select(F.col("date_key").alias("order_date_key"), "year", "month", "month_name")
    facts = w.table("fact_order_items").select("order_id", "order_date_key", "sales", "order_profit")
    return facts.join(days, "order_date_key", "left")


@key(
    "j06_join_of_aggregates",
    f"SELECT year, month, month_name, total_orders, {r('total_sales')} AS total_sales, {r('avg_delay')} AS avg_delay "
    "FROM mart_trend_monthly",
)
def _j06(w):
    base, month = _month_base(w), ["year", "month", "month_name"]
    sales = base.groupBy(*month).agg(F.countDistinct("order_id").alias("total_orders"), F.sum("sales").alias("total_sales"))
    orders = base.select("order_id", *month).distinct()
    delays = (
        orders.join(w.table("dim_order").select("order_id", "days_diff"), "order_id", "left")
        .groupBy(*month)
        .agg(F.avg("days_diff").alias("avg_delay"))
    )
    return stable(sales.join(delays, month, "left"))


@key(
    "j07_semi_join",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders WHERE o_orderkey IN (SELECT order_id FROM "
    "stg_order_items WHERE order_item_discount_rate > 0.3)",
)
def _j07(w):
    deep = w.table("stg_order_items").filter("order_item_discount_rate > 0.3").select("order_id")
    orders = w.source("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    return orders.join(deep, "order_id", "left_semi")


@key(
    "j08_anti_join",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders WHERE o_orderkey NOT IN "
    "(SELECT order_id FROM stg_order_items)",
)
def _j08(w):
    orders = w.source("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    return orders.join(w.table("stg_order_items").select("order_id"), "order_id", "left_anti")


# --- A ---------------------------------------------------------------------------------------


@key("a01_count", "SELECT order_region, shipping_mode, count(*) AS total_orders FROM dim_order GROUP BY 1, 2")
def _a01(w):
    return w.table("dim_order").groupBy("order_region", "shipping_mode").agg(F.count(F.lit(1)).alias("total_orders"))


@key(
    "a02_count_distinct",
    "SELECT product_card_id, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers "
    "FROM fact_order_items GROUP BY 1",
)
def _a02(w):
    return w.table("fact_order_items").groupBy("product_card_id").agg(
        F.countDistinct("order_id").alias("orders"), F.countDistinct("customer_id").alias("customers")
    )


@key(
    "a03_sum",
    f"SELECT product_card_id, {r('sum(sales)')} AS sales, {big('sum(order_item_quantity)')} AS quantity "
    "FROM fact_order_items GROUP BY 1",
)
def _a03(w):
    return stable(
        w.table("fact_order_items")
        .groupBy("product_card_id")
        .agg(F.sum("sales").alias("sales"), F.sum("order_item_quantity").alias("quantity"))
    )


@key(
    "a04_avg",
    f"SELECT order_country, {r('avg(days_diff)')} AS avg_delay, {r('avg(days_actual)')} AS avg_days FROM dim_order GROUP BY 1",
)
def _a04(w):
    return stable(
        w.table("dim_order")
        .groupBy("order_country")
        .agg(F.avg("days_diff").alias("avg_delay"), F.avg("days_actual").alias("avg_days"))
    )


@key(
    "a05_conditional_sum",
    f"""SELECT order_state, {big('sum(CASE WHEN late_delivery_risk THEN 1 ELSE 0 END)')} AS labelled_late,
  {big('sum(CASE WHEN is_actual_late = 1 THEN 1 ELSE 0 END)')} AS actual_late FROM dim_order GROUP BY 1""",
)
def _a05(w):
    return w.table("dim_order").groupBy("order_state").agg(
        flag_sum(F.col("late_delivery_risk")).alias("labelled_late"),
        flag_sum(F.col("is_actual_late") == 1).alias("actual_late"),
    )


@key(
    "a06_any_flag",
    "SELECT customer_id, max(CASE WHEN order_item_discount_rate > 0.3 THEN 1 ELSE 0 END) AS any_deep_discount "
    "FROM fact_order_items GROUP BY 1",
)
def _a06(w):
    return w.table("fact_order_items").groupBy("customer_id").agg(
        F.max(flag(F.col("order_item_discount_rate") > 0.3)).alias("any_deep_discount")
    )


@key(
    "a07_guarded_ratio",
    f"SELECT customer_id, {r('sum(order_profit) / nullif(sum(sales), 0) * 100', 2)} AS margin_pct, "
    f"{r('sum(sales) / nullif(sum(order_item_quantity) - sum(order_item_quantity), 0)', 2)} AS over_zero "
    "FROM fact_order_items GROUP BY 1",
)
def _a07(w):
    quantity = F.sum("order_item_quantity")
    return w.table("fact_order_items").groupBy("customer_id").agg(
        round_to(ratio(F.sum("order_profit"), F.sum("sales")) * 100, 2).alias("margin_pct"),
        round_to(ratio(F.sum("sales"), quantity - quantity), 2).alias("over_zero"),
    )


@key(
    "a08_ratio_over_distinct",
    f"SELECT product_card_id, {r('sum(sales) / nullif(count(DISTINCT customer_id), 0)', 2)} AS sales_per_customer "
    "FROM fact_order_items GROUP BY 1",
)
def _a08(w):
    # Folded to (product, customer) first: the distinct count becomes a plain count.
    pairs = w.table("fact_order_items").groupBy("product_card_id", "customer_id").agg(F.sum("sales").alias("sales"))
    return pairs.groupBy("product_card_id").agg(
        round_to(ratio(F.sum("sales"), F.count("customer_id")), 2).alias("sales_per_customer")
    )


@key(
    "a09_rate",
    f"SELECT order_city, {r('CAST(sum(CASE WHEN late_delivery_risk THEN 1 ELSE 0 END) AS DOUBLE) / nullif(count(*), 0)', 3)}"
    " AS late_rate FROM dim_order GROUP BY 1",
)
def _a09(w):
    return w.table("dim_order").groupBy("order_city").agg(flag_rate(F.col("late_delivery_risk")).alias("late_rate"))


@key(
    "a10_avg_difference",
    f"SELECT customer_id, {r('avg(days_actual - days_scheduled)', 3)} AS avg_days_late FROM stg_order GROUP BY 1",
)
def _a10(w):
    late_by = F.col("days_actual") - F.col("days_scheduled")
    return w.table("stg_order").groupBy("customer_id").agg(round_to(F.avg(late_by), 3).alias("avg_days_late"))


@key(
    "a11_global_aggregate",
    f"""SELECT count(*) AS items, {r('sum(sales)')} AS sales, {r('avg(order_item_discount_rate)')} AS avg_rate,
  {r('max(order_profit)')} AS max_profit FROM fact_order_items""",
)
def _a11(w):
    return stable(
        w.table("fact_order_items").agg(
            F.count(F.lit(1)).alias("items"),
            F.sum("sales").alias("sales"),
            F.avg("order_item_discount_rate").alias("avg_rate"),
            F.max("order_profit").alias("max_profit"),
        )
    )


@key("a12_distinct_grain", "SELECT DISTINCT customer_id, order_id, order_date_key FROM fact_order_items")
def _a12(w):
    return w.table("fact_order_items").select("customer_id", "order_id", "order_date_key").distinct()


@key(
    "a13_two_level_aggregation",
    f"""SELECT year, month, month_name, {r('avg(items)')} AS avg_items, {r('avg(sales)')} AS avg_order_value FROM (
  SELECT order_id, year, month, month_name, count(*) AS items, sum(sales) AS sales FROM month_base GROUP BY 1, 2, 3, 4)
GROUP BY 1, 2, 3""",
)
def _a13(w):
    base, month = _month_base(w), ["year", "month", "month_name"]
    orders = base.groupBy("order_id", *month).agg(F.count(F.lit(1)).alias("items"), F.sum("sales").alias("sales"))
    return stable(orders.groupBy(*month).agg(F.avg("items").alias("avg_items"), F.avg("sales").alias("avg_order_value")))


@key(
    "a14_min_max_time",
    "SELECT shipping_mode, min(order_date) AS first_order, max(shipping_date) AS last_shipment FROM stg_order GROUP BY 1",
)
def _a14(w):
    return w.table("stg_order").groupBy("shipping_mode").agg(
        F.min("order_date").alias("first_order"), F.max("shipping_date").alias("last_shipment")
    )


@key(
    "a15_reaggregate_mart",
    f"SELECT department_name, {r('sum(total_sales)')} AS total_sales, {big('sum(total_orders)')} AS total_orders "
    "FROM mart_executive_summary GROUP BY 1",
)
def _a15(w):
    return stable(
        w.table("mart_executive_summary")
        .groupBy("department_name")
        .agg(F.sum("total_sales").alias("total_sales"), F.sum("total_orders").alias("total_orders"))
    )


@key(
    "a16_score_histogram",
    "SELECT least(CAST(floor(score_a * 20) AS INTEGER), 19) AS bin, count(*) AS rows FROM scored GROUP BY 1",
)
def _a16(w):
    return evaluate.score_histogram(scored(w), "score_a")


# --- W ---------------------------------------------------------------------------------------

_ITEM_SQL = f"SELECT order_item_id, order_id, product_card_id, {r('sales')} AS sales FROM stg_order_items"


@key("w01_dedup_order_items", _ITEM_SQL)
def _w01(w):
    cleaned = silver.clean_order_items(w.table("bronze_orders"))
    latest = latest_rows(cleaned, ["order_item_id"], silver.VERSION)
    return stable(latest.select("order_item_id", "order_id", "product_card_id", "sales"))


@key("w01_dedup_order_items_by_window", _ITEM_SQL)
def _w01_window(w):
    cleaned = silver.clean_order_items(w.table("bronze_orders"))
    latest = latest_rows_by_window(cleaned, ["order_item_id"], silver.VERSION)
    return stable(latest.select("order_item_id", "order_id", "product_card_id", "sales"))


@key("w01_dedup_customers", "SELECT customer_id, customer_street FROM stg_customer")
def _w01_customers(w):
    cleaned = silver.clean_customer(w.table("bronze_orders"))
    return latest_rows(cleaned, ["customer_id"], silver.VERSION).select("customer_id", "customer_street")


@key(
    "w01_dedup_products",
    "SELECT product_card_id, product_status, product_status_label FROM stg_product",
)
def _w01_products(w):
    cleaned = silver.clean_product(w.table("bronze_orders"))
    latest = latest_attributes(cleaned, ["product_card_id"], silver.VERSION)
    return latest.select("product_card_id", "product_status", "product_status_label")


_CURVE_SQL = """(SELECT score_a AS threshold, pos, neg,
  sum(pos) OVER (ORDER BY score_a DESC) AS tp, sum(neg) OVER (ORDER BY score_a DESC) AS fp, sum(pos) OVER () AS p
  FROM (SELECT score_a, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1))"""


@key(
    "w02_precision_recall_curve",
    f"""SELECT {r('threshold', 6)} AS threshold, {big('tp')} AS true_positives, {big('fp')} AS false_positives,
  {r('tp / (tp + fp)', 6)} AS "precision", {r('tp / p', 6)} AS recall FROM {_CURVE_SQL}""",
)
def _w02(w):
    return stable(evaluate.precision_recall(evaluate.score_totals(scored(w), "label", "score_a")), 6)


def _auc_sql(score: str) -> str:
    return f"""(SELECT (sum(CASE WHEN label = 1 THEN rk END) - p * (p + 1) / 2) / (CAST(p AS DOUBLE) * n) AS auc FROM (
  SELECT label, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2 AS rk,
    sum(label) OVER () AS p, count(*) OVER () - sum(label) OVER () AS n FROM scored) GROUP BY p, n)"""


@key(
    "w03_rank_sum_auc",
    f"SELECT 'score_a' AS score, {r('auc', 6)} AS auc FROM {_auc_sql('score_a')} "
    f"UNION ALL SELECT 'score_b', {r('auc', 6)} FROM {_auc_sql('score_b')} "
    f"UNION ALL SELECT 'score_c', {r('auc', 6)} FROM {_auc_sql('score_c')}",
)
def _w03(w):
    """All three scores in one pass: one row per item and score, folded before any shuffle."""
    rows = scored(w).unpivot(["label"], ["score_a", "score_b", "score_c"], "name", "value")
    areas = evaluate.auc(evaluate.score_totals(rows, "label", "value", by="name"), by="name")
    return stable(areas.select(F.col("name").alias("score"), "auc"), 6)


# --- O ---------------------------------------------------------------------------------------


@key(
    "o01_order_by",
    "SELECT customer_id, customer_last_name, customer_segment, customer_zipcode FROM dim_customer",
)
def _o01(w):
    customers = w.table("dim_customer").select("customer_id", "customer_last_name", "customer_segment", "customer_zipcode")
    return customers.orderBy(F.asc_nulls_last("customer_segment"), F.desc_nulls_last("customer_id"))


@key(
    "o02_top_k",
    f"""SELECT product_card_id, {r('sum(sales)')} AS revenue FROM fact_order_items GROUP BY 1
ORDER BY sum(sales) DESC NULLS LAST, product_card_id LIMIT 15""",
)
def _o02(w):
    sums = w.table("fact_order_items").groupBy("product_card_id").agg(F.sum("sales").alias("revenue"))
    return stable(questions.top(sums, 15, "revenue", "product_card_id"))


@key("o03_preview_100", f"SELECT order_item_id, order_id, {r('sales')} AS sales FROM fact_order_items ORDER BY order_item_id LIMIT 100")
def _o03(w):
    head = preview(w.table("fact_order_items"), 100, by=["order_item_id"])
    return stable(head.select("order_item_id", "order_id", "sales"))


@key(
    "o04_highest_risk_50",
    f"""SELECT order_item_id, label, {r('score_a', 6)} AS prob_late, 1 AS predicted_late FROM scored WHERE score_a >= 0.5
ORDER BY score_a DESC, order_item_id LIMIT 50""",
)
def _o04(w):
    rows = scored(w).select("order_item_id", "label", F.col("score_a").alias("prob_late"))
    rows = rows.withColumn("predicted_late", (F.col("prob_late") >= 0.5).cast("int"))
    return stable(evaluate.highest_risk(rows, "prob_late", "order_item_id"), 6)


# --- F ---------------------------------------------------------------------------------------


@key(
    "f01_trim",
    "SELECT order_item_id, order_region_raw AS padded, order_region AS trimmed, _ingested_at FROM wide",
)
def _f01(w):
    return w.table("bronze_orders").select(
        src("Order Item Id").cast("bigint").alias("order_item_id"),
        src("Order Region").alias("padded"),
        trimmed(src("Order Region")).alias("trimmed"),
        "_ingested_at",
    )


@key(
    "f02_concat",
    "SELECT customer_id, customer_full_name, trim(customer_first_name || ' ' || trim(customer_last_name_raw)) AS strict_name, "
    "count(*) AS row_count FROM wide GROUP BY 1, 2, 3",
)
def _f02(w):
    strict = F.trim(F.concat(src("Customer Fname"), F.lit(" "), F.trim(src("Customer Lname"))))
    names = w.table("bronze_orders").groupBy(
        src("Customer Id").cast("bigint").alias("customer_id"),
        full_name(src("Customer Fname"), src("Customer Lname")).alias("customer_full_name"),
        strict.alias("strict_name"),
    )
    return names.agg(F.count(F.lit(1)).alias("row_count"))


@key("f03_coalesce", "SELECT DISTINCT customer_id, coalesce(trim(customer_last_name_raw), '') AS last_name FROM wide")
def _f03(w):
    return (
        w.table("bronze_orders")
        .select(
            src("Customer Id").cast("bigint").alias("customer_id"),
            F.coalesce(F.trim(src("Customer Lname")), F.lit("")).alias("last_name"),
        )
        .distinct()
    )


@key(
    "f04_nullif",
    f"SELECT order_item_id, {r('sales / nullif(order_item_quantity % 2, 0)')} AS guarded FROM stg_order_items",
)
def _f04(w):
    return stable(
        w.table("stg_order_items").select(
            "order_item_id", ratio(F.col("sales"), F.col("order_item_quantity") % 2).alias("guarded")
        )
    )


@key(
    "f05_round",
    f"""SELECT order_item_id, {r('order_item_product_price', 2)} AS price_2, {r('order_profit', 0)} AS profit_0,
  {r('order_item_profit_ratio * 3', 3)} AS ratio_3 FROM stg_order_items""",
)
def _f05(w):
    return w.table("stg_order_items").select(
        "order_item_id",
        round_to("order_item_product_price", 2).alias("price_2"),
        round_to("order_profit", 0).alias("profit_0"),
        round_to(F.col("order_item_profit_ratio") * 3, 3).alias("ratio_3"),
    )


@key(
    "f06_parse_time",
    """SELECT DISTINCT order_id, strptime(strftime(order_date, '%m/%d/%Y %H:%M'), '%m/%d/%Y %H:%M') AS order_date,
  strptime(strftime(shipping_date, '%m/%d/%Y %H:%M'), '%m/%d/%Y %H:%M') AS shipping_date FROM wide""",
)
def _f06(w):
    return (
        w.table("bronze_orders")
        .select(
            src("Order Id").cast("bigint").alias("order_id"),
            feed_time(src("order date (DateOrders)")).alias("order_date"),
            feed_time(src("shipping date (DateOrders)")).alias("shipping_date"),
        )
        .distinct()
    )


def _order_expr(name: str, sql: str, column, source: str = "order_date") -> None:
    @key(name, f"SELECT order_id, {sql} FROM stg_order")
    def _(w):
        return w.table("stg_order").select("order_id", *column(F.col(source)))


_order_expr(
    "f07_date_key",
    "CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key",
    lambda c: [date_key(c).alias("date_key")],
)
_order_expr(
    "f08_month_and_day_names",
    "strftime(order_date, '%B') AS month_name, strftime(order_date, '%A') AS day_name",
    lambda c: [F.date_format(c, "MMMM").alias("month_name"), F.date_format(c, "EEEE").alias("day_name")],
)
_order_expr(
    "f09_date_parts",
    "year(order_date) AS y, quarter(order_date) AS q, month(order_date) AS m, day(order_date) AS d",
    lambda c: [
        F.year(c).cast("bigint").alias("y"),
        F.quarter(c).cast("bigint").alias("q"),
        F.month(c).cast("bigint").alias("m"),
        F.dayofmonth(c).cast("bigint").alias("d"),
    ],
)
_order_expr(
    "f10_day_of_week",
    "dayofweek(order_date) AS day_of_week",
    lambda c: [sunday_based_day(c).cast("bigint").alias("day_of_week")],
)
_order_expr(
    "f11_iso_week",
    "weekofyear(order_date) AS week_of_year, year(order_date) AS calendar_year",
    lambda c: [F.weekofyear(c).cast("bigint").alias("week_of_year"), F.year(c).cast("bigint").alias("calendar_year")],
)
_order_expr(
    "f12_iso_day_of_week",
    "isodow(shipping_date) AS ship_day_of_week",
    lambda c: [iso_day(c).cast("bigint").alias("ship_day_of_week")],
    source="shipping_date",
)
_order_expr(
    "f13_month_quarter",
    "month(order_date) AS order_month, quarter(order_date) AS order_quarter",
    lambda c: [F.month(c).cast("bigint").alias("order_month"), F.quarter(c).cast("bigint").alias("order_quarter")],
)
_order_expr(
    "f14_hour",
    "hour(order_date) AS order_hour, CAST(hour(order_date) >= 18 OR hour(order_date) < 6 AS INTEGER) AS is_night",
    lambda c: [
        F.hour(c).cast("bigint").alias("order_hour"),
        ((F.hour(c) >= 18) | (F.hour(c) < 6)).cast("int").alias("is_night"),
    ],
)


@key("f15_date_series", "SELECT date_day FROM dim_date")
def _f15(w):
    return star.date_spine(w.table("stg_order"))


@key("f16_current_timestamp", "SELECT count(*) AS row_count, 1::BIGINT AS load_times FROM stg_customer")
def _f16(w):
    return w.table("stg_customer").agg(
        F.count("_loaded_at").alias("row_count"), F.countDistinct("_loaded_at").alias("load_times")
    )


@key(
    "f17_arithmetic",
    f"""SELECT order_item_id, {r('sales - order_item_discount_amount')} AS net, {r('order_profit / sales')} AS margin,
  order_item_quantity * 2 AS doubled, {r('order_item_quantity / 4')} AS quarter_quantity FROM stg_order_items""",
)
def _f17(w):
    return stable(
        w.table("stg_order_items").select(
            "order_item_id",
            (F.col("sales") - F.col("order_item_discount_amount")).alias("net"),
            (F.col("order_profit") / F.col("sales")).alias("margin"),
            (F.col("order_item_quantity") * 2).alias("doubled"),
            (F.col("order_item_quantity") / 4).alias("quarter_quantity"),
        )
    )


@key("f18_cast_double", f"SELECT order_id, {r('CAST(days_actual AS DOUBLE) / 7')} AS weeks FROM stg_order")
def _f18(w):
    return stable(w.table("stg_order").select("order_id", (F.col("days_actual").cast("double") / 7).alias("weeks")))


@key("f19_period_label", "SELECT date_key, substr(month_name, 1, 3) || ' ' || year AS period FROM dim_date")
def _f19(w):
    return w.table("dim_date").select("date_key", period_label("month_name", "year").alias("period"))


@key(
    "f20_lenient_number",
    "SELECT order_item_id, TRY_CAST(customer_zipcode_raw AS DOUBLE) AS zip_number, "
    "TRY_CAST(customer_segment AS DOUBLE) AS segment_number, _ingested_at FROM wide",
)
def _f20(w):
    return w.table("bronze_orders").select(
        src("Order Item Id").cast("bigint").alias("order_item_id"),
        lenient_double(src("Customer Zipcode")).alias("zip_number"),
        lenient_double(src("Customer Segment")).alias("segment_number"),
        "_ingested_at",
    )


@key("f21_md5", "SELECT customer_id, md5(customer_full_name) AS name_md5 FROM stg_customer")
def _f21(w):
    return w.table("stg_customer").select("customer_id", F.md5(F.col("customer_full_name").cast("binary")).alias("name_md5"))


@key(
    "f22_id_parts",
    """SELECT event_id, event_type AS last_part, 'shop' AS second_last_part FROM events""",
)
def _f22(w):
    dotted = F.concat(F.lit("model.shop."), F.col("event_type"))
    return w.source("events").select(
        "event_id", id_part(dotted, -1).alias("last_part"), id_part(dotted, -2).alias("second_last_part")
    )
