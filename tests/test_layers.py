"""Silver, star schema, marts and features on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.plans import features, marts, questions, silver, star


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_null_keys_drop_out(feed):
    assert silver.stg_order(feed([{"Order Id": None}, {}])).count() == 1
    assert silver.stg_customer(feed([{"Customer Id": None}])).count() == 0
    assert silver.stg_product(feed([{"Product Card Id": None}])).count() == 0
    assert silver.stg_department(feed([{"Department Id": None}])).count() == 0
    assert silver.stg_order_items(feed([{"Order Item Id": None}])).count() == 0


def test_ties_go_to_the_smallest_remaining_columns(feed):
    tied = feed([{"Customer Street": "9 Elm"}, {"Customer Street": "2 Oak"}, {"Customer Street": "5 Fir"}])
    assert only(silver.stg_customer(tied))["customer_street"] == "2 Oak"


def test_latest_load_wins(feed):
    rows = feed([
        {"Sales": "1.0", "_ingested_at": "2024-01-02 00:00:00"},
        {"Sales": "2.0", "_ingested_at": "2024-01-03 00:00:00"},
        {"Sales": "3.0", "_ingested_at": "2024-01-01 00:00:00"},
    ])
    assert only(silver.stg_order_items(rows))["sales"] == 2.0


def test_customer_cleaning(feed):
    row = only(silver.stg_customer(feed([{"Customer Fname": " Ann ", "Customer Lname": None, "Customer Zipcode": "  "}])))
    assert (row["customer_full_name"], row["customer_last_name"], row["customer_zipcode"]) == ("Ann", "", "Unknown")


@pytest.mark.parametrize(
    "actual, scheduled, label, late, violation, diff",
    [
        ("5", "3", "0", 1, True, 2),
        ("5", "3", "1", 1, False, 2),
        ("2", "3", "1", 0, False, -1),
        (None, "3", "0", 0, False, None),
        ("3", "3", "0", 0, False, 0),
        ("5", "3", None, 1, False, 2),
    ],
)
def test_late_flags(feed, actual, scheduled, label, late, violation, diff):
    row = only(silver.stg_order(feed([{
        "Days for shipping (real)": actual,
        "Days for shipment (scheduled)": scheduled,
        "Late_delivery_risk": label,
    }])))
    assert (row["is_actual_late"], row["is_label_violation"], row["days_diff"]) == (late, violation, diff)


def test_bad_dates_raise_or_go_to_the_reject_table(feed):
    rows = feed([{"order date (DateOrders)": "13/31/2018 22:56"}, {"Order Id": "101"}])
    with pytest.raises(Exception):
        silver.stg_order(rows).collect()
    assert silver.unreadable_orders(rows).count() == 1
    lenient = {r["order_id"]: r["order_date"] for r in silver.stg_order(rows, lenient=True).collect()}
    assert lenient == {100: None, 101: dt.datetime(2018, 1, 1, 12, 30)}


def test_product_status(feed):
    rows = feed([
        {"Product Card Id": "1", "Product Status": "1"},
        {"Product Card Id": "2", "Product Status": "0"},
        {"Product Card Id": "3", "Product Status": None},
    ])
    labels = {r["product_card_id"]: r["product_status_label"] for r in silver.stg_product(rows).collect()}
    assert labels == {1: "Active", 2: "Inactive", 3: "Inactive"}


def test_calendar_includes_the_last_day(feed):
    """The shipment's time of day is before the order's, yet its date belongs to the calendar."""
    days = star.dim_date(silver.stg_order(feed([{}]))).orderBy("date_key").collect()
    assert [r["date_key"] for r in days] == [20180101, 20180102, 20180103, 20180104, 20180105]
    assert (days[0]["month_name"], days[0]["day_name"], days[0]["day_of_week"], days[0]["quarter"]) == (
        "January",
        "Monday",
        1,
        1,
    )


def test_calendar_has_no_gaps(lake):
    row = lake.table("dim_date").agg(
        F.count("*").alias("n"), F.datediff(F.max("date_day"), F.min("date_day")).alias("span")
    ).first()
    assert row["n"] == row["span"] + 1


@pytest.fixture(scope="module")
def small_star(spark, feed):
    """Two orders, three items, and one item whose order is unknown."""
    rows = feed([
        {"Order Item Id": "1", "Order Id": "100", "Sales": "10.0", "Order Profit Per Order": "1.0"},
        {"Order Item Id": "2", "Order Id": "100", "Sales": "30.0", "Order Profit Per Order": "-2.0"},
        {
            "Order Item Id": "3",
            "Order Id": "101",
            "Sales": "5.0",
            "Order Profit Per Order": "2.0",
            "Days for shipping (real)": "9",
            "Late_delivery_risk": "1",
        },
    ])
    orders = silver.stg_order(rows)
    orphan = feed([{"Order Item Id": "4", "Order Id": "999", "Sales": "7.0", "Order Profit Per Order": "0.0"}])
    no_order = feed([{"Order Item Id": "5", "Order Id": None, "Sales": "2.0", "Order Profit Per Order": "0.0"}])
    items = silver.stg_order_items(rows.unionByName(orphan).unionByName(no_order))
    products = star.dim_product(silver.stg_product(rows), silver.stg_department(rows))
    return {
        "fact": star.fact_order_items(items, orders),
        "orders": star.dim_order(orders),
        "dates": star.dim_date(orders),
        "products": products,
        "customers": star.dim_customer(silver.stg_customer(rows)),
    }


def test_orphan_items_stay_in_the_fact(small_star):
    rows = {r["order_item_id"]: r for r in small_star["fact"].collect()}
    assert rows[4]["customer_id"] is None and rows[4]["order_date_key"] is None
    assert rows[1]["order_date_key"] == 20180101 and rows[1]["shipping_date_key"] == 20180105
    assert len(rows) == 5


def test_executive_summary(small_star):
    s = small_star
    rows = {r["order_region"]: r for r in marts.mart_executive_summary(s["fact"], s["orders"], s["products"]).collect()}
    row = rows["South America"]
    assert (row["total_orders"], row["total_sales"], row["total_profit"]) == (2, 45.0, 1.0)
    assert row["profit_margin_pct"] == 2.22
    assert rows[None]["total_orders"] == 1 and rows[None]["total_sales"] == 9.0


def test_monthly_trend_counts_an_order_once_in_the_delay(small_star):
    s = small_star
    rows = {r["month"]: r for r in marts.mart_trend_monthly(s["fact"], s["dates"], s["orders"]).collect()}
    assert (rows[1]["total_orders"], rows[1]["total_sales"]) == (2, 45.0)
    assert rows[1]["avg_delay"] == pytest.approx((-1 + 5) / 2)
    # Items outside the calendar: one known order id, no delay.
    assert (rows[None]["total_orders"], rows[None]["total_sales"], rows[None]["avg_delay"]) == (1, 9.0, None)


def test_customer_profile(small_star):
    s = small_star
    rows = {r["customer_id"]: r for r in features.feat_customer(s["fact"], s["orders"], s["customers"]).collect()}
    assert (rows[11]["total_orders"], rows[11]["avg_days_late"], rows[11]["late_delivery_rate"]) == (2, 2.0, 0.5)
    assert rows[11]["is_cross_border"] == 1
    assert rows[None]["total_orders"] == 1 and rows[None]["is_cross_border"] == 0


def test_feature_table_drops_orphans_and_has_32_columns(small_star):
    s = small_star
    table = features.feat_delivery_risk(s["fact"], s["orders"], s["products"], s["customers"])
    assert len(table.columns) == 32 and table.count() == 3


def _feature(feed, **values):
    rows = feed([values])
    orders = silver.stg_order(rows)
    fact = star.fact_order_items(silver.stg_order_items(rows), orders)
    products = star.dim_product(silver.stg_product(rows), silver.stg_department(rows))
    customers = star.dim_customer(silver.stg_customer(rows))
    return only(features.feat_delivery_risk(fact, star.dim_order(orders), products, customers))


def test_zero_divisors(feed):
    row = _feature(feed, **{"Sales": "0", "Order Item Quantity": "0"})
    assert row["profit_margin"] is None and row["unit_price"] is None


@pytest.mark.parametrize("clock, night", [("05:59", 1), ("06:00", 0), ("17:59", 0), ("18:00", 1)])
def test_night_orders(feed, clock, night):
    assert _feature(feed, **{"order date (DateOrders)": f"1/1/2018 {clock}"})["is_night_order"] == night


def test_weekend_and_cross_border(feed):
    row = _feature(feed, **{
        "order date (DateOrders)": "1/7/2018 10:00",
        "shipping date (DateOrders)": "1/7/2018 11:00",
        "Customer Country": None,
    })
    assert (row["is_weekend"], row["ship_day_of_week"], row["is_cross_border"]) == (1, 7, None)


def test_mart_totals_equal_fact_totals(lake):
    fact = lake.table("fact_order_items").agg(F.sum("sales").alias("s"), F.count("*").alias("n")).first()
    for mart in (
        "mart_executive_summary",
        "mart_product_category_sales",
        "mart_trend_monthly",
        "mart_customer_segment_revenue",
    ):
        assert lake.table(mart).agg(F.sum("total_sales")).first()[0] == pytest.approx(fact["s"])
    buckets = lake.table("mart_product_discount_impact_by_category").agg(F.sum("order_item_count")).first()[0]
    assert buckets == fact["n"]
    orders = lake.table("dim_order").count()
    assert lake.table("mart_supply_chain_shipping_mode").agg(F.sum("total_orders")).first()[0] == orders


def test_kpis_of_no_region_are_zero(lake):
    row = questions.kpi_totals(lake.table("mart_executive_summary"), ["nowhere"]).first()
    assert (row["total_sales"], row["total_orders"], row["profit_margin_pct"]) == (0, 0, 0)


def test_summing_the_mart_counts_shared_orders_twice(lake):
    mart = {r["order_region"]: r["total_orders"] for r in questions.orders_by_region(lake.table("mart_executive_summary")).collect()}
    exact = {r["order_region"]: r["total_orders"] for r in marts.region_orders_exact(lake.table("fact_order_items"), lake.table("dim_order")).collect()}
    assert mart.keys() == exact.keys() and all(mart[r] >= exact[r] for r in mart) and sum(mart.values()) > sum(exact.values())
