import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside import functions as fn


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, expected",
    [("2.5", 3), ("3.5", 4), ("-2.5", -3), ("17.0", 17), ("0", 0), ("-8", -8), (None, None), ("2.4999", 2)],
)
def test_text_to_integer(spark, text, expected):
    assert one(spark, fn.text_to_int("x"), text) == expected
    assert one(spark, fn.text_to_bigint("x"), text) == expected


def test_long_keys_keep_every_digit(spark):
    assert one(spark, fn.text_to_bigint("x"), "9007199254740993") == 9007199254740993
    assert one(spark, fn.text_to_bigint("x"), "-9223372036854775807") == -9223372036854775807


def test_text_that_is_no_number_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, fn.text_to_int("x"), "abc")


@pytest.mark.parametrize("value, expected", [(2.5, 2), (3.5, 4), (-2.5, -2), (2.6, 3), (None, None)])
def test_double_to_int_is_half_even(spark, value, expected):
    assert one(spark, fn.double_to_int("x"), value, "double") == expected


def test_trim_takes_blanks_only(spark):
    assert one(spark, fn.trimmed("x"), "  West of USA ") == "West of USA"
    assert one(spark, fn.trimmed("x"), "\tWest ") == "\tWest"


@pytest.mark.parametrize("text, expected", [("  ", "Unknown"), (None, "Unknown"), (" 725 ", "725")])
def test_blank_to_unknown(spark, text, expected):
    assert one(spark, fn.blank_to_unknown("x"), text) == expected


def test_full_name(spark):
    rows = spark.createDataFrame([(" Ann ", None), (None, "Lee"), ("Ann", " Lee ")], "f string, l string")
    assert [r[0] for r in rows.select(fn.full_name("f", "l")).collect()] == ["Ann", None, "Ann Lee"]


@pytest.mark.parametrize(
    "rate, bucket",
    [
        (0.0, "0%"),
        (0.1, "1-10%"),
        (0.100000001, "11-20%"),
        (0.2, "11-20%"),
        (0.3, "21-30%"),
        (0.31, "31%+"),
        (None, "31%+"),
        (-0.05, "1-10%"),
    ],
)
def test_discount_bucket(spark, rate, bucket):
    assert one(spark, fn.discount_bucket("x"), rate, "double") == bucket


def test_feed_time(spark):
    assert one(spark, fn.feed_time("x"), "1/31/2018 22:56") == dt.datetime(2018, 1, 31, 22, 56)
    assert one(spark, fn.feed_time("x"), "01/05/2018 09:05") == dt.datetime(2018, 1, 5, 9, 5)
    assert one(spark, fn.feed_time("x", lenient=True), "13/31/2018 22:56") is None
    with pytest.raises(Exception):
        one(spark, fn.feed_time("x"), "13/31/2018 22:56")


def test_calendar_numbers(spark):
    sunday = dt.date(2018, 1, 7)
    assert one(spark, fn.sunday_based_day("x"), sunday, "date") == 0
    assert one(spark, fn.iso_day("x"), sunday, "date") == 7
    assert one(spark, fn.date_key("x"), sunday, "date") == 20180107
    assert one(spark, F.weekofyear("x"), dt.date(2018, 12, 31), "date") == 1


def test_round_to_is_not_moved_by_float_noise(spark):
    assert one(spark, fn.round_to("x", 2), 1.005, "double") == 1.01
    assert one(spark, fn.round_to("x", 2), -1.005, "double") == -1.01
    assert one(spark, fn.round_to("x", 3), 2.0005, "double") == 2.001


def test_ratio_over_zero_is_null(spark):
    assert one(spark, fn.ratio(F.lit(1.0), F.col("x")), 0.0, "double") is None


def test_id_part(spark):
    assert one(spark, fn.id_part("x", -1), "model.shop.orders") == "orders"
    assert one(spark, fn.id_part("x", -2), "test.shop.unique_orders.abc") == "unique_orders"
    assert one(spark, fn.id_part("x", -2), "alone") is None


def test_lenient_double(spark):
    assert one(spark, fn.lenient_double("x"), "1.5") == 1.5
    assert one(spark, fn.lenient_double("x"), "n/a") is None


def test_flag_text(spark):
    assert [one(spark, fn.text_to_flag("x"), v) for v in ("1", "0", "1.0", "true", None)] == [True, False, True, True, None]
