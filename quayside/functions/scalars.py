"""Column expressions shared by all layers. Every one stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "round_to", "stable", "text_to_int", "text_to_bigint", "double_to_int", "text_to_flag",
    "trimmed", "blank_to_unknown", "full_name", "feed_time", "date_key", "sunday_based_day",
    "iso_day", "ratio", "flag", "flag_sum", "flag_rate", "discount_bucket", "period_label",
    "id_part", "lenient_double",
]

FEED_TIME_FORMAT = "M/d/yyyy H:mm"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to(c: Column | str, digits: int) -> Column:
    """Half away from zero on the decimal value, so float noise next to a tie does not decide."""
    return F.round(_col(c).cast("decimal(28,8)"), digits).cast("double")


def stable(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column; sums of doubles depend on the order rows arrive in."""
    doubles = {
        f.name: round_to(F.col(f"`{f.name}`"), digits)
        for f in df.schema.fields
        if isinstance(f.dataType, T.DoubleType)
    }
    return df.withColumns(doubles) if doubles else df


def _whole(d: Column) -> Column:
    # Rounding a double goes through a decimal; values that are whole already skip it.
    return F.when(d == F.rint(d), d).otherwise(F.round(d))


def text_to_int(c: Column | str) -> Column:
    """Text to integer; '2.5' becomes 3 (half away from zero), text that is no number raises."""
    return _whole(_col(c).cast("double")).cast("int")


def text_to_bigint(c: Column | str) -> Column:
    """Like `text_to_int`; keys too long for a double are read as integers, so they keep all digits."""
    c = _col(c)
    d = c.cast("double")
    whole = _whole(d).cast("bigint")
    return F.when(F.abs(d) < 2.0**53, whole).otherwise(F.coalesce(c.try_cast("bigint"), whole))


def double_to_int(c: Column | str) -> Column:
    """Double to integer, half to even: 2.5 becomes 2, 3.5 becomes 4."""
    return F.bround(_col(c)).cast("int")


def text_to_flag(c: Column | str) -> Column:
    c = _col(c)
    return F.coalesce(c.try_cast("boolean"), text_to_int(c) != 0)


def trimmed(c: Column | str) -> Column:
    """Blanks off both ends; tabs and line ends stay."""
    return F.trim(_col(c))


def blank_to_unknown(c: Column | str) -> Column:
    return F.coalesce(F.nullif(F.trim(_col(c).cast("string")), F.lit("")), F.lit("Unknown"))


def full_name(first: Column | str, last: Column | str) -> Column:
    """NULL when the first name is NULL; a missing last name counts as empty."""
    return F.trim(F.concat(F.trim(_col(first)), F.lit(" "), F.coalesce(F.trim(_col(last)), F.lit(""))))


def feed_time(c: Column | str, lenient: bool = False) -> Column:
    """'1/31/2018 22:56' to a timestamp without zone; `lenient` gives NULL instead of an error."""
    c = _col(c)
    if lenient:
        return F.try_to_timestamp(c, F.lit(FEED_TIME_FORMAT)).cast("timestamp_ntz")
    return F.to_timestamp_ntz(c, F.lit(FEED_TIME_FORMAT))


def date_key(c: Column | str) -> Column:
    c = _col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def sunday_based_day(c: Column | str) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(_col(c)) - 1


def iso_day(c: Column | str) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(_col(c)) + 1


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is NULL over zero."""
    return top / F.nullif(bottom, F.lit(0))


def flag(condition: Column) -> Column:
    """1 or 0; a condition that is NULL counts as 0."""
    return F.when(condition, 1).otherwise(0)


def flag_sum(condition: Column) -> Column:
    return F.sum(flag(condition))


def flag_rate(condition: Column, digits: int = 3) -> Column:
    return round_to(ratio(flag_sum(condition).cast("double"), F.count(F.lit(1))), digits)


def discount_bucket(rate: Column | str) -> Column:
    """Literal bounds: 0.100000001 is above 10 %, NULL falls through, negatives are below 10 %."""
    r = _col(rate)
    return (
        F.when(r == 0, "0%")
        .when(r <= 0.10, "1-10%")
        .when(r <= 0.20, "11-20%")
        .when(r <= 0.30, "21-30%")
        .otherwise("31%+")
    )


def period_label(month_name: Column | str, year: Column | str) -> Column:
    return F.concat(F.substring(_col(month_name), 1, 3), F.lit(" "), _col(year).cast("string"))


def id_part(dotted: Column | str, position: int) -> Column:
    """Part of a dotted id counted from the end (-1 = last); NULL when there are fewer parts."""
    return F.try_element_at(F.split(_col(dotted), r"\."), F.lit(position))


def lenient_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")
