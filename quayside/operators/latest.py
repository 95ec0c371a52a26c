"""Latest-row de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _age(df: DataFrame, order: str) -> Column | None:
    """Number that is smallest for the latest row and greatest for NULL; None if the type has none."""
    kind = df.schema[order].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        value = F.unix_micros(F.col(order).cast("timestamp"))
    elif kind == "date":
        value = F.unix_date(order).cast("bigint")
    elif kind in ("byte", "short", "integer", "long"):
        value = F.col(order).cast("bigint")
    else:
        return None
    return F.coalesce(-value, F.lit(2**63 - 1))


def latest_rows(df: DataFrame, keys: Sequence[str], order: str, keep_order: bool = False) -> DataFrame:
    """One row per key: the greatest `order`, NULL last; ties go to the smallest remaining columns.

    One aggregation, `min` of the struct (age, remaining columns). Map tasks sort by the key alone and
    send one row per key, so a key that holds a third of all rows costs no more than any other.
    """
    age = _age(df, order)
    if age is None:
        return latest_rows_by_window(df, keys, order, keep_order)
    rest = [c for c in df.columns if c not in keys and c != order]
    carried = [*rest, order] if keep_order else rest
    best = F.min(F.struct(age.alias("_age"), *[F.col(f"`{c}`") for c in carried])).alias("_best")
    wanted = [c for c in df.columns if keep_order or c != order]
    return (
        df.groupBy(*keys)
        .agg(best)
        .select(*[F.col(f"`{c}`") if c in keys else F.col(f"_best.`{c}`").alias(c) for c in wanted])
    )


def latest_rows_by_window(df: DataFrame, keys: Sequence[str], order: str, keep_order: bool = False) -> DataFrame:
    """The same rows through `row_number() = 1`, for an `order` of any type.

    Spark plans a group limit below the shuffle, so here too each map task sends one row per key; it
    sorts by all columns to find it.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    window = Window.partitionBy(*keys).orderBy(
        F.col(order).desc_nulls_last(), *[F.col(f"`{c}`").asc_nulls_first() for c in rest]
    )
    latest = df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")
    return latest if keep_order else latest.drop(order)


def latest_attributes(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """`latest_rows` where the whole table holds few distinct rows besides `order` (departments).

    Equal rows collapse into their greatest `order` first: a hash aggregation with a fixed-width
    buffer, so the map tasks sort nothing and only the distinct rows are shuffled.
    """
    attributes = [c for c in df.columns if c != order]
    collapsed = df.groupBy(*[F.col(f"`{c}`") for c in attributes]).agg(F.max(order).alias(order))
    return latest_rows(collapsed, keys, order)
