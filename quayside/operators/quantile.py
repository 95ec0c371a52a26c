"""Exact medians of many columns without sorting the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.running import running_totals

# Error of the sketch as a share of the rows.
ACCURACY = 10_000


def exact_medians(df: DataFrame, columns: Sequence[str], accuracy: int = ACCURACY) -> dict[str, float | None]:
    """Exact median (mean of the two middle values) of every numeric column, NULLs ignored.

    Pass one takes approximate quantiles a little under and over the middle; their rank error is
    bounded, so they bracket it. Pass two counts the rows under the bracket and keeps the distinct
    values inside, a `4 / accuracy` share of the rows: only those are ordered.
    """
    if not columns:
        return {}
    # The sketch is off by at most n / accuracy ranks; twice that on both sides holds the middle.
    margin = 2.0 / accuracy
    low, high = max(0.0, 0.5 - margin), min(1.0, 0.5 + margin)
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    sketched = doubles.agg(
        *[F.percentile_approx(c, [low, high], accuracy).alias(f"{c}__q") for c in columns],
        *[F.count(c).alias(f"{c}__n") for c in columns],
    ).first()
    bracket = {c: sketched[f"{c}__q"] for c in columns if sketched[f"{c}__n"]}
    if not bracket:
        return dict.fromkeys(columns)
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("name"),
                F.lit(lo).alias("lo"),
                F.lit(hi).alias("hi"),
                F.col(c).alias("value"),
            )
            for c, (lo, hi) in bracket.items()
        ]
    )
    long = (
        doubles.select(F.explode(entries).alias("e"))
        .select("e.*")
        .filter(F.col("value").isNotNull() & (F.col("value") <= F.col("hi")))
    )
    # Values under the bracket share one row per column, NULL standing for all of them.
    counted = (
        long.groupBy("name", F.when(F.col("value") >= F.col("lo"), F.col("value")).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .checkpoint()
    )
    below = {r["name"]: r["rows"] for r in counted.filter("value IS NULL").select("name", "rows").collect()}
    placed = running_totals(counted.filter("value IS NOT NULL"), "value", ["rows"], partition="name")

    def per_column(values: dict):
        return F.create_map(*[x for c in bracket for x in (F.lit(c), F.lit(int(values.get(c, 0))))])[F.col("name")]

    total = per_column({c: sketched[f"{c}__n"] for c in bracket})
    last = F.col("cum_rows") + per_column(below)

    def value_at(rank):
        return F.max(F.when((last - F.col("rows") < rank) & (rank <= last), F.col("value")))

    middle = (value_at(F.floor((total + 1) / 2)) + value_at(F.floor(total / 2) + 1)) / 2
    found = {r["name"]: r["median"] for r in placed.groupBy("name").agg(middle.alias("median")).collect()}
    if any(found.get(c) is None for c in bracket):
        raise ArithmeticError("the approximate quantiles do not bracket the median; lower `accuracy`")
    return {c: found.get(c) for c in columns}
