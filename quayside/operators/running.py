"""Totals and positions along a global order, without a window over the whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import kept

#: Distinct keys that one range holds on average.
RANGE_ROWS = 100_000


def ranged(totals: DataFrame, key: str) -> DataFrame:
    """`totals` with `_range`, a number that grows with the key; as many ranges as its rows ask for.

    Spark samples the keys and deals them out. The number of a row's range is stored with the row, so that a
    repeated task cannot cut the ranges elsewhere.
    """
    ranges = max(1, -(-totals.count() // RANGE_ROWS))
    dealt = totals.repartitionByRange(ranges, F.col(key).asc())
    return kept(dealt.withColumn("_range", F.spark_partition_id()), "ranges")


def running_totals(
    totals: DataFrame,
    key: str,
    measures: Sequence[str],
    descending: bool = False,
    partition: str | None = None,
    stored: bool = False,
) -> DataFrame:
    """Add `cum_<m>`: the total of each measure over this key and all before it.

    `totals` holds one row per (partition and) key, so a value that a third of all rows share is one
    row. Keys are cut into ranges; each range is summed on its own, and the totals of earlier ranges
    (a row per range and partition) are added on top. `totals` is stored first, unless it is `stored`.
    """
    group = [partition] if partition else []
    cut = ranged(totals if stored else kept(totals, "totals"), key)
    direction = F.desc if descending else F.asc
    before = Window.partitionBy(*group).orderBy(direction("_range")).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*group, "_range").orderBy(direction(key)).rowsBetween(Window.unboundedPreceding, 0)
    per_range = cut.groupBy(*group, "_range").agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    offsets = per_range.select(
        *group, "_range", *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_off_{m}") for m in measures]
    )
    summed = cut.select("*", *[F.sum(m).over(within).alias(f"_in_{m}") for m in measures])
    joined = summed.join(offsets, [*group, "_range"])
    return joined.select(
        *totals.columns, *[(F.col(f"_off_{m}") + F.col(f"_in_{m}")).alias(f"cum_{m}") for m in measures]
    )


def dense_codes(values: DataFrame, key: str, partition: str | None = None) -> DataFrame:
    """Sorted distinct non-NULL values numbered from 0 (per partition)."""
    distinct = values.filter(F.col(key).isNotNull()).select(*([partition] if partition else []), key).distinct()
    numbered = running_totals(distinct.withColumn("one", F.lit(1)), key, ["one"], partition=partition)
    return numbered.withColumn("code", (F.col("cum_one") - 1).cast("int")).drop("one", "cum_one")
