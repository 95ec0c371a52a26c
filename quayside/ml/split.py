"""Stratified, repeatable split of a training table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import ratio

SPLITS = ("train", "validation", "test")


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and negatives per positive."""
    y = F.col(label).cast("int")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(y).alias("positives"),
        (F.count(F.lit(1)) - F.sum(y)).alias("negatives"),
        ratio((F.count(F.lit(1)) - F.sum(y)).cast("double"), F.sum(y)).alias("class_ratio"),
    )


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    shares: Sequence[float] = (0.6, 0.2, 0.2),
    seed: int = 42,
    accuracy: int = 10_000,
) -> DataFrame:
    """Add `split`: each class is cut by the shares along a hash of the row key.

    The cuts are quantiles of the hash per class, two numbers each, so the class shares hold without
    ordering the rows of a class in one task, and the same rows get the same split on every run.
    """
    mark = F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))
    cut_at = [sum(shares[: i + 1]) for i in range(len(shares) - 1)]
    cuts = df.groupBy(label).agg(F.percentile_approx(mark, cut_at, accuracy).alias("cuts")).collect()
    split = F.lit(SPLITS[0])
    for row in cuts:
        first, second = row["cuts"]
        own = F.when(mark <= first, SPLITS[0]).when(mark <= second, SPLITS[1]).otherwise(SPLITS[2])
        split = F.when(F.col(label).eqNullSafe(F.lit(row[label])), own).otherwise(split)
    return df.withColumn("split", split)
