"""Preprocessing: impute, standardise, encode. Fitted on training rows, applied anywhere."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.quantile import exact_medians
from quayside.operators.running import dense_codes
from quayside.session import new_folder

UNKNOWN = "Unknown"


def imputed(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()})


def population_scale(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column; a constant column keeps scale 1."""
    row = df.agg(
        *[F.avg(c).alias(f"{c}__m") for c in columns], *[F.stddev_pop(c).alias(f"{c}__s") for c in columns]
    ).first()
    return {c: (row[f"{c}__m"] or 0.0, row[f"{c}__s"] or 1.0) for c in columns}


def standardised(df: DataFrame, scale: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scale.items()})


def ordinal_codes(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, value, code: sorted distinct training values per column, numbered from 0."""
    filled = train.select(*[F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c) for c in columns])
    # Folded per row set first: each value of each column travels once per map task.
    values = filled.unpivot([], list(columns), "column_name", "value").distinct()
    return dense_codes(values, "value", partition="column_name")


def encode(df: DataFrame, column: str, codes: Mapping | DataFrame, output: str) -> DataFrame:
    """Join the codes of one column; values not seen in training become -1."""
    own = codes.filter(F.col("column_name") == column).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    joined = df.join(own, F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(UNKNOWN)) == F.col("_value"), "left")
    return joined.withColumn(output, F.coalesce("_code", F.lit(-1))).drop("_value", "_code")


@dataclass
class Preprocessor:
    """Raw columns to `features`, one slot per column in the given order, as fitted on training rows.

    Numbers: median for NULL, then (x - mean) / population sigma. Text: 'Unknown' for NULL, then the position among
    the sorted training values, -1 for values not seen. The codes are a table that is joined, so a column may have any
    number of values.
    """

    numeric: list[str]
    text: list[str]
    medians: dict[str, float]
    scale: dict[str, tuple[float, float]]
    codes: DataFrame | None

    def transform(self, df: DataFrame) -> DataFrame:
        """All columns of `df` and `features`."""
        slots = []
        for c in self.numeric:
            mean, sigma = self.scale[c]
            number = F.coalesce(F.col(f"`{c}`").try_cast("double"), F.lit(self.medians[c]))
            slots.append((number - F.lit(mean)) / F.lit(sigma))
        coded = df
        for c in self.text:
            coded = encode(coded, c, self.codes, f"{c}__code")
            slots.append(F.col(f"`{c}__code`").cast("double"))
        return coded.select(*[F.col(f"`{c}`") for c in df.columns], array_to_vector(F.array(*slots)).alias("features"))

    def settings(self) -> dict:
        return {"numeric": self.numeric, "text": self.text, "medians": self.medians, "scale": self.scale}


def fit_preprocessor(train: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> Preprocessor:
    medians = {c: (m if m is not None else 0.0) for c, m in exact_medians(train, numeric).items()}
    scale = population_scale(imputed(train.select(*numeric), medians), numeric) if numeric else {}
    codes = None
    if text:
        # A stored table has a size that Spark knows when it plans the joins.
        path = new_folder(train.sparkSession, "codes")
        ordinal_codes(train, text).write.parquet(path)
        codes = train.sparkSession.read.parquet(path)
    return Preprocessor(list(numeric), list(text), medians, scale, codes)


def prepared(model: Preprocessor, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return model.transform(df).select(*keep, "features")
