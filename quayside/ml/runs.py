"""Training-run records: long-format metrics, run history, the production version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import round_to
from quayside.sources import files

METRICS = ("accuracy", "precision", "recall", "f1", "auc")
SCHEMA = "run_id string, version int, start_time timestamp, model string, metric string, value double"
PARAMETER_SCHEMA = "run_id string, name string, value string"


def run_rows(spark: SparkSession, run_id: str, version: int, start_time, metrics: Sequence[dict]) -> DataFrame:
    """Long format: one row per model and metric, rounded to 4 digits."""
    rows = [(run_id, version, start_time, m["model"], k, m[k]) for m in metrics for k in METRICS]
    return spark.createDataFrame(rows, SCHEMA).withColumn("value", round_to("value", 4))


def parameter_rows(spark: SparkSession, run_id: str, parameters: Mapping[str, str]) -> DataFrame:
    """Row counts, feature counts, cutoff and best model of a run."""
    return spark.createDataFrame([(run_id, k, v) for k, v in parameters.items()], PARAMETER_SCHEMA)


def append_run(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def next_version(spark: SparkSession, path: str) -> int:
    if not files.exists(spark, path):
        return 1
    return (spark.read.schema(SCHEMA).parquet(path).agg(F.max("version")).first()[0] or 0) + 1


def run_history(log: DataFrame, runs: int = 50, by: Sequence[str] = ("run_id", "version", "start_time", "model")) -> DataFrame:
    """Wide metrics of the latest runs; rows without any metric drop out."""
    last = log.select("run_id", "start_time").distinct().orderBy(F.desc("start_time"), F.asc("run_id")).limit(runs)
    recent = log.join(last.select("run_id"), "run_id", "left_semi")
    wide = recent.groupBy(*by).pivot("metric", list(METRICS)).agg(F.max("value"))
    return wide.dropna(how="all", subset=list(METRICS))


def production_version(log: DataFrame) -> DataFrame:
    """The run with the highest version."""
    return log.agg(F.max_by(F.struct("run_id", "version", "start_time"), "version").alias("r")).select("r.*")
