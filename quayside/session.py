"""Spark session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the aggregate above then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot never compiles a method above 8000 bytes of code. The wide projections here exceed
    # that when fused into one method; past this limit Spark generates them in small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task that writes partitioned folders keeps up to so many files open; only one with more folders sorts its rows by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # Rows go to Python in batches of so many bytes, however long their texts are.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # Shuffle files go when their query ends, not when the driver happens to collect garbage: a build of many tables would keep them all.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# Set when the context starts, never later.
STATIC = {
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "quayside", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    workspace_root(spark)
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Bring a session made elsewhere to the settings the library expects."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    workspace_root(spark)
    return spark


def workspace_root(spark: SparkSession) -> str:
    """Folder that driver and executors share, named by `spark.checkpoint.dir`.

    Only a local session that names none gets a temporary folder: on a cluster a folder of one
    machine would be lost with that machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not current:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="quayside-")
    context.setCheckpointDir(root)
    return root


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder in columns; a checkpoint keeps rows as they are in memory, several times the bytes."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever written over."""
    return f"{workspace_root(spark)}/quayside/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
