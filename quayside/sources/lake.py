"""Layer tables on shared storage, their views, profiles and parameterised SQL."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import LAYER_TABLES
from quayside.plans.models import MODELS
from quayside.sources import files
from quayside.sources.bronze import read_bronze
from quayside.sources.snapshots import Conflict, Snapshots

LAYER_OF = {name: layer for layer, names in LAYER_TABLES.items() for name in names}


class Lake:
    """Tables below one root folder, found through numbered snapshots; any process that knows the root finds the same tables.

    A build writes a new folder. `publish` makes all tables built since one new snapshot, so readers see all of them
    or none. Until then only this object sees them, so a failed build or test leaves the last good tables. Reading never builds.
    A lake opened `as_of` a snapshot reads that state and cannot publish.
    """

    def __init__(self, spark: SparkSession, root: str, as_of: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.snapshots = Snapshots(spark, self.root)
        self.as_of = as_of
        self._built: dict[str, str] = {}
        #: The tables when the first unpublished build was begun.
        self._base: dict[str, str] = {}

    def folder(self, name: str) -> str | None:
        """Where the table's files are: its unpublished build, else what the snapshot names."""
        return self._built.get(name) or self.snapshots.read(self.as_of)[1].get("tables", {}).get(name)

    def present(self, name: str) -> bool:
        return self.folder(name) is not None

    def pinned(self) -> Lake:
        """The lake as it is now, whatever is published later; with this object's builds."""
        lake = Lake(self.spark, self.root, self.snapshots.read(self.as_of)[0])
        lake._built = dict(self._built)
        return lake

    def attach_bronze(self, name: str, path: str) -> DataFrame:
        """Make a partitioned bronze folder readable by name."""
        if self.folder(name) != path:
            self.snapshots.commit(lambda _, state: state | {"tables": {**state.get("tables", {}), name: path}})
        return self.table(name)

    def store(self, name: str, df: DataFrame) -> DataFrame:
        """Write a build of the table; `publish` makes it the table."""
        if self.as_of is not None:
            raise ValueError("a lake opened as of a snapshot is read only")
        if not self._built:
            self._base = self.snapshots.read()[1].get("tables", {})
        path = f"{self.root}/{LAYER_OF.get(name, 'other')}/{name}/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        self._built[name] = path
        return self.table(name)

    def publish(self) -> list[str]:
        """Names of the builds that are the tables from now on, all by one snapshot.

        If another writer has published one of them since these were begun, nothing is published and Conflict is raised.
        """
        names = list(self._built)
        if not names:
            return names

        def change(_: int, state: dict) -> dict:
            tables = state.get("tables", {})
            taken = [n for n in names if tables.get(n) != self._base.get(n)]
            if taken:
                raise Conflict(f"published by another writer since: {', '.join(sorted(taken))}")
            return state | {"tables": {**tables, **self._built}}

        self.snapshots.commit(change)
        self._built.clear()
        return names

    def discard(self) -> None:
        """Forget the builds that were not published."""
        self._built.clear()

    def expire(self, keep: int = 10, unpublished_after: float = 7 * 86_400) -> list[str]:
        """Forget all but the last `keep` snapshots; delete builds that no kept snapshot names, and returns their folders.

        A build that was never published goes once it is older than `unpublished_after` seconds; bronze folders stay.
        """
        old = {path for state in self.snapshots.forget(keep) for path in state.get("tables", {}).values()}
        used = {path for n in self.snapshots.numbers() for path in self.snapshots.read(n)[1].get("tables", {}).values()}
        used |= set(self._built.values())
        gone = []
        for name in MODELS:
            folder = f"{self.root}/{LAYER_OF.get(name, 'other')}/{name}"
            for build in files.names(self.spark, folder):
                path = f"{folder}/{build}"
                stale = path in old or time.time() - files.modified(self.spark, path) > unpublished_after
                if path not in used and stale:
                    files.delete(self.spark, path)
                    gone.append(path)
        return gone

    def table(self, name: str) -> DataFrame:
        path = self.folder(name)
        if path is None:
            known = "it has not been built" if name in MODELS else f"known: {', '.join(sorted(MODELS))}"
            raise KeyError(f"no table named {name!r} in {self.root}; {known}")
        return read_bronze(self.spark, path) if name not in MODELS else self.spark.read.parquet(path)

    def rebuild(self, name: str) -> DataFrame:
        """Build one table anew from the tables below it."""
        return self.store(name, MODELS[name](self.table))


def save_managed(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Catalog table, at `path` when given."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def register_views(lake: Lake, layers: Sequence[str]) -> list[str]:
    """Views of one snapshot's tables."""
    names = [n for layer in layers for n in LAYER_TABLES[layer]]
    for name in names:
        lake.table(name)  # a lake that builds what is missing does so here
    pinned = lake.pinned()
    for name in names:
        pinned.table(name).createOrReplaceTempView(name)
    return names


def list_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def query(lake: Lake, sql: str, layers: Sequence[str] = (), params: Mapping | None = None) -> DataFrame:
    """Run SQL with `:name` parameters over the views of the given layers."""
    register_views(lake, layers)
    return lake.spark.sql(sql, args=dict(params or {}))


def load_table(lake: Lake, name: str) -> DataFrame:
    return lake.table(name)


def preview(df: DataFrame, rows: int = 100, by: Sequence[str] = ()) -> DataFrame:
    """First rows; ordered when `by` is given (a top-k, not a sort of the table)."""
    return (df.orderBy(*[F.asc_nulls_last(c) for c in by]) if by else df).limit(rows)


def profile(tables: Mapping[str, DataFrame], layer: str) -> DataFrame:
    """One row per table: rows, columns, ordered names and types, whether it holds any row."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("dataset_name"),
            F.lit(layer).alias("layer"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
            F.array(*[F.lit(c) for c in df.columns]).alias("column_names"),
            F.array(*[F.lit(f.dataType.simpleString()) for f in df.schema.fields]).alias("column_types"),
            (F.col("row_count") > 0).alias("has_rows"),
        )
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
