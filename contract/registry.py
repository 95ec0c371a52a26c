"""Query keys and their oracle SQL, side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contract.oracle import with_tables
from contract.workspace import Workspace, workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def key(name: str, sql: str | None = None):
    """Register a function of a workspace under a query key."""

    def register(fn: Callable[[Workspace], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(workspace(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_tables(sql)
        return fn

    return register
