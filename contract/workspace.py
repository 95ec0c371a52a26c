"""One lake per session and test folder: bronze is derived from the test tables, the rest on demand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.fixtures import landed_clickstream, landed_order_feed
from quayside.plans.models import MODELS
from quayside.session import apply_settings, new_folder
from quayside.sources.bronze import write_bronze
from quayside.sources.lake import Lake


class Workspace(Lake):
    """A lake whose bronze tables come from the test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, new_folder(spark, "lake"))
        self.sf_dir = sf_dir

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        """The table; one that is missing is built first, with those it reads."""
        feeds = {"bronze_orders": landed_order_feed, "bronze_clickstream": landed_clickstream}
        if not self.present(name):
            if name in feeds:
                path = f"{self.root}/bronze/{name}"
                write_bronze(feeds[name](self.spark, self.sf_dir), path)
                self.attach_bronze(name, path)
            elif name in MODELS:
                self.rebuild(name)
                self.publish()
        return super().table(name)

    def scratch(self, label: str) -> str:
        return new_folder(self.spark, label)


_OPEN: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        apply_settings(spark)
        _OPEN[key] = Workspace(spark, sf_dir)
    return _OPEN[key]
