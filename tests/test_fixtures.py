"""The feed that stands in for the landed order files."""

from itertools import groupby

from pyspark.sql import functions as F

from quayside.fixtures import landed_order_feed, order_feed

DATA = "/root/testdata/sf0.001"


def test_a_task_gives_the_landed_rows_day_by_day(spark):
    """Rows in mixed order make a task jump between the files of all days at every row."""
    rows = landed_order_feed(spark, DATA).select(F.spark_partition_id().alias("task"), "ingested_date").collect()
    runs = [k for k, _ in groupby(rows, lambda r: (r["task"], r["ingested_date"]))]
    assert len({day for _, day in runs}) > 1
    assert len(runs) == len(set(runs))


def test_the_landed_feed_has_the_rows_of_the_feed(spark):
    feed = order_feed(spark, DATA)
    landed = landed_order_feed(spark, DATA).select(*[F.col(f"`{c}`") for c in feed.columns])
    assert landed.count() == feed.count()
    assert landed.exceptAll(feed).isEmpty()
