"""Connected components of links between nodes, as joins and folds of the links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import new_folder


def components(links: DataFrame) -> DataFrame:
    """node, root (its component's smallest node) for every node of `links` (a, b of any ordered type).

    Large-star and small-star steps by turns: a node hands its smallest neighbour to its larger ones, then to all that
    are not larger. Both keep the number of links linear and end with one star per component after a few turns. Every
    step folds a node's neighbours to their minimum on the map side, so a hub with very many links sends few rows
    to one task. Each turn's links are a written table, so that a lost executor costs at most one turn.
    """
    spark = links.sparkSession
    folder = new_folder(spark, "components")
    current = links.select("a", "b").filter("a <> b")
    turn, before = 0, None
    while True:
        path = f"{folder}/{turn}"
        current = _small_star(_large_star(current, f"{path}-large"), f"{path}-small")
        current.write.parquet(path)
        current = spark.read.parquet(path)
        after = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if after == before:
            break
        before, turn = after, turn + 1
    # The links are stars now: (member, root).
    roots = current.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _least(links: DataFrame, path: str) -> DataFrame:
    """Smallest neighbour of each node; stored, so that the join with it is of two plain shuffles and splits a hub."""
    links.groupBy("a").agg(F.min("b").alias("m")).write.parquet(path)
    return links.sparkSession.read.parquet(path)


def _large_star(links: DataFrame, path: str) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both, path).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame, path: str) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = _least(down, path)
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
