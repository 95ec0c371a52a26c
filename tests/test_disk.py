"""What a query leaves on disk, and what it sends through it."""

from pyspark.sql import functions as F

from contract import keys_ml
from quayside.fixtures import typed_feed
from quayside.ml import boosting, forest
from quayside.session import SETTINGS, new_folder, workspace_root
from quayside.sources import files
from quayside.sources.lake import Lake

SF_DIR = "/root/testdata/sf0.001"


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toList()
    return {name for i in range(blocks.size()) if (name := blocks.apply(i).getName()).startswith("shuffle_")}


def test_shuffle_files_go_with_their_query(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    before = shuffle_files(spark)
    sums = spark.range(10_000).groupBy((F.col("id") % 10).alias("k")).agg(F.sum("id").alias("v"))
    first = sorted(sums.collect())
    assert shuffle_files(spark) <= before
    # A frame that is asked again makes them again.
    assert sorted(sums.collect()) == first and len(first) == 10


def test_tables_of_a_lake_are_packed(spark):
    lake = Lake(spark, new_folder(spark, "packed"))
    lake.store("dim_date", spark.range(10))
    names = [n for n in files.names(spark, lake.folder("dim_date")) if n.endswith(".parquet")]
    assert names and all(".zstd." in n for n in names)


def test_lines_are_shuffled_twice(spark):
    """Once for the parts, once for the orders, when nothing but the nations is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        plan = typed_feed(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    keys = [next(k for k in ("destination", "c_nationkey", "l_orderkey", "o_custkey", "l_partkey") if k in line) for line in joins if "r_regionkey" not in line]
    above_lines = [k for k in keys if k.startswith("l_")]
    assert above_lines == ["l_orderkey", "l_partkey"] and sorted(keys) == ["c_nationkey", "destination", "l_orderkey", "l_partkey", "o_custkey"]


def test_a_fit_by_jobs_leaves_its_trees_alone(spark, monkeypatch):
    for name, value in (("PARTITION_ROWS", 100), ("KEEP_ROUNDS", 2)):
        monkeypatch.setattr(boosting, name, value)
    rows = [(bytearray([i % 7, i % 5]), float(i % 7 > 3), 1.0, i) for i in range(300)]
    bins = spark.createDataFrame(rows, boosting.BINNED_SCHEMA).repartition(3)
    cuts, folder = [[float(k) for k in range(6)], [float(k) for k in range(4)]], new_folder(spark, "fit")
    model = boosting.fit_boosted(bins, cuts, boosting.Boosting(5, 0.3, depth=2), folder)
    assert len(model.start) == 5 and not [n for n in files.names(spark, folder) if n.startswith("rows-")]
    forest_ = forest.fit_forest(bins, cuts, forest.Forest(3, 5))
    assert files.names(spark, forest_.paths[0].rsplit("/", 1)[0]) == ["trees-0"]


def test_rows_to_fit_on_are_not_stored_a_second_time(lake):
    ready = keys_ml.ready(lake)
    assert "prepared-" in ready.fit_on.inputFiles()[0] and all(".zstd." in n for n in ready.bins.inputFiles())
    folder = workspace_root(lake.spark) + f"/quayside/{lake.spark.sparkContext.applicationId}"
    base = [n for n in files.names(lake.spark, folder) if n.startswith("training-")]
    assert not base and ready.sizes["train"] == ready.fit_on.count()
