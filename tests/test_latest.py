import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators.latest import latest_attributes, latest_rows, latest_rows_by_window
from quayside.operators.upsert import upsert

SCHEMA = "k int, a string, b double, t timestamp"
times = st.sampled_from([None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(1960, 1, 1)])
rows = st.lists(
    st.tuples(st.integers(0, 3), st.sampled_from([None, "x", "y"]), st.sampled_from([None, 1.0, 2.5]), times),
    min_size=1,
    max_size=25,
)


def brute(data):
    """Greatest time, NULL last; then smallest a, b with NULL first."""
    def rank(r):
        low = dt.datetime(1, 1, 1)
        return (r[3] is None, low - (r[3] or low), r[1] is not None, r[1] or "", r[2] is not None, r[2] or 0.0)

    best = {}
    for r in data:
        if r[0] not in best or rank(r) < rank(best[r[0]]):
            best[r[0]] = r
    return {k: (k, r[1], r[2]) for k, r in best.items()}


def as_dict(df):
    return {r["k"]: (r["k"], r["a"], r["b"]) for r in df.collect()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_all_variants_give_the_latest_row(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    expected = brute(data)
    shuffled = spark.createDataFrame(data[::-1], SCHEMA)
    assert as_dict(latest_rows(df, ["k"], "t")) == expected
    assert as_dict(latest_rows(shuffled, ["k"], "t")) == expected
    assert as_dict(latest_rows_by_window(df, ["k"], "t")) == expected
    assert as_dict(latest_attributes(df, ["k"], "t")) == expected


def test_idempotent(spark):
    data = [(i % 5, str(i), float(i), dt.datetime(2024, 1, 1 + i % 7)) for i in range(50)]
    once = latest_rows(spark.createDataFrame(data, SCHEMA), ["k"], "t", keep_order=True)
    assert sorted(latest_rows(once, ["k"], "t", keep_order=True).collect()) == sorted(once.collect())


def test_other_order_types_take_the_window(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0), (2, "z", 0.0)], "k int, a string, v double")
    assert sorted((r["k"], r["a"]) for r in latest_rows(df, ["k"], "v").collect()) == [(1, "y"), (2, "z")]


def test_hot_key_sends_one_row_per_map_task(spark):
    """Half of the rows share one key; after the map side at most one row per key and task is left."""
    df = spark.range(0, 100_000, numPartitions=4).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 1000).alias("k"),
        F.col("id").cast("string").alias("a"),
        F.timestamp_seconds("id").alias("t"),
    )
    result = latest_rows(df, ["k"], "t")
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning(k")
    assert result.filter("k = 0").first()["a"] == "99998"


def test_upsert_last_write_wins(spark):
    schema = "k int, v string, at timestamp"
    old = spark.createDataFrame([(1, "old", dt.datetime(2024, 1, 1)), (2, "kept", dt.datetime(2024, 1, 1))], schema)
    new = spark.createDataFrame([(1, "new", dt.datetime(2024, 1, 2)), (3, "added", dt.datetime(2024, 1, 2))], schema)
    assert sorted((r["k"], r["v"]) for r in upsert(old, new, ["k"], "at").collect()) == [
        (1, "new"),
        (2, "kept"),
        (3, "added"),
    ]


def test_the_new_side_wins_ties(spark):
    t = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([(1, "A", 1.0, t), (2, "x", 1.0, dt.datetime(2024, 1, 3)), (3, "x", 1.0, None)], SCHEMA)
    new = spark.createDataFrame([(1, "Z", 9.0, t), (2, "y", 2.0, t), (3, "y", 2.0, None), (4, "y", 2.0, t)], SCHEMA)
    merged = upsert(old, new, ["k"], "t")
    assert merged.columns == ["k", "a", "b", "t"]
    assert {r["k"]: r["a"] for r in merged.collect()} == {1: "Z", 2: "x", 3: "y", 4: "y"}
