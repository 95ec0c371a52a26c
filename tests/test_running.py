import random
import statistics

import pytest
from pyspark.sql import functions as F

from quayside.ml import evaluate
from quayside.operators import running
from quayside.operators.quantile import exact_medians
from quayside.operators.running import dense_codes, ranged, running_totals


@pytest.fixture
def many_ranges(monkeypatch):
    """Make a small table take many ranges."""
    monkeypatch.setattr(running, "RANGE_ROWS", 40)


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_ranges(spark, many_ranges, descending):
    random.seed(1)
    data = {round(random.random() ** 3, 6): random.randint(0, 9) for _ in range(500)}
    df = spark.createDataFrame(list(data.items()), "k double, m int")
    cut = ranged(df, "k").groupBy("_range").agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("_range").collect()
    assert len(cut) > 8 and all(x["b"] < y["a"] for x, y in zip(cut, cut[1:]))
    expected, total = {}, 0
    for k in sorted(data, reverse=descending):
        total += data[k]
        expected[k] = total
    got = {r["k"]: r["cum_m"] for r in running_totals(df, "k", ["m"], descending).collect()}
    assert got == expected


def test_few_values_take_one_range(spark):
    df = spark.createDataFrame([(1.0, 2), (2.0, 3)], "k double, m int")
    assert ranged(df, "k").select("_range").distinct().count() == 1
    assert {r["k"]: r["cum_m"] for r in running_totals(df, "k", ["m"]).collect()} == {1.0: 2, 2.0: 5}


def test_dense_codes_follow_the_sorted_values(spark, many_ranges):
    words = {f"w{i * 37 % 500:03d}" for i in range(300)}
    rows = [("a", w) for w in words] + [("b", "only"), ("b", None)]
    df = spark.createDataFrame(rows * 2, "p string, v string")
    got = {(r["p"], r["v"]): r["code"] for r in dense_codes(df, "v", partition="p").collect()}
    expected = {("a", w): i for i, w in enumerate(sorted(words))} | {("b", "only"): 0}
    assert got == expected


@pytest.mark.parametrize("n", [1, 2, 7, 5000, 5001])
def test_exact_medians(spark, n):
    random.seed(n)
    rows = [(random.gauss(0, 100), float(random.randint(0, 3)), None if i % 3 else random.random()) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = exact_medians(df, ["a", "b", "c"], accuracy=100)
    for i, name in enumerate("abc"):
        values = [r[i] for r in rows if r[i] is not None]
        assert got[name] == (statistics.median(values) if values else None), name


def test_median_of_nothing(spark):
    assert exact_medians(spark.createDataFrame([(None,)], "a double"), ["a"]) == {"a": None}


def brute_auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))


def test_auc_and_threshold_against_brute_force(spark, many_ranges):
    random.seed(7)
    # A third of all rows share one score.
    pairs = [(0.5 if i % 3 == 0 else round(random.random(), 3), int(random.random() < 0.4)) for i in range(600)]
    df = spark.createDataFrame(pairs, "score double, label int")
    totals = evaluate.score_totals(df, "label", "score")
    assert evaluate.auc(totals).first()["auc"] == pytest.approx(brute_auc(pairs))
    positives = sum(y for _, y in pairs)

    def gap(t):
        hits = [y for s, y in pairs if s >= t]
        return abs(sum(hits) / len(hits) - sum(hits) / positives)

    best = min(sorted({s for s, _ in pairs}), key=lambda t: (round(gap(t), 12), t))
    assert evaluate.best_threshold(totals).first()["threshold"] == best


def test_metrics_at_threshold(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.4, 1), (0.1, 0)], "score double, label int")
    row = evaluate.classification_metrics(df, "label", "score", 0.5).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"], row["auc"]) == (0.5, 0.5, 0.5, 0.5, 0.75)


def test_histogram_puts_one_into_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.049,), (0.05,), (1.0,)], "score double")
    assert {r["bin"]: r["rows"] for r in evaluate.score_histogram(df, "score").collect()} == {0: 2, 1: 1, 19: 1}
