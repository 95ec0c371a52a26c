import math
import random
import statistics

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from contract.keys_ml import _highest_risk_rows
from quayside.functions import stable
from quayside.ml import evaluate, explain, prepare, runs, score
from quayside.ml.split import class_ratio, stratified_split
from quayside.ml.train import CANDIDATES, Effort, TrainingRun, bounded, candidates, selected_features, train_models

NUMERIC, TEXT = ["x1", "x2"], ["kind"]


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(3)
    data = []
    for i in range(1500):
        x1, kind = random.gauss(0, 2), random.choice(["a", "b", "c", None])
        late = random.random() < 1 / (1 + math.exp(-(2 * x1 + (1 if kind == "b" else 0))))
        data.append((i, x1 if i % 10 else None, random.random(), kind, late))
    return spark.createDataFrame(data, "id int, x1 double, x2 double, kind string, late boolean").checkpoint()


@pytest.fixture(scope="module")
def run(rows) -> TrainingRun:
    effort = Effort(boosting_rounds=2, selection_rounds=2, forest_trees=3, logistic_iterations=30, fit_rows=600)
    return train_models(rows, ["id"], NUMERIC, TEXT, label="late", effort=effort)


def test_class_ratio(rows):
    row = class_ratio(rows, "late").first()
    assert row["positives"] + row["negatives"] == row["total_rows"] == 1500
    assert row["class_ratio"] == row["negatives"] / row["positives"]


def test_split_is_stratified_and_repeatable(rows):
    parts = stratified_split(rows, "late", ["id"])
    counts = {(r["late"], r["split"]): r["count"] for r in parts.groupBy("late", "split").count().collect()}
    for late in (True, False):
        total = sum(n for (y, _), n in counts.items() if y == late)
        for split, share in (("train", 0.6), ("validation", 0.2), ("test", 0.2)):
            assert abs(counts[late, split] / total - share) < 0.01
    again = stratified_split(rows.repartition(7), "late", ["id"])
    assert sorted(parts.select("id", "split").collect()) == sorted(again.select("id", "split").collect())
    other = stratified_split(rows, "late", ["id"], seed=1)
    assert sorted(parts.select("id", "split").collect()) != sorted(other.select("id", "split").collect())


def test_preprocessor_follows_the_training_rows(spark):
    train = spark.createDataFrame([(1.0, "b"), (3.0, "a"), (None, None), (8.0, "b")], "x double, kind string")
    model = prepare.fit_preprocessor(train, ["x"], ["kind"])
    median = 3.0
    filled = [1.0, 3.0, median, 8.0]
    mean, sigma = statistics.mean(filled), statistics.pstdev(filled)
    new = spark.createDataFrame([(8.0, "b"), (None, "zzz"), (1.0, None)], "x double, kind string")
    got = [list(r[0]) for r in model.transform(new).select(vector_to_array("features")).collect()]
    # Sorted training values: Unknown, a, b; a value not seen is -1.
    expected = [[(8.0 - mean) / sigma, 2.0], [(median - mean) / sigma, -1.0], [(1.0 - mean) / sigma, 0.0]]
    assert got == [pytest.approx(e) for e in expected]


def test_codes_join_equals_the_stored_encoder(spark, rows):
    codes = prepare.ordinal_codes(rows, ["kind"])
    assert {r["value"]: r["code"] for r in codes.collect()} == {"Unknown": 0, "a": 1, "b": 2, "c": 3}
    coded = prepare.encode(spark.createDataFrame([("c",), ("q",), (None,)], "kind string"), "kind", codes, "code")
    assert {r["kind"]: r["code"] for r in coded.collect()} == {"c": 3, "q": -1, None: 0}


def test_constant_columns_keep_scale_one(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert prepare.population_scale(df, ["x"]) == {"x": (5.0, 1.0)}


def test_five_candidates_beat_chance(run):
    assert tuple(run.models) == tuple(candidates(Effort())) == CANDIDATES
    assert all(m["auc"] > 0.5 for m in run.metrics)
    assert [m["f1"] for m in run.metrics] == sorted((m["f1"] for m in run.metrics), reverse=True)
    assert run.best == run.metrics[0]["model"] and sum(run.sizes.values()) == 1500
    assert "x1" in run.selected and dict(run.importance)["x1"] > dict(run.importance)["x2"]


def test_selection_cutoff():
    assert selected_features([("a", 0.5), ("b", 0.005), ("c", 0.006)]) == ["a", "c"]


def test_saved_model_scores_the_same(run, rows, tmp_path):
    scorer = run.scorer("logistic")
    scorer.save(str(tmp_path / "m"))
    loaded = score.Scorer.load(rows.sparkSession, str(tmp_path / "m"))
    assert (loaded.threshold, loaded.means, loaded.selected) == (scorer.threshold, scorer.means, scorer.selected)
    kept = [score.score(m, rows).orderBy("id").collect() for m in (scorer, loaded)]
    assert kept[0] == kept[1]
    with pytest.raises(FileNotFoundError):
        score.Scorer.load(rows.sparkSession, str(tmp_path / "gone"))


def test_input_contract(spark, run):
    partial = spark.createDataFrame([(1, "2.5"), (2, "n/a")], "id int, x1 string")
    scored = score.score(run.scorer("logistic"), partial, 0.0)
    assert [r["predicted_late"] for r in scored.collect()] == [1, 1]
    assert scored.columns == ["id", "x1", "prob_late", "predicted_late"]
    with pytest.raises(ValueError, match="x2, kind"):
        score.score(run.scorer("logistic"), partial, 0.5, strict=True)
    with pytest.raises(ValueError, match="missing"):
        score.score(run.scorer("logistic"), partial.select("id"), 0.5)


def test_row_drivers_add_up_to_the_margin(run, rows):
    scorer = run.scorer("logistic")
    sliced = scorer.transform(rows).select("id", "selected", "rawPrediction").checkpoint()
    parts = explain.linear_contributions(sliced, scorer.model, run.selected, run.means, ["id"])
    sums = {r["id"]: r["s"] for r in parts.groupBy("id").agg(F.sum("contribution").alias("s")).collect()}
    margins = {r["id"]: float(r["rawPrediction"][1]) for r in sliced.collect()}
    base = scorer.model.intercept + sum(c * m for c, m in zip(scorer.model.coefficients, run.means))
    assert all(sums[i] == pytest.approx(margins[i] - base, abs=1e-6) for i in list(margins)[:50])
    # One row alone has the same drivers.
    alone = explain.linear_contributions(sliced.filter("id = 1"), scorer.model, run.selected, run.means, ["id"])
    first = parts.filter("id = 1").orderBy("rank").collect()
    assert alone.orderBy("rank").collect() == first
    sizes = [abs(r["contribution"]) for r in first]
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > 0


def test_nested_row_drivers_are_the_same_without_a_shuffle(run, rows):
    scorer = run.scorer("logistic")
    sliced = scorer.transform(rows).select("id", "selected").checkpoint()
    flat, nested = (
        explain.linear_contributions(sliced, scorer.model, run.selected, run.means, ["id"], nested=n) for n in (False, True)
    )
    together = nested.select("id", F.inline("parts"))
    assert together.columns == flat.columns and sorted(together.collect()) == sorted(flat.collect())
    assert nested.count() == 1500 and "Exchange" not in nested._jdf.queryExecution().executedPlan().toString()


def test_rows_to_fit_on_are_looked_for_by_all_tasks(spark):
    marked = spark.range(100_000, numPartitions=8).withColumn("_mark", F.xxhash64("id"))
    seen = spark.sparkContext.accumulator(0)

    def tasks(batches):
        seen.add(1)
        yield from batches

    few = bounded(marked.mapInArrow(tasks, marked.schema), 100_000, 500)
    assert 400 < few.count() < 600 and seen.value == 8
    marks = [r["_mark"] for r in few.collect()]
    assert marks == sorted(marks) and few.rdd.getNumPartitions() == 1


def test_tree_drivers_explain_rows_predicted_late(run, rows):
    scorer = run.scorer("logistic")
    flagged = _highest_risk_rows(scorer, rows.withColumnRenamed("id", "order_item_id"))
    top = flagged.collect()
    assert len(top) == 50 and min(r["p"] for r in top) >= scorer.threshold
    assert [r["p"] for r in top] == sorted((r["p"] for r in top), reverse=True)


def test_permutation_importance_ranks_the_signal_first(run, rows):
    scorer = run.scorer("logistic")
    sliced = scorer.transform(rows).select("id", F.col("late").cast("int").alias("label"), "selected")
    loss, again = (
        explain.permutation_importance(df, scorer.model, run.selected, "label", ["id"]) for df in (sliced, sliced.repartition(3))
    )
    assert max(loss, key=lambda p: p[1])[0] == "x1" and loss == again


def test_packed_areas_are_exact(spark):
    random.seed(5)
    data = [(s, random.randint(0, 1), round(random.random(), 2 + s)) for s in range(-1, 3) for _ in range(2000)] + [(3, 1, 0.5), (3, 0, 0.5)]
    scored = spark.createDataFrame(data, "slot int, label int, score double").repartition(3)
    totals = evaluate.score_totals(scored, "label", "score", by="slot")
    want = {r["slot"]: r["auc"] for r in evaluate.auc(totals, by="slot").collect()}
    for cuts in ([], [0.1, 0.5, 0.52, 0.9]):
        assert explain.packed_areas(scored, cuts) == pytest.approx(want, abs=1e-12)
    assert explain.packed_areas(scored.filter("slot = 3"), []) == {3: 0.5}
    assert explain.packed_areas(scored.filter("slot = 3 AND label = 1"), []) == {3: None}
    assert explain.score_cuts(scored.select("score"), 300_000) == sorted(explain.score_cuts(scored.select("score"), 300_000))
    assert len(explain.score_cuts(scored.select("score"), 300_000)) == 2


def test_bounded_fit_rows(spark, rows):
    marked = rows.withColumn("_mark", F.xxhash64("id"))
    few = bounded(marked, 1500, 300)
    assert 200 < few.count() < 400 and few.rdd.getNumPartitions() == 1
    assert bounded(marked, 1500, 2000).count() == 1500


def test_summaries_and_flags(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.2), (3, 1, 0.7)], "id int, predicted_late int, prob double")
    row = stable(evaluate.score_summary(df)).first()
    assert (row["total_orders"], row["late_orders"], row["on_time_orders"], row["late_rate_pct"]) == (3, 2, 1, 66.6667)
    assert [r["id"] for r in evaluate.highest_risk(df, "prob", "id", k=1).collect()] == [1]
    assert evaluate.with_correct(df).columns == df.columns
    flagged = evaluate.with_correct(df.withColumn("actual_late", F.lit(True)))
    assert [r["correct"] for r in flagged.orderBy("id").collect()] == [1, 0, 1]


def test_run_log(spark, tmp_path):
    import datetime as dt

    path = str(tmp_path / "runs")
    metrics = [{"model": "m", "accuracy": 0.123456, "precision": 0.5, "recall": 0.5, "f1": 0.5, "auc": 0.5}]
    for version in (1, 2):
        start = dt.datetime(2024, 1, version)
        runs.append_run(runs.run_rows(spark, f"r{version}", version, start, metrics), path)
    empty = [{"model": "m", **dict.fromkeys(runs.METRICS)}]
    runs.append_run(runs.run_rows(spark, "r3", 3, dt.datetime(2024, 1, 3), empty), path)
    log = spark.read.parquet(path)
    history = runs.run_history(log)
    assert sorted(r["run_id"] for r in history.collect()) == ["r1", "r2"]
    assert history.first()["accuracy"] == 0.1235
    assert runs.run_history(log, runs=2).count() == 1
    assert runs.production_version(log).first()["version"] == 3


def test_training_in_the_flow(spark, lake):
    from quayside.plans import refresh as r
    from quayside.session import new_folder
    from quayside.sources.lake import Lake

    own = Lake(spark, new_folder(spark, "trained"))
    with pytest.raises(KeyError):
        r.production_scorer(own)
    for name in ("fact_order_items", "dim_order", "dim_product", "dim_customer"):
        own.store(name, lake.table(name))
    own.publish()
    effort = Effort(boosting_rounds=1, selection_rounds=2, forest_trees=2, forest_depth=4, logistic_iterations=20)
    paths = [r.run_training(own, effort, only=["logistic", "random_forest"]) for _ in range(2)]
    scorer = r.production_scorer(Lake(spark, own.root))
    assert len(set(paths)) == 2 and len(scorer.means) == len(scorer.selected)
    log = spark.read.parquet(f"{own.root}/meta/model_metrics")
    assert runs.production_version(log).first()["version"] == 2 and log.select("model").distinct().count() == 2
    parameters = spark.read.parquet(f"{own.root}/meta/model_parameters").filter(F.col("run_id") == paths[0].split("/")[-1])
    found = {x["name"]: x["value"] for x in parameters.collect()}
    assert found["best_model"] in ("logistic", "random_forest") and found["n_features_original"] == "31"
    assert sum(int(found[f"{s}_rows"]) for s in ("train", "validation", "test")) == lake.table("feat_delivery_risk").count()
