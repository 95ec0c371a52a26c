"""M: split, preprocessing, training, evaluation, scoring, explanation and run records."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from contract.keys_ops import scored
from contract.oracle import big, r
from contract.registry import key
from quayside.config import FEATURE_SETS, LABEL
from quayside.functions import round_to, stable
from quayside.ml import evaluate, explain, prepare, runs, score
from quayside.ml.split import class_ratio, stratified_split
from quayside.ml.train import CANDIDATES, Effort, fit_candidates, prepare_training
from quayside.operators.quantile import exact_medians
from quayside.plans.features import feat_delivery_risk

NUMERIC, TEXT = FEATURE_SETS["template"]
NAMES = [*NUMERIC, *TEXT]


def values(*columns: str, rows: list[tuple[str, ...]]) -> str:
    """Constant rows of SQL text."""
    lines = ", ".join("(" + ", ".join(row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {lines}) AS t({', '.join(columns)})"


def items(w):
    """Feature rows with their item id."""
    tables = (w.table(n) for n in ("fact_order_items", "dim_order", "dim_product", "dim_customer"))
    return feat_delivery_risk(*tables, keep=["order_item_id"])


# Full sizes, fitted on all training rows.
EFFORT = Effort()


def ready(w):
    """Split, prepared and selected rows, shared by all candidates."""
    if not hasattr(w, "_ready"):
        w._ready = prepare_training(items(w), ["order_item_id"], NUMERIC, TEXT, effort=EFFORT)
    return w._ready


def candidate(w, name):
    """The run of one candidate, fitted once."""
    runs_ = w.__dict__.setdefault("_runs", {})
    if name not in runs_:
        runs_[name] = fit_candidates(ready(w), [name])
    return runs_[name]


def training(w):
    """All five candidates, those fitted before as they are."""
    fitted = {n: r.models[n] for n, r in w.__dict__.get("_runs", {}).items()}
    return fit_candidates(ready(w), fitted=fitted)


def linear(w):
    """The run of the linear candidate alone: the same split, preparation, selection and linear model."""
    return candidate(w, "logistic")


@key(
    "m01_class_ratio",
    f"""SELECT count(*) AS total_rows, {big('sum(label)')} AS positives, {big('sum(1 - label)')} AS negatives,
  {r('CAST(sum(1 - label) AS DOUBLE) / sum(label)')} AS class_ratio FROM scored""",
)
def _m01(w):
    return stable(class_ratio(w.table("feat_delivery_risk"), LABEL))


@key(
    "m02_stratified_split",
    """SELECT late_delivery_risk, split, count(*) AS class_rows, TRUE AS share_holds
FROM feat_items CROSS JOIN (VALUES ('train'), ('validation'), ('test')) AS s(split) GROUP BY 1, 2""",
)
def _m02(w):
    """The share of each split in each class, up to a hundredth."""
    parts = stratified_split(items(w), LABEL, ["order_item_id"]).groupBy(LABEL, "split").agg(F.count(F.lit(1)).alias("rows"))
    share = F.when(F.col("split") == "train", 0.6).otherwise(0.2)
    classes = parts.groupBy(F.col(LABEL).alias("class")).agg(F.sum("rows").alias("class_rows"))
    joined = parts.join(classes, F.col(LABEL) == F.col("class"))
    holds = (F.abs(F.col("rows") / F.col("class_rows") - share) < 0.01).alias("share_holds")
    return joined.select(LABEL, "split", "class_rows", holds)


_SPARSE = {
    "sales": "sales",
    "order_profit": "order_profit",
    "discount_if_any": "nullif(order_item_discount_rate, 0)",
    "unit_price": "unit_price",
    "quantity": "order_item_quantity",
}


def _sparse(w):
    return items(w).select(
        "order_item_id",
        "sales",
        "order_profit",
        F.nullif("order_item_discount_rate", F.lit(0)).alias("discount_if_any"),
        "unit_price",
        F.col("order_item_quantity").cast("double").alias("quantity"),
    )


@key(
    "m03_median_imputation",
    f"""SELECT order_item_id, {', '.join(f"{r(f'coalesce({x}, (SELECT median({x}) FROM feat_items))')} AS {n}"
        for n, x in _SPARSE.items())} FROM feat_items""",
)
def _m03(w):
    rows = _sparse(w)
    return stable(prepare.imputed(rows, exact_medians(rows, list(_SPARSE))))


@key(
    "m04_standardisation",
    f"""SELECT order_item_id, {', '.join(f"{r(f'({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER ()')} AS {x}"
        for x in ('sales', 'order_profit', 'unit_price'))} FROM feat_items""",
)
def _m04(w):
    columns = ["sales", "order_profit", "unit_price"]
    rows = items(w).select("order_item_id", *columns)
    return stable(prepare.standardised(rows, prepare.population_scale(rows, columns)))


@key(
    "m05_ordinal_encoding",
    """SELECT o.order_id, coalesce(a.code, -1) AS country_code, coalesce(b.code, -1) AS city_code,
  coalesce(z.code, -1) AS zipcode_code FROM coded o
LEFT JOIN (SELECT DISTINCT order_country, CAST(dense_rank() OVER (ORDER BY order_country) - 1 AS INTEGER) AS code FROM coded
  WHERE order_date < TIMESTAMP '1995-02-01') a ON o.order_country = a.order_country
LEFT JOIN (SELECT DISTINCT order_city, CAST(dense_rank() OVER (ORDER BY order_city) - 1 AS INTEGER) AS code FROM coded
  WHERE order_date < TIMESTAMP '1995-02-01') b ON o.order_city = b.order_city
LEFT JOIN (SELECT DISTINCT customer_zipcode, CAST(dense_rank() OVER (ORDER BY customer_zipcode) - 1 AS INTEGER) AS code
  FROM coded WHERE order_date < TIMESTAMP '1995-02-01') z ON o.customer_zipcode = z.customer_zipcode""",
)
def _m05(w):
    orders = w.table("stg_order").select("order_id", "customer_id", "order_country", "order_city", "order_date")
    rows = orders.join(w.table("dim_customer").select("customer_id", "customer_zipcode"), "customer_id", "left")
    # Values that first appear after the training window are unseen.
    train = rows.filter(F.col("order_date") < F.lit("1995-02-01").cast("timestamp_ntz"))
    columns = {"order_country": "country_code", "order_city": "city_code", "customer_zipcode": "zipcode_code"}
    codes = prepare.ordinal_codes(train, list(columns)).checkpoint()
    for column, output in columns.items():
        rows = prepare.encode(rows, column, codes, output)
    return rows.select("order_id", *columns.values())


@key(
    "m06_feature_selection",
    values("feature", "in_range", "sum_is_one", "selected_by_rule", rows=[(f"'{n}'", "TRUE", "TRUE", "TRUE") for n in NAMES]),
)
def _m06(w):
    """Every importance is a share, they add up to one, and those above the cutoff are selected."""
    run = linear(w)
    rows = explain.importance_table(w.spark, run.importance, len(run.names))
    total = F.sum("importance").over(Window.partitionBy())  # one row per feature
    return rows.select(
        "feature",
        F.col("importance").between(0, 1).alias("in_range"),
        (F.abs(total - 1) < 1e-9).alias("sum_is_one"),
        (F.col("feature").isin(run.selected) == (F.col("importance") > 0.005)).alias("selected_by_rule"),
    )


@key("o05_top_features", values("place", "falls", rows=[(f"{k}::BIGINT", "TRUE") for k in range(1, 21)]))
def _o05(w):
    """The top 20 features: as many, and none above the one before it."""
    top = explain.importance_table(w.spark, linear(w).importance, 20)
    order = Window.partitionBy().orderBy(F.desc("importance"), "feature")  # 20 rows
    falls = F.coalesce(F.lag("importance").over(order) >= F.col("importance"), F.lit(True))
    return top.select(F.row_number().over(order).cast("bigint").alias("place"), falls.alias("falls"))


_CHECKED_SQL = """WITH own AS (SELECT model, label, score, CASE WHEN score >= threshold THEN 1 ELSE 0 END AS p FROM scores),
c AS (SELECT model, CAST(sum(p * label) AS DOUBLE) AS tp, CAST(sum(p * (1 - label)) AS DOUBLE) AS fp,
  CAST(sum((1 - p) * label) AS DOUBLE) AS fn, CAST(sum((1 - p) * (1 - label)) AS DOUBLE) AS tn FROM own GROUP BY model),
a AS (SELECT x.model, sum(CASE WHEN x.score > y.score THEN 1.0D WHEN x.score = y.score THEN 0.5D ELSE 0.0D END * x.n * y.n) AS won,
  sum(CAST(x.n * y.n AS DOUBLE)) AS pairs
  FROM (SELECT model, round(score, 2) AS score, count(*) AS n FROM own WHERE label = 1 GROUP BY 1, 2) x
  JOIN (SELECT model, round(score, 2) AS score, count(*) AS n FROM own WHERE label = 0 GROUP BY 1, 2) y ON x.model = y.model
  GROUP BY x.model)
SELECT c.model, (tp + tn) / (tp + fp + fn + tn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, won / pairs AS auc
FROM c JOIN a ON c.model = a.model"""


def _checked(w, run):
    """The metrics of the run, against SQL over the stored test scores; the area there comes from scores of two digits."""
    thresholds = w.spark.createDataFrame(list(run.thresholds.items()), "model string, threshold double")
    scores = run.scores.filter("split = 'test'").join(thresholds, "model")
    wide = w.spark.sql(_CHECKED_SQL.replace("FROM scores", "FROM {scores}"), scores=scores)
    recomputed = wide.unpivot("model", list(runs.METRICS), "metric", "expected")
    logged = runs.run_rows(w.spark, "run-1", 1, None, run.metrics)
    gap = F.abs(F.col("value") - F.col("expected"))
    agrees = gap < F.when(F.col("metric") == "auc", 0.01).otherwise(0.0001)
    areas = {m["model"]: m["auc"] for m in run.metrics}
    beats = F.col("model").isin([m for m, area in areas.items() if area > 0.5])
    return logged.join(recomputed, ["model", "metric"]).select("model", "metric", agrees.alias("agrees"), beats.alias("beats_chance"))


def _metrics_hold(*models):
    rows = [(f"'{m}'", f"'{k}'", "TRUE", "TRUE") for m in models for k in runs.METRICS]
    return values("model", "metric", "agrees", "beats_chance", rows=rows)


for _name in CANDIDATES:
    key(f"m07_{_name}", _metrics_hold(_name))(lambda w, name=_name: _checked(w, candidate(w, name)))


@key("m07_five_classifiers", _metrics_hold(*CANDIDATES))
def _m07(w):
    return _checked(w, training(w))


@key(
    "m08_best_threshold",
    f"""SELECT {r('threshold', 6)} AS threshold, {r('pr', 6)} AS "precision", {r('re', 6)} AS recall FROM (
  SELECT threshold, tp / (tp + fp) AS pr, tp / p AS re FROM (
    SELECT score_a AS threshold, CAST(sum(pos) OVER (ORDER BY score_a DESC) AS DOUBLE) AS tp,
      sum(neg) OVER (ORDER BY score_a DESC) AS fp, sum(pos) OVER () AS p
    FROM (SELECT score_a, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1)))
ORDER BY abs(pr - re), threshold LIMIT 1""",
)
def _m08(w):
    return stable(evaluate.best_threshold(evaluate.score_totals(scored(w), "label", "score_a")), 6)


_THRESHOLDS = {"score_a": 0.5, "score_b": 0.45, "score_c": 0.6}


def _metrics_sql(name: str, threshold: float) -> str:
    return f"""SELECT '{name}' AS model, (tp + tn) / (tp + tn + fp + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS pr,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
  (SELECT (sum(CASE WHEN label = 1 THEN rk END) - p * (p + 1) / 2) / (CAST(p AS DOUBLE) * n) FROM (
    SELECT label, rank() OVER (ORDER BY {name}) + (count(*) OVER (PARTITION BY {name}) - 1) / 2 AS rk,
      sum(label) OVER () AS p, count(*) OVER () - sum(label) OVER () AS n FROM scored) GROUP BY p, n) AS auc FROM (
  SELECT CAST(sum(CASE WHEN {name} >= {threshold}::DOUBLE AND label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
    CAST(sum(CASE WHEN {name} >= {threshold}::DOUBLE AND label = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
    CAST(sum(CASE WHEN {name} < {threshold}::DOUBLE AND label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
    CAST(sum(CASE WHEN {name} < {threshold}::DOUBLE AND label = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn FROM scored)"""


_ALL_METRICS_SQL = " UNION ALL ".join(_metrics_sql(n, t) for n, t in _THRESHOLDS.items())


def _long_scores(w):
    return scored(w).unpivot(["label"], list(_THRESHOLDS), "model", "score")


def _metrics(w):
    """Through the functions that training uses."""
    own = F.create_map(*[F.lit(x) for pair in _THRESHOLDS.items() for x in pair])[F.col("model")]
    return evaluate.metrics_by_model(_long_scores(w), "label", "score", own)


@key(
    "m09_metrics_leaderboard",
    f"""SELECT model, {r('accuracy', 6)} AS accuracy, {r('pr', 6)} AS "precision", {r('recall', 6)} AS recall,
  {r('f1', 6)} AS f1, {r('auc', 6)} AS auc FROM ({_ALL_METRICS_SQL})""",
)
def _m09(w):
    return stable(evaluate.leaderboard(_metrics(w)), 6)


@key(
    "m09_classification_metrics",
    f"""SELECT {r('accuracy', 6)} AS accuracy, {r('pr', 6)} AS "precision", {r('recall', 6)} AS recall,
  {r('f1', 6)} AS f1, {r('auc', 6)} AS auc FROM ({_metrics_sql('score_b', 0.45)})""",
)
def _m09_one(w):
    return stable(evaluate.classification_metrics(scored(w), "label", "score_b", 0.45), 6)


def _threshold_sql(name: str) -> str:
    return f"""(SELECT '{name}' AS model, threshold, pr, re FROM (
  SELECT threshold, tp / (tp + fp) AS pr, tp / p AS re FROM (
    SELECT {name} AS threshold, CAST(sum(pos) OVER (ORDER BY {name} DESC) AS DOUBLE) AS tp,
      sum(neg) OVER (ORDER BY {name} DESC) AS fp, sum(pos) OVER () AS p
    FROM (SELECT {name}, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1)))
ORDER BY abs(pr - re), threshold LIMIT 1)"""


@key(
    "m09_thresholds_by_model",
    f"""SELECT model, {r('threshold', 6)} AS threshold, {r('pr', 6)} AS "precision", {r('re', 6)} AS recall
FROM ({' UNION ALL '.join(_threshold_sql(n) for n in _THRESHOLDS)})""",
)
def _m09_thresholds(w):
    totals = evaluate.score_totals(_long_scores(w), "label", "score", by="model")
    return stable(evaluate.best_threshold(totals, by="model"), 6)


@key(
    "m09_best_model",
    f"SELECT model, {r('f1', 6)} AS f1 FROM ({_ALL_METRICS_SQL}) ORDER BY f1 DESC LIMIT 1",
)
def _m09_best(w):
    own = F.create_map(*[F.lit(x) for pair in _THRESHOLDS.items() for x in pair])[F.col("model")]
    return stable(evaluate.best_model(_metrics(w).withColumn("threshold", own)).select("model", "f1"), 6)


def _margin(scorer, x):
    """Intercept and coefficients of the linear model, applied in SQL to the selected features."""
    terms = [F.lit(c) * x[i] for i, c in enumerate(scorer.model.coefficients.toArray().tolist())]
    return reduce(lambda a, b: a + b, terms, F.lit(float(scorer.model.intercept)))


@key("m10_batch_scoring", "SELECT order_item_id, TRUE AS agrees, TRUE AS flag_agrees FROM feat_items")
def _m10(w):
    """A stored and reloaded scorer scores rows that lack two columns and hold text for a number.

    Its scores are computed again from the stored medians, scales, codes and coefficients, by joins and arithmetic.
    """
    path = w.scratch("model")
    linear(w).scorer("logistic").save(path)
    scorer = score.Scorer.load(w.spark, path)
    rows = items(w).drop("order_city", "unit_price").withColumn("sales", F.col("sales").cast("string"))
    scored_rows = score.score(scorer, rows).select("order_item_id", "prob_late", "predicted_late")

    own, codes = scorer.preprocessor, w.spark.read.parquet(f"{path}/codes")
    full = items(w).withColumns({"order_city": F.lit("Unknown"), "unit_price": F.lit(None).cast("double")})
    features = {}
    for name in own.numeric:
        mean, sigma = own.scale[name]
        features[name] = (F.coalesce(F.col(name).cast("double"), F.lit(own.medians[name])) - F.lit(mean)) / F.lit(sigma)
    for name in own.text:
        one = codes.filter(F.col("column_name") == name).select(F.col("value").alias(f"v_{name}"), F.col("code").alias(f"c_{name}"))
        full = full.join(one, F.coalesce(F.col(name), F.lit("Unknown")) == F.col(f"v_{name}"), "left")
        features[name] = F.coalesce(f"c_{name}", F.lit(-1)).cast("double")
    expected = 1 / (1 + F.exp(-_margin(scorer, [features[n] for n in scorer.selected])))
    again = full.select(F.col("order_item_id").alias("item"), expected.alias("expected"))
    joined = scored_rows.join(again, F.col("order_item_id") == F.col("item"))
    return joined.select(
        "order_item_id",
        (F.abs(F.col("prob_late") - F.col("expected")) < 1e-9).alias("agrees"),
        (F.col("predicted_late") == (F.col("prob_late") >= scorer.threshold).cast("int")).alias("flag_agrees"),
    )


def _predicted(w):
    return scored(w).select("order_item_id", "label", score.predicted_late(0.5, "score_a"))


@key(
    "m11_score_summary",
    f"""SELECT count(*) AS total_orders, {big('sum(p)')} AS late_orders, {big('count(*) - sum(p)')} AS on_time_orders,
  {r('CAST(sum(p) AS DOUBLE) / count(*) * 100')} AS late_rate_pct FROM (
  SELECT CAST(score_a >= 0.5 AS INTEGER) AS p FROM scored)""",
)
def _m11(w):
    return stable(evaluate.score_summary(_predicted(w)))


@key(
    "m12_correct_flag",
    "SELECT order_item_id, label AS actual_late, CAST(score_a >= 0.5 AS INTEGER) AS predicted_late, "
    "CAST(label = CAST(score_a >= 0.5 AS INTEGER) AS INTEGER) AS correct FROM scored",
)
def _m12(w):
    return evaluate.with_correct(_predicted(w).withColumnRenamed("label", "actual_late"))


def _selected(w, *extra):
    """Item rows with the selected features of the logistic model."""
    scorer = linear(w).scorer("logistic")
    ready = scorer.transform(items(w))
    return scorer, ready.select("order_item_id", *extra, "selected", "rawPrediction")


@key("m13_row_drivers", "SELECT order_item_id, TRUE AS adds_up, TRUE AS falls FROM feat_items")
def _m13(w):
    """Contributions of all features add up to the margin over that of the means; the top ones come first."""
    scorer, rows = _selected(w)
    margin = vector_to_array("rawPrediction")[1]
    # A row's contributions stay together with its margin, so nothing is grouped or joined again.
    parts = explain.linear_contributions(
        rows.withColumn("margin", margin), scorer.model, scorer.selected, scorer.means, ["order_item_id", "margin"],
        k=len(scorer.selected), nested=True,
    )
    own = F.transform(F.array_sort("parts"), lambda x: x["contribution"])
    summed = parts.select("order_item_id", "margin", own.alias("own")).select(
        "order_item_id",
        "margin",
        F.aggregate("own", F.lit(0.0), lambda a, x: a + x).alias("total"),
        F.transform("own", F.abs).alias("sizes"),
    )
    at_means = _margin(scorer, [F.lit(m) for m in scorer.means])
    return summed.select(
        "order_item_id",
        (F.abs(F.col("total") - F.col("margin") + at_means) < 1e-6).alias("adds_up"),
        (F.sort_array("sizes", asc=False) == F.col("sizes")).alias("falls"),
    )


def _highest_risk_rows(scorer, rows):
    """The 50 rows with the highest scores of those predicted late, with what explains them."""
    scored_rows = scorer.transform(rows).select(
        "order_item_id", "selected", "rawPrediction", vector_to_array("probability")[1].alias("p")
    )
    flagged = scored_rows.withColumn("predicted_late", score.predicted_late(scorer.threshold, "p"))
    return evaluate.highest_risk(flagged, "p", "order_item_id")


@key(
    "m13_tree_drivers",
    "SELECT CAST(place AS INTEGER) AS place, TRUE AS adds_up, TRUE AS falls FROM range(1, 51) t(place)",
)
def _m13_trees(w):
    """What drives the scores of the 50 rows of highest risk: contributions and base value add up to the margin, largest first."""
    scorer = candidate(w, "boosted_depth_8").scorer("boosted_depth_8")
    top = _highest_risk_rows(scorer, items(w)).checkpoint()
    parts = explain.tree_contributions(top, scorer.model, scorer.selected, ["order_item_id"], k=len(scorer.selected))
    sizes = F.transform(F.sort_array(F.collect_list(F.struct("rank", "contribution"))), lambda x: F.abs(x["contribution"]))
    summed = parts.groupBy("order_item_id").agg(F.sum("contribution").alias("total"), sizes.alias("sizes"))
    base = explain.LeafPaths.of(scorer.model).base
    order = Window.partitionBy().orderBy(F.desc("p"), "order_item_id")  # 50 rows
    joined = summed.join(top.withColumn("place", F.row_number().over(order)), "order_item_id")
    return joined.select(
        "place",
        (F.abs(F.col("total") + base - vector_to_array("rawPrediction")[1]) < 1e-9).alias("adds_up"),
        (F.sort_array("sizes", asc=False) == F.col("sizes")).alias("falls"),
    )


@key("m13_permutation_importance", "SELECT TRUE AS within_range, TRUE AS repeatable, TRUE AS unused_lose_nothing")
def _m13_permutation(w):
    """Losses of AUC: at most one in size, equal in a second run, none for a constant feature."""
    scorer, rows = _selected(w, F.col(LABEL).cast("int").alias("label"))
    rows = rows.checkpoint()
    first, second = (
        explain.permutation_importance(rows, scorer.model, scorer.selected, "label", ["order_item_id"]) for _ in range(2)
    )
    constant = F.transform(vector_to_array("selected"), lambda x, i: F.when(i == 0, F.lit(scorer.means[0])).otherwise(x))
    flat = explain.permutation_importance(
        rows.withColumn("selected", array_to_vector(constant)), scorer.model, scorer.selected, "label", ["order_item_id"]
    )
    within = all(-1 <= loss <= 1 for _, loss in first)
    return w.spark.createDataFrame(
        [(within, first == second, flat[0][1] == 0)], "within_range boolean, repeatable boolean, unused_lose_nothing boolean"
    )


_METRIC_NAMES = dict(enumerate(runs.METRICS))


def _run_log(w):
    """One metric record per event: a user is a run, the event type the model."""
    events = w.source("events")
    metric = F.element_at(F.array(*[F.lit(m) for m in runs.METRICS]), (F.col("event_id") % 5 + 1).cast("int"))
    return events.select(
        F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"),
        F.col("user_id").cast("int").alias("version"),
        F.make_timestamp_ntz(
            F.lit(2024), F.lit(1), F.lit(1), F.floor(F.col("user_id") / 60 % 24).cast("int"),
            (F.col("user_id") % 60).cast("int"), F.lit(0)
        ).alias("start_time"),
        F.col("event_type").alias("model"),
        metric.alias("metric"),
        F.when(F.col("event_type") != "error", round_to(F.col("value") / 100, 4)).alias("value"),
    )


_RUN_SQL = """SELECT 'run-' || user_id AS run_id, CAST(user_id AS INTEGER) AS version,
  TIMESTAMP '2024-01-01' + to_hours(CAST(floor(user_id / 60) % 24 AS INTEGER)) + to_minutes(user_id % 60) AS start_time,
  event_type AS model, event_id % 5 AS m, CASE WHEN event_type <> 'error' THEN %s END AS value FROM events""".replace(
    "%s", r("value / 100", 4)
)


@key(
    "m14_run_history",
    f"""SELECT * FROM (SELECT run_id, version, start_time, model, {', '.join(
        f'max(CASE WHEN m = {i} THEN value END) AS "{n}"' for i, n in _METRIC_NAMES.items())}
FROM ({_RUN_SQL}) WHERE run_id IN (SELECT run_id FROM (SELECT DISTINCT run_id, start_time FROM ({_RUN_SQL}))
  ORDER BY start_time DESC, run_id LIMIT 50) GROUP BY 1, 2, 3, 4)
WHERE coalesce({', '.join(f'"{n}"' for n in runs.METRICS)}) IS NOT NULL""",
)
def _m14(w):
    return stable(runs.run_history(_run_log(w)))


@key(
    "m14_production_version",
    f"SELECT run_id, version, start_time FROM ({_RUN_SQL}) ORDER BY version DESC LIMIT 1",
)
def _m14_production(w):
    return runs.production_version(_run_log(w))
