"""Importance-based selection and the five candidate classifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.config import LABEL
from quayside.ml.boosting import BoostedTrees, Boosting, binned, column_cuts, fit_boosted
from quayside.ml.evaluate import best_threshold, metrics_by_model, score_totals
from quayside.ml.forest import Forest, ForestTrees, fit_forest
from quayside.ml.prepare import Preprocessor, fit_preprocessor, prepared
from quayside.ml.score import Scorer
from quayside.ml.split import class_ratio, stratified_split
from quayside.session import kept
from quayside.sources import files

IMPORTANCE_CUTOFF = 0.005
#: Rows of a partition of the table that candidates are fitted on.
FIT_PARTITION_ROWS = 50_000


@dataclass(frozen=True)
class Effort:
    """Sizes of the candidates. Selection and classifiers are fitted on all training rows, unless a caller bounds them by `fit_rows`, as
    quick trials do: no query and no refresh does. Such a bound chooses rows by a hash of their key; medians, scales, codes, thresholds and
    metrics come from all rows even then.
    """

    boosting_rounds: int = 1000
    selection_rounds: int = 100
    selection_rate: float = 0.3
    forest_trees: int = 300
    forest_depth: int = 30
    logistic_iterations: int = 5000
    learning_rate: float = 0.03
    fit_rows: int | None = None
    seed: int = 42


CANDIDATES = ("boosted_depth_8", "boosted_leaves_40", "boosted_depth_8_sampled", "random_forest", "logistic")


def candidates(effort: Effort) -> dict[str, Boosting | Forest | Estimator]:
    """Three boosted variants, a forest and a linear model, all weighted; by the names of CANDIDATES."""
    rounds, rate, seed = effort.boosting_rounds, effort.learning_rate, effort.seed
    return {
        "boosted_depth_8": Boosting(rounds, rate, depth=8, seed=seed),
        "boosted_leaves_40": Boosting(rounds, rate, leaves=40, seed=seed),
        "boosted_depth_8_sampled": Boosting(rounds, rate, depth=8, sampled=0.8, seed=seed),
        "random_forest": Forest(effort.forest_trees, effort.forest_depth, seed=seed),
        "logistic": LogisticRegression(
            featuresCol="selected",
            labelCol="label",
            weightCol="weight",
            maxIter=effort.logistic_iterations,
        ),
    }


def labelled(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn("label", F.col(label).cast("int").cast("double"))


def weighted(df: DataFrame, positive_weight: float) -> DataFrame:
    return df.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0)))


def feature_importance(rows: DataFrame, cuts: list[list[float]], names: Sequence[str], effort: Effort) -> list[tuple[str, float]]:
    """(feature, importance) of a boosted model of binned rows without weights, one entry per feature."""
    settings = Boosting(effort.selection_rounds, effort.selection_rate, depth=6, seed=effort.seed)
    model = fit_boosted(rows.withColumn("weight", F.lit(1.0)), cuts, settings)
    return list(zip(names, model.importances()))


def selected_features(importance: Sequence[tuple[str, float]], cutoff: float = IMPORTANCE_CUTOFF) -> list[str]:
    return [name for name, value in importance if value > cutoff]


@dataclass
class TrainingRun:
    preprocessor: Preprocessor
    names: list[str]
    importance: list[tuple[str, float]]
    selected: list[str]
    models: dict[str, Model | BoostedTrees | ForestTrees]
    thresholds: dict[str, float]
    metrics: list[dict]
    sizes: dict[str, int]
    means: list[float]
    #: model, split, label and score of every held-out row.
    scores: DataFrame

    @property
    def best(self) -> str:
        return max(self.metrics, key=lambda m: m["f1"])["model"]

    def scorer(self, name: str | None = None) -> Scorer:
        """Raw rows in, scored rows out; can be stored and loaded."""
        name = name or self.best
        return Scorer(self.preprocessor, self.selected, self.models[name], self.thresholds[name], self.means)

    def parameters(self) -> dict[str, str]:
        return {
            **{f"{split}_rows": str(n) for split, n in sorted(self.sizes.items())},
            "n_features_original": str(len(self.names)),
            "n_features_selected": str(len(self.selected)),
            "feature_importance_cutoff": str(IMPORTANCE_CUTOFF),
            "best_model": self.best,
        }


def bounded(rows: DataFrame, total: int, fit_rows: int | None) -> DataFrame:
    """All rows, or about `fit_rows` of them by the hash mark they carry, in partitions that suit their number."""
    if fit_rows is not None and total > fit_rows:
        few = rows.filter(F.col("_mark") < int(-(2**63) + 2**64 * fit_rows / total))
        # Only the rows kept are moved: coalesced instead, the few tasks would each read a large part of the table to find them.
        return few.repartition(max(1, -(-fit_rows // FIT_PARTITION_ROWS)), "_mark").sortWithinPartitions("_mark")
    return rows.coalesce(max(1, -(-total // FIT_PARTITION_ROWS)))


@dataclass
class PreparedTraining:
    """What all candidates share: split and prepared rows, the features chosen, and the rows to fit on."""

    preprocessor: Preprocessor
    names: list[str]
    importance: list[tuple[str, float]]
    selected: list[str]
    sizes: dict[str, int]
    means: list[float]
    effort: Effort
    #: Rows to fit on: as vectors, and as bins with the cut points of their columns.
    fit_on: DataFrame
    bins: DataFrame
    cuts: list[list[float]]
    held_out: DataFrame


def prepare_training(
    rows: DataFrame, keys: Sequence[str], numeric: Sequence[str], text: Sequence[str], label: str = LABEL, effort: Effort = Effort()
) -> PreparedTraining:
    """Split, prepare on training rows, and select features."""
    # Another hash than the split's, else the bound would take one end of it.
    mark = F.xxhash64(F.lit("fit"), *keys, F.lit(effort.seed)).alias("_mark")
    # Stored once: the split, medians, scales, codes and the preparation each read it, not the joins behind it.
    base = kept(labelled(rows, label).select(*keys, "label", mark, *[c for c in (*numeric, *text) if c not in keys]), "training")
    parts = stratified_split(base, "label", keys, seed=effort.seed).select("split", "label", "_mark", *numeric, *text)
    preprocessor = fit_preprocessor(parts.filter("split = 'train'"), numeric, text)
    names = [*numeric, *text]
    ready = kept(prepared(preprocessor, parts, ["split", "label", "_mark"]), "prepared")
    sizes = {r["split"]: r["count"] for r in ready.groupBy("split").count().collect()}
    positive_weight = class_ratio(parts, "label").first()["class_ratio"]
    # All that is asked of the rows as they came is known by now.
    files.delete(base.sparkSession, base.inputFiles()[0].rsplit("/", 1)[0])
    fit_on = bounded(ready.filter("split = 'train'"), sizes["train"], effort.fit_rows)
    # Read from the prepared table whenever they are asked for, not stored a second time; rounds and trees read their bins, a byte a feature.
    fit_on = weighted(fit_on, positive_weight).withColumnRenamed("_mark", "mark")
    if effort.fit_rows is not None:
        fit_on = kept(fit_on, "fitted")
    cuts = column_cuts(fit_on, "features", len(names))
    importance = feature_importance(kept(binned(fit_on, "features", cuts), "bins"), cuts, names, effort)
    selected = selected_features(importance) or names
    places = [names.index(n) for n in selected]
    slicer = VectorSlicer(inputCol="features", outputCol="selected", indices=places)
    fit_on, everything = (slicer.transform(df).drop("features") for df in (fit_on, weighted(ready, positive_weight)))
    own = [cuts[i] for i in places]
    arrays = everything.filter("split = 'train'").select(vector_to_array("selected").alias("x"))
    means = arrays.agg(*[F.avg(F.col("x")[i]) for i in range(len(selected))]).first()
    return PreparedTraining(
        preprocessor, names, importance, selected, sizes, list(means), effort,
        fit_on, kept(binned(fit_on, "selected", own), "bins"), own, everything.filter("split <> 'train'"),
    )


def fit_candidates(
    ready: PreparedTraining, only: Sequence[str] | None = None, fitted: Mapping[str, Model | BoostedTrees | ForestTrees] | None = None
) -> TrainingRun:
    """Fit the candidates (but for those `fitted` before), choose thresholds on validation rows, evaluate on test rows."""
    chosen = {n: e for n, e in candidates(ready.effort).items() if only is None or n in only}
    models = {n: m for n, m in (fitted or {}).items() if n in chosen}

    def fit(name: str) -> Model | BoostedTrees | ForestTrees:
        own = chosen[name]
        if isinstance(own, Boosting):
            return fit_boosted(ready.bins, ready.cuts, own)
        return fit_forest(ready.bins, ready.cuts, own) if isinstance(own, Forest) else own.fit(ready.fit_on)

    # Most candidates are chains of small jobs; run side by side they share the cluster.
    open_ = [n for n in chosen if n not in models]
    with ThreadPoolExecutor(max(1, len(open_))) as pool:
        models |= dict(zip(open_, pool.map(fit, open_)))
    models = {n: models[n] for n in chosen}
    scores = [
        model.transform(ready.held_out).select(
            F.lit(name).alias("model"),
            "split",
            F.col("label").cast("int").alias("label"),
            vector_to_array("probability")[1].alias("score"),
        )
        for name, model in models.items()
    ]
    # All models are evaluated together: one curve, one confusion matrix and one AUC per model.
    scored = kept(reduce(DataFrame.unionByName, scores), "scores")
    validation = score_totals(scored.filter("split = 'validation'"), "label", "score", by="model")
    thresholds = {r["model"]: r["threshold"] for r in best_threshold(validation, by="model").collect()}
    own = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])[F.col("model")]
    test = metrics_by_model(scored.filter("split = 'test'"), "label", "score", own)
    metrics = sorted((r.asDict() for r in test.collect()), key=lambda m: -(m["f1"] or 0.0))
    return TrainingRun(
        ready.preprocessor, ready.names, ready.importance, ready.selected, models, thresholds, metrics, ready.sizes, ready.means, scored
    )


def train_models(
    rows: DataFrame,
    keys: Sequence[str],
    numeric: Sequence[str],
    text: Sequence[str],
    label: str = LABEL,
    effort: Effort = Effort(),
    only: Sequence[str] | None = None,
) -> TrainingRun:
    """Split, prepare on training rows, select, fit, choose thresholds on validation, score on test."""
    return fit_candidates(prepare_training(rows, keys, numeric, text, label, effort), only)
