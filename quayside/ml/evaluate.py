"""Precision-recall curve, thresholds, confusion metrics and AUC as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import flag_sum, ratio
from quayside.operators.running import running_totals
from quayside.session import kept

BINS = 20


def score_totals(df: DataFrame, label: str, score: str, by: str | None = None) -> DataFrame:
    """score, pos, neg (per `by`): rows folded to distinct scores, however many share one."""
    y = F.col(label).cast("int")
    return df.groupBy(*([by] if by else []), F.col(score).alias("score")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")
    )


def precision_recall(totals: DataFrame, by: str | None = None) -> DataFrame:
    """threshold, precision, recall for every distinct score: rows at or above it count as positive."""
    totals = kept(totals, "totals")  # the curve and the number of positives read it
    curve = running_totals(totals, "score", ["pos", "neg"], descending=True, partition=by, stored=True)
    if by:
        curve = curve.join(totals.groupBy(by).agg(F.sum("pos").alias("positives")), by)
        positives = F.col("positives")
    else:
        positives = totals.agg(F.sum("pos")).scalar()
    return curve.select(
        *([by] if by else []),
        F.col("score").alias("threshold"),
        F.col("cum_pos").alias("true_positives"),
        F.col("cum_neg").alias("false_positives"),
        ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        ratio(F.col("cum_pos"), positives).alias("recall"),
    )


def best_threshold(totals: DataFrame, by: str | None = None) -> DataFrame:
    """One row (per `by`): the threshold where precision and recall are closest, the lowest on a tie."""
    gap = F.abs(F.col("precision") - F.col("recall"))
    best = F.min(F.struct(gap.alias("gap"), "threshold", "precision", "recall")).alias("best")
    keys = [by] if by else []
    curve = precision_recall(totals, by)
    return curve.groupBy(*keys).agg(best).select(*keys, "best.threshold", "best.precision", "best.recall")


def auc(totals: DataFrame, by: str | None = None) -> DataFrame:
    """Rank-sum AUC (per `by`); tied scores count half."""
    curve = running_totals(totals, "score", ["neg"], partition=by)
    below = F.col("cum_neg") - F.col("neg")
    return curve.groupBy(*([by] if by else [])).agg(
        ratio(
            F.sum(F.col("pos") * (below + F.col("neg") / 2)), F.sum("pos").cast("double") * F.sum("neg")
        ).alias("auc")
    )


def confusion_columns(label: str, score: str, threshold: Column | float) -> list[Column]:
    predicted = F.col(score) >= threshold
    actual = F.col(label).cast("int") == 1
    return [
        flag_sum(predicted & actual).alias("tp"),
        flag_sum(predicted & ~actual).alias("fp"),
        flag_sum(~predicted & actual).alias("fn"),
        flag_sum(~predicted & ~actual).alias("tn"),
    ]


def rates(confusion: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1 from tp / fp / fn / tp; 0 where a rate has no rows."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    zero = F.lit(0.0)
    return confusion.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + fp + fn + tn),
            "precision": F.coalesce(ratio(tp, tp + fp), zero),
            "recall": F.coalesce(ratio(tp, tp + fn), zero),
            "f1": F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), zero),
        }
    )


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """One row: accuracy, precision, recall, f1 at the threshold, and AUC."""
    confusion = rates(df.agg(*confusion_columns(label, score, threshold)))
    area = auc(score_totals(df, label, score)).scalar()
    return confusion.select("accuracy", "precision", "recall", "f1", area.alias("auc"))


def metrics_by_model(df: DataFrame, label: str, score: str, threshold: Column, by: str = "model") -> DataFrame:
    """`classification_metrics` of many models at once, each at its own threshold."""
    confusion = rates(df.groupBy(by).agg(*confusion_columns(label, score, threshold)))
    areas = auc(score_totals(df, label, score, by), by)
    return confusion.join(areas, by).select(by, "accuracy", "precision", "recall", "f1", "auc")


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Models by F1, best first."""
    return metrics.orderBy(F.desc_nulls_last("f1"), F.asc("model"))


def best_model(metrics: DataFrame) -> DataFrame:
    best = F.max_by(F.struct("model", "threshold", "f1"), F.col("f1")).alias("b")
    return metrics.agg(best).select("b.*")


def score_histogram(df: DataFrame, score: str, bins: int = BINS) -> DataFrame:
    """Rows per equal-width bin over [0, 1]; 1.0 belongs to the last bin."""
    bin_index = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(bin_index.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))


def score_summary(df: DataFrame, predicted: str = "predicted_late") -> DataFrame:
    """Total, late, on time, late share in percent."""
    late = F.sum(predicted)
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total_orders"),
        late.alias("late_orders"),
        (total - late).alias("on_time_orders"),
        (ratio(late.cast("double"), total) * 100).alias("late_rate_pct"),
    )


def highest_risk(df: DataFrame, score: str, tie: str, k: int = 50, only_late: bool = True) -> DataFrame:
    kept = df.filter("predicted_late = 1") if only_late else df
    return kept.orderBy(F.desc_nulls_last(score), F.asc(tie)).limit(k)


def with_correct(df: DataFrame, actual: str = "actual_late", predicted: str = "predicted_late") -> DataFrame:
    """Add `correct` when the actual label is there."""
    if actual not in df.columns:
        return df
    return df.withColumn("correct", (F.col(actual).cast("int") == F.col(predicted)).cast("int"))
