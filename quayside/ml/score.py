"""Batch scoring of raw rows with a stored scorer."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import lenient_double
from quayside.ml.boosting import BoostedTrees
from quayside.ml.forest import ForestTrees
from quayside.ml.prepare import Preprocessor
from quayside.sources import files


@dataclass
class Scorer:
    """A classifier with all it takes to score raw rows and to explain the scores."""

    preprocessor: Preprocessor
    selected: list[str]
    model: Model | BoostedTrees | ForestTrees
    threshold: float
    #: Means of the selected features over the training rows.
    means: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        names = [*self.preprocessor.numeric, *self.preprocessor.text]
        slots = [names.index(n) for n in self.selected]
        ready = self.preprocessor.transform(df).withColumn("_x", vector_to_array("features"))
        chosen = array_to_vector(F.transform(F.lit(slots), lambda i: F.get(F.col("_x"), i)))
        return self.model.transform(ready.withColumn("selected", chosen).drop("_x"))

    def save(self, path: str) -> None:
        """Write to a new folder; the settings come last, so a folder that has them is complete."""
        spark = SparkSession.getActiveSession()
        boosted, forest = (isinstance(self.model, c) for c in (BoostedTrees, ForestTrees))
        if boosted or forest:
            self.model.save(spark, f"{path}/trees")
        else:
            PipelineModel(stages=[self.model]).save(f"{path}/model")
        if self.preprocessor.codes is not None:
            self.preprocessor.codes.write.parquet(f"{path}/codes")
        settings = {**self.preprocessor.settings(), "selected": self.selected, "threshold": self.threshold, "means": self.means}
        settings |= {"boosted": boosted, "forest": forest}
        files.replace_text(spark, f"{path}/settings.json", json.dumps(settings))

    @staticmethod
    def load(spark: SparkSession, path: str) -> Scorer:
        text = files.read_text(spark, f"{path}/settings.json")
        if text is None:
            raise FileNotFoundError(f"no stored scorer in {path}")
        s = json.loads(text)
        codes = spark.read.parquet(f"{path}/codes") if s["text"] else None
        scale = {c: tuple(v) for c, v in s["scale"].items()}
        preprocessor = Preprocessor(s["numeric"], s["text"], s["medians"], scale, codes)
        trees = BoostedTrees if s.get("boosted", False) else ForestTrees if s.get("forest", False) else None
        model = trees.load(spark, f"{path}/trees") if trees else PipelineModel.load(f"{path}/model").stages[0]
        return Scorer(preprocessor, s["selected"], model, s["threshold"], s["means"])


def contract_gaps(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> list[str]:
    return [c for c in (*numeric, *text) if c not in df.columns]


def scoring_input(df: DataFrame, numeric: Sequence[str], text: Sequence[str], strict: bool = False) -> DataFrame:
    """Bring rows to the input contract: numbers parsed (unreadable -> NULL), missing columns defaulted.

    NULL numbers take the training median later; missing text is 'Unknown'. Strict input needs every
    column, lenient input at least one.
    """
    missing = contract_gaps(df, numeric, text)
    if missing and (strict or len(missing) == len(numeric) + len(text)):
        raise ValueError(f"columns missing from the input: {', '.join(missing)}")
    columns = {c: F.lit(None).cast("double") if c in missing else lenient_double(c) for c in numeric}
    columns |= {c: F.lit("Unknown") if c in missing else F.col(c).cast("string") for c in text}
    return df.withColumns(columns)


def score(
    scorer: Scorer, df: DataFrame, threshold: float | None = None, strict: bool = False
) -> DataFrame:
    """The input columns plus `prob_late` and `predicted_late`, by the stored threshold unless another is given."""
    ready = scoring_input(df, scorer.preprocessor.numeric, scorer.preprocessor.text, strict)
    scored = scorer.transform(ready).withColumn("prob_late", vector_to_array("probability")[1])
    at = scorer.threshold if threshold is None else threshold
    return scored.select(*df.columns, "prob_late", predicted_late(at))


def predicted_late(threshold: float, column: str = "prob_late"):
    return (F.col(column) >= F.lit(float(threshold))).cast("int").alias("predicted_late")
