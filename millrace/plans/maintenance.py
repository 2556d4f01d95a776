"""Failure prediction from sensor windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import evaluation, sensors
from millrace.operators.boosting import BoostedTrees, fit_trees
from millrace.operators.model import class_weight
from millrace.session import staged

LABEL = "failure_in_24h"


@dataclass(frozen=True)
class FailureModel:
    pipeline: PipelineModel
    trees: BoostedTrees
    holdout: DataFrame

    def report(self) -> DataFrame:
        return evaluation.classification_report(self.holdout, LABEL)

    def auc(self) -> DataFrame:
        return evaluation.auc(self.holdout, LABEL)


def _scored(pipeline: PipelineModel, trees: BoostedTrees, df: DataFrame, *keep: str) -> DataFrame:
    out = pipeline.transform(df).withColumn("score", trees.probability())
    return out.select(*keep, "score", (F.col("score") > 0.5).cast("int").alias("prediction"))


def train_failure_model(readings: DataFrame, rounds: int = 50, test_share: float = 0.2,
                        seed: int = 42) -> FailureModel:
    """Classify windows by whether a failure follows within a day.

    Windows of one machine overlap, so whole machines are held out: a random split of windows
    would put nearly the same window on both sides. A missing feature gets the training median.
    """
    windows = sensors.window_features(sensors.label_failures(readings))
    side = F.pmod(F.xxhash64(F.col(sensors.MACHINE), F.lit(seed)), F.lit(1000)) < test_share * 1000
    rows = staged(
        windows.select(
            sensors.MACHINE, sensors.READING, LABEL, *sensors.WINDOW_FEATURES, side.alias("is_test")
        ), "windows",
    )
    train = rows.where("not is_test")
    weight = class_weight(train, LABEL).first()["weight"] or 1.0
    filled = [f"{c}_filled" for c in sensors.WINDOW_FEATURES]
    imputer = Imputer(
        strategy="median", inputCols=sensors.WINDOW_FEATURES, outputCols=filled).fit(train)
    assembler = VectorAssembler(inputCols=filled, outputCol="features")
    pipeline = PipelineModel([imputer, assembler])
    trees = fit_trees(
        staged(pipeline.transform(train).select(LABEL, "features"), "filled_windows"), LABEL,
        weight=weight, rounds=rounds, depth=5, rate=0.1, share=0.8, seed=seed)
    held = _scored(pipeline, trees, rows.where("is_test"), sensors.MACHINE, sensors.READING, LABEL)
    return FailureModel(pipeline, trees, staged(held, "scored_windows"))


def score_failures(model: FailureModel, readings: DataFrame) -> DataFrame:
    """The health table of every machine, by the model: most endangered machine first.

    The probability is the model's for the newest window; for a machine without a full one it comes
    from the deviation of its newest reading (``health_scores``), null if that lacks a channel.
    """
    known = readings.where(F.col(sensors.MACHINE).isNotNull())
    full = _scored(model.pipeline, model.trees, sensors.latest_features(known), sensors.MACHINE)
    both = sensors.health_scores(known).join(full, sensors.MACHINE, "left")
    scores = both.withColumn("probability", F.coalesce("score", "probability"))
    return sensors.health_table(scores).orderBy(F.desc("failure_probability"), "machine_id")
