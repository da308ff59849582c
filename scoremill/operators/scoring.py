"""Batch scoring of one snapshot with a named model."""

from __future__ import annotations

from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.operators.learners import with_score
from scoremill.schemas import CUSTOMER, MODEL, PREDICTIONS, SCORE, SNAPSHOT
from scoremill.sources.stores import at_snapshot


def as_predictions(scored: DataFrame, model_name: str, score: str = "score") -> DataFrame:
    """Keys, the model's name and the score, in the layout of the prediction store."""
    return scored.select(
        CUSTOMER, SNAPSHOT, F.lit(model_name).alias(MODEL), F.col(score).cast("double").alias(SCORE)
    ).select(PREDICTIONS.fieldNames())


def score_snapshot(
    features: DataFrame, model: PipelineModel, model_name: str, day: str | date
) -> DataFrame:
    """Predictions for every feature row of one snapshot."""
    return as_predictions(with_score(model.transform(at_snapshot(features, day))), model_name)
