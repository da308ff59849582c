"""Inference: a saved model and one feature snapshot to the prediction store."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.functions.dates import parse_date
from scoremill.functions.names import bare_model_name
from scoremill.operators.scoring import score_snapshot
from scoremill.schemas import MODEL, SNAPSHOT
from scoremill.sources.artefacts import load_artefact
from scoremill.sources.reports import read_predictions, write_predictions
from scoremill.sources.stores import at_snapshot


def infer(
    features: DataFrame, bank: str, model_name: str, day: str | date, predictions_root: str
) -> DataFrame:
    """Score the snapshot, replace its partition of the prediction store and return that partition.

    Rows become visible at one stroke when all are written; a rerun without rows leaves no old ones. Predictions
    carry the model's bare name, with or without the artefact suffix in ``model_name``.
    """
    spark, name = features.sparkSession, bare_model_name(model_name)
    artefact = load_artefact(spark, bank, name)
    predictions = score_snapshot(features, artefact.model, name, day)
    write_predictions(predictions, predictions_root, [{MODEL: name, SNAPSHOT: parse_date(day)}])
    stored = read_predictions(spark, predictions_root)
    return at_snapshot(stored.filter(F.col(MODEL) == name), day)
