"""Model bank: a fitted pipeline and its run record under the model's version."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from scoremill.functions.names import bare_model_name
from scoremill.operators.boosting import BoostedModel
from scoremill.operators.expressions import boosted_margin, scoring_stage

#: Models that come with the package, as text.
MODELS = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "models")


@dataclass(frozen=True)
class Artefact:
    """A fitted pipeline, from raw feature columns to probabilities, and its one-row record."""

    version: str
    model: PipelineModel
    record: DataFrame


def save_artefact(artefact: Artefact, bank: str) -> str:
    """Save pipeline and record; an artefact of the same version is replaced."""
    folder = os.path.join(bank, artefact.version)
    artefact.model.write().overwrite().save(os.path.join(folder, "pipeline"))
    artefact.record.write.mode("overwrite").parquet(os.path.join(folder, "record"))
    return folder


def load_artefact(spark: SparkSession, bank: str, name: str) -> Artefact:
    """Load by version; the artefact suffix of older names is accepted."""
    version = bare_model_name(name)
    folder = os.path.join(bank, version)
    return Artefact(
        version=version,
        model=PipelineModel.load(os.path.join(folder, "pipeline")),
        record=spark.read.parquet(os.path.join(folder, "record")),
    )


def stored_model(name: str) -> BoostedModel:
    """A model that comes with the package, by its version."""
    with open(os.path.join(MODELS, f"{bare_model_name(name)}.json"), encoding="utf-8") as file:
        return BoostedModel.from_json(file.read())


def boosted_artefact(spark: SparkSession, model: BoostedModel, version: str) -> Artefact:
    """An artefact that scores by the model's own expression; its record holds the trees as text."""
    record = spark.createDataFrame([(version, "boosted", model.features, model.to_json())],
                                   "model_version string, learner string, features array<string>, trees string")
    return Artefact(version, PipelineModel([scoring_stage(boosted_margin(model))]), record)
