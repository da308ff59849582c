"""The classifiers, addressed by the parameter names users know from their Python originals.

``boosted`` are the package's own second-order trees with all nine parameters of the original search
(``operators/boosting.py``), ``logistic`` its own logistic regression with the penalised intercept of the
original (``operators/logistic.py``); both grow all fits of a search in the same passes. ``gbt`` and
``logreg`` are MLlib's: trees that behave alike but have no counterpart of the parameters named in
``UNMAPPED``, and a logistic regression whose intercept is not penalised.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from scoremill.operators.scaling import MISSING, SCALED, Scaler
from scoremill.schemas import LABEL

Params = Mapping[str, object]

SEED = 88
INPUTS = "features"

# The search space of each learner.
GBT_SPACE: dict[str, list] = {
    "n_estimators": [25, 50],
    "max_depth": [2, 3],
    "learning_rate": [0.01, 0.1],
    "subsample": [0.6, 0.8],
    "colsample_bytree": [0.6, 0.8],
    "gamma": [0, 0.1],
    "min_child_weight": [1, 3, 5],
}
BOOSTED_SPACE: dict[str, list] = {
    **GBT_SPACE,
    "reg_alpha": [0, 0.1, 1],
    "reg_lambda": [1, 1.5, 2],
}
LOGREG_SPACE: dict[str, list] = {
    "C": [0.01, 0.1, 1, 10],
    "penalty": ["l1", "l2"],
    "max_iter": [100, 200, 300],
}
UNMAPPED = {"boosted": [], "gbt": ["reg_alpha", "reg_lambda"], "logistic": ["solver"], "logreg": ["solver"]}


def gbt(params: Params, n_rows: int) -> Estimator:
    """Gradient-boosted trees; ``n_rows`` plays no part."""
    return GBTClassifier(
        featuresCol=INPUTS,
        labelCol=LABEL,
        seed=SEED,
        maxIter=int(params.get("n_estimators", 50)),
        maxDepth=int(params.get("max_depth", 3)),
        stepSize=float(params.get("learning_rate", 0.1)),
        subsamplingRate=float(params.get("subsample", 0.8)),
        featureSubsetStrategy=str(float(params.get("colsample_bytree", 0.8))),
        minInfoGain=float(params.get("gamma", 0)),
        minInstancesPerNode=int(params.get("min_child_weight", 1)),
    )


def logreg(params: Params, n_rows: int) -> Estimator:
    """Logistic regression; ``C`` weighs the loss of all rows, so the penalty here is 1/(C·rows)."""
    return LogisticRegression(
        featuresCol=INPUTS,
        labelCol=LABEL,
        standardization=False,
        maxIter=int(params.get("max_iter", 100)),
        regParam=1.0 / (float(params.get("C", 1)) * n_rows),
        elasticNetParam=1.0 if params.get("penalty", "l2") == "l1" else 0.0,
    )


LEARNERS = {"gbt": gbt, "logreg": logreg}
SPACES = {"boosted": BOOSTED_SPACE, "gbt": GBT_SPACE, "logistic": LOGREG_SPACE, "logreg": LOGREG_SPACE}


@dataclass(frozen=True)
class Preparation:
    """Scaling and assembling: what turns feature columns into the learner's input vector."""

    scaler: Scaler
    stages: list = field(init=False)

    def __post_init__(self) -> None:
        assembler = VectorAssembler(inputCols=self.scaler.inputs(), outputCol=INPUTS)
        object.__setattr__(self, "stages", [self.scaler.stage(), assembler])

    def apply(self, df: DataFrame) -> DataFrame:
        return PipelineModel(self.stages).transform(df)

    def with_model(self, model: Model) -> PipelineModel:
        return PipelineModel([*self.stages, model])


def with_score(predictions: DataFrame, name: str = "score") -> DataFrame:
    """Add the probability of class 1 as a plain double; models that are an expression have done so."""
    if name in predictions.columns and "probability" not in predictions.columns:
        return predictions
    return predictions.withColumn(name, vector_to_array("probability")[1])


def importances(model: Model, scaler: Scaler) -> dict[str, float]:
    """Importance per feature; that of its missing flag counts towards the feature."""
    by_input = dict(zip(scaler.inputs(), model.featureImportances.toArray(), strict=True))
    return {
        name: float(by_input[name + SCALED] + by_input[name + MISSING])
        for name in scaler.features
    }
