"""Training: stores to training set, search, evaluation and run record."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoremill.functions.dates import TrainingWindows
from scoremill.functions.names import model_version
from scoremill.operators.learners import SPACES, UNMAPPED, Params, Preparation, with_score
from scoremill.operators.metrics import auc_and_gini, complete
from scoremill.operators.scaling import fit_scaler
from scoremill.operators.search import SearchResult, boosted_search, logistic_search, random_search, sample_candidates
from scoremill.operators.splits import split_and_folds
from scoremill.operators.training_set import (
    feature_columns,
    label_feature_join,
    with_period,
)
from scoremill.schemas import CUSTOMER, LOAN
from scoremill.session import materialise
from scoremill.sources.artefacts import Artefact
from scoremill.sources.stores import in_window

SPLITS = ("train", "test", "oot")

RECORD = T.StructType(
    [
        T.StructField("model_version", T.StringType()),
        T.StructField("learner", T.StringType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField(
            "data_dates",
            T.StructType(
                [
                    T.StructField(name, T.DateType())
                    for name in (
                        "train_date",
                        "train_test_start",
                        "train_test_end",
                        "oot_start",
                        "oot_end",
                    )
                ]
            ),
        ),
        T.StructField("train_test_ratio", T.DoubleType()),
        T.StructField("row_counts", T.MapType(T.StringType(), T.LongType())),
        T.StructField("label_rates", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("auc", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("gini", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("cv_score", T.DoubleType()),
        T.StructField("hp_params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("unmapped_params", T.ArrayType(T.StringType())),
    ]
)


@dataclass(frozen=True)
class TrainedRun:
    """What a training run leaves: the artefact, the search scores and the scored splits.

    Boosted trees take features as they are, so they have no ``preparation``; logistic models hold the scaler in their
    expression.
    """

    artefact: Artefact
    search: SearchResult
    preparation: Preparation | None
    scored: DataFrame


def training_table(
    labels: DataFrame,
    features: DataFrame,
    windows: TrainingWindows,
    folds: int = 3,
    test_percent: int = 20,
    keep_joined: bool = True,
) -> DataFrame:
    """Labels of the windows joined to their features, with period, split and fold.

    The joined rows are written once (``keep_joined``), because finding the cut-offs and assigning
    the rows read them several times.
    """
    windowed = in_window(labels, windows.train_test_start, windows.oot_end)
    joined = with_period(label_feature_join(windowed, features), windows)
    if keep_joined:
        joined = materialise(joined, "training-set")
    return split_and_folds(joined, folds, test_percent=test_percent)


def train(
    labels: DataFrame,
    features: DataFrame,
    train_date: str | date,
    learner: str = "boosted",
    n_iter: int = 100,
    candidates: Sequence[Params] | None = None,
    oot_months: int = 1,
    train_test_months: int = 3,
    folds: int = 3,
    test_percent: int = 20,
    parallelism: int = 4,
    version_prefix: str = "model",
) -> TrainedRun:
    """Fit the best of ``n_iter`` sampled candidates (or of those given) and evaluate it."""
    windows = TrainingWindows.at(train_date, oot_months, train_test_months)
    table = training_table(labels, features, windows, folds, test_percent)
    names = feature_columns(features)
    in_train = table.filter(F.col("split") == "train")

    candidates = candidates or sample_candidates(SPACES[learner], n_iter)
    if learner == "boosted":
        preparation = None
        search = boosted_search(in_train, names, (CUSTOMER, LOAN), candidates, folds)
        model = PipelineModel([search.model])
    elif learner == "logistic":
        preparation = Preparation(fit_scaler(in_train, names))
        prepared = preparation.scaler.stage().transform(in_train)
        search = logistic_search(prepared, preparation.scaler, candidates, folds)
        model = PipelineModel([search.model])
    else:
        preparation = Preparation(fit_scaler(in_train, names))
        prepared = preparation.apply(table).filter(F.col("split") == "train")
        search = random_search(prepared, learner, candidates, folds, parallelism)
        model = preparation.with_model(search.model)
    scored = with_score(model.transform(table))
    version = model_version(windows.train_date, version_prefix)
    record = _record(version, learner, names, windows, test_percent, scored, search)
    return TrainedRun(Artefact(version, model, record), search, preparation, scored)


def evaluate(scored: DataFrame) -> DataFrame:
    """Rows, label rate, AUC and Gini of each split; the class counts come with the AUC.

    Running it fails if a row has no score or a label other than 0 and 1.
    """
    n_rows = F.col("n_pos") + F.col("n_neg")
    return complete(auc_and_gini(scored.filter(F.col("split").isNotNull()))).select(
        "split",
        n_rows.alias("n_rows"),
        F.round(F.col("n_pos") / n_rows, 2).alias("label_rate"),
        "auc",
        "gini",
    )


def _record(
    version: str,
    learner: str,
    features: list[str],
    windows: TrainingWindows,
    test_percent: int,
    scored: DataFrame,
    search: SearchResult,
) -> DataFrame:
    by_split = {row["split"]: row for row in evaluate(scored).collect()}

    def measured(name: str) -> dict:
        return {split: by_split[split][name] for split in SPLITS if split in by_split}

    row = Row(
        model_version=version,
        learner=learner,
        features=features,
        data_dates=asdict(windows),
        train_test_ratio=1 - test_percent / 100,
        row_counts=measured("n_rows"),
        label_rates=measured("label_rate"),
        auc=measured("auc"),
        gini=measured("gini"),
        cv_score=search.score,
        hp_params={name: str(value) for name, value in search.params.items()},
        unmapped_params=UNMAPPED[learner],
    )
    return scored.sparkSession.createDataFrame([row], RECORD)
