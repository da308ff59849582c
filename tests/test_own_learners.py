"""The package's own learners through a whole training run, the model bank and the monthly jobs."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from scoremill.plans.inference import infer
from scoremill.plans.training import evaluate, train
from scoremill.schemas import LABEL_STORE, MODEL, SNAPSHOT, feature_store_schema
from scoremill.sources import reports, versions
from scoremill.sources.artefacts import boosted_artefact, load_artefact, save_artefact, stored_model

FEATURES = ["debt", "income", "noise"]
MONTHS = [date(2024, month, 1) for month in (1, 2, 3, 4)]
TRAIN_DATE = "2024-05-01"
CANDIDATES = {
    "boosted": [{"n_estimators": 12, "max_depth": 3, "learning_rate": 0.3}],
    "logistic": [{"C": 1, "penalty": "l2", "max_iter": 100}, {"C": 0.001, "penalty": "l1", "max_iter": 100}],
}


@pytest.fixture(scope="module")
def stores(spark):
    draw = random.Random(12)
    labels, features = [], []
    for i in range(800):
        debt, income, noise = (draw.gauss(0, 1) for _ in FEATURES)
        label = int(debt - income + draw.gauss(0, 0.3) > 0)
        labels.append((f"c{i}", f"L{i}", label, "d", MONTHS[i % 4]))
        features.append((f"c{i}", MONTHS[i % 4], debt * 1000, income, noise if i % 50 else None))
    return spark.createDataFrame(labels, LABEL_STORE), spark.createDataFrame(features, feature_store_schema(FEATURES))


@pytest.mark.parametrize("learner", sorted(CANDIDATES))
def test_training_saving_and_scoring(spark, stores, tmp_path, learner):
    run = train(*stores, TRAIN_DATE, learner, candidates=CANDIDATES[learner])
    rows = {r["split"]: r for r in evaluate(run.scored).collect()}
    assert min(r["auc"] for r in rows.values()) > 0.9
    record = run.artefact.record.first()
    assert record["learner"] == learner and record["features"] == FEATURES
    assert run.search.scores.count() == 3 * len(CANDIDATES[learner])
    assert run.search.params == CANDIDATES[learner][0]

    bank, scored = str(tmp_path / "bank"), str(tmp_path / "predictions")
    save_artefact(run.artefact, bank)
    first = infer(stores[1], bank, f"{run.artefact.version}.pkl", MONTHS[3], scored)
    assert {r[MODEL] for r in first.select(MODEL).distinct().collect()} == {"model_2024_05_01"}
    by_id = {r["customer_id"]: r["score"] for r in run.scored.filter("split = 'oot'").collect()}
    assert {r["customer_id"]: r["model_predictions"] for r in first.collect()} == pytest.approx(by_id)
    assert "EvalPython" not in first._jdf.queryExecution().executedPlan().toString()

    # A rerun without rows leaves none, and one that fails leaves what was there.
    with pytest.raises(Exception):
        infer(stores[1].withColumn("debt", F.raise_error(F.lit("lost"))), bank, run.artefact.version, MONTHS[3], scored)
    assert reports.read_predictions(spark, scored).count() == 200
    assert infer(stores[1].limit(0), bank, run.artefact.version, MONTHS[3], scored).count() == 0
    assert versions.current(spark, scored)[0] == 2


def test_the_default_is_the_learner_of_the_original(stores, monkeypatch):
    from scoremill.plans import training

    asked = {}

    def remember(train_rows, features, keys, candidates, folds):
        asked.update(n=len(candidates), names=set(candidates[0]))
        raise StopIteration

    monkeypatch.setattr(training, "boosted_search", remember)
    with pytest.raises(StopIteration):
        train(*stores, TRAIN_DATE)
    assert asked["n"] == 100 and len(asked["names"]) == 9


def test_the_stored_model_is_scored_from_a_bank(spark, tmp_path):
    model = stored_model("model_2001_06_01.pkl")
    save_artefact(boosted_artefact(spark, model, "model_2001_06_01"), str(tmp_path))
    loaded = load_artefact(spark, str(tmp_path), "model_2001_06_01")
    rows = spark.createDataFrame([("a", MONTHS[0], *[float(i)] * 7) for i in range(5)] + [("n", MONTHS[0], *[None] * 7)],
                                 feature_store_schema(model.features))
    assert all(0 < r["score"] < 1 for r in loaded.model.transform(rows).collect())
    assert loaded.record.first()["trees"] == model.to_json() and SNAPSHOT in rows.columns
