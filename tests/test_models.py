import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from scoremill import registry
from scoremill.operators import learners
from scoremill.operators.metrics import auc
from scoremill.operators.scoring import score_snapshot
from scoremill.operators.search import sample_candidates, search_plan
from scoremill.plans.training import evaluate, train
from scoremill.schemas import LABEL_STORE, feature_store_schema
from scoremill.sources.artefacts import load_artefact, save_artefact

FEATURES = ["debt", "income", "noise"]
MONTHS = [date(2024, month, 1) for month in (1, 2, 3, 4)]
TRAIN_DATE = "2024-05-01"
ONE = {
    "gbt": [{"n_estimators": 25, "max_depth": 3, "learning_rate": 0.1}],
    "logreg": [{"C": 1, "penalty": "l2", "max_iter": 100}],
}


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """800 customers whose label depends on two of three features; some features are missing."""
    rng = random.Random(11)
    labels, features = [], []
    for i in range(800):
        debt, income, noise = (rng.gauss(0, 1) for _ in FEATURES)
        label = int(debt - income + rng.gauss(0, 0.3) > 0)
        day = MONTHS[i % 4]
        labels.append((f"c{i}", f"L{i}", label, "d", day))
        features.append((f"c{i}", day, debt * 1000, income, noise if i % 50 else None))
    root = tmp_path_factory.mktemp("planted")
    frames = []
    for name, rows, schema in (
        ("labels", labels, LABEL_STORE),
        ("features", features, feature_store_schema(FEATURES)),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(root / name))
        frames.append(spark.read.schema(schema).parquet(str(root / name)))
    return tuple(frames)


@pytest.fixture(scope="module")
def runs(planted):
    return {name: train(*planted, TRAIN_DATE, name, candidates=ONE[name]) for name in ONE}


@pytest.fixture(scope="module")
def sizes(planted):
    """Rows of each split: a fifth of each label, rounded up, is tested; the last month is oot."""
    labels = planted[0].groupBy("snapshot_date", "label").count().collect()
    in_window = Counter()
    for row in labels:
        if row["snapshot_date"] != MONTHS[3]:
            in_window[row["label"]] += row["count"]
    tested = sum(-(-n // 5) for n in in_window.values())
    return {"train": 600 - tested, "test": tested, "oot": 200}


@pytest.mark.parametrize("learner", ["gbt", "logreg"])
def test_planted_signal_is_found(runs, sizes, learner):
    rows = {r["split"]: r for r in evaluate(runs[learner].scored).collect()}
    assert {split: r["n_rows"] for split, r in rows.items()} == sizes
    assert min(r["auc"] for r in rows.values()) > 0.9
    assert all(r["gini"] == round(2 * r["auc"] - 1, 3) for r in rows.values())


def test_noise_ranks_last(runs):
    run = runs["gbt"]
    ranked = learners.importances(run.search.model, run.preparation.scaler)
    assert min(ranked, key=ranked.get) == "noise"
    assert sum(ranked.values()) == pytest.approx(1)


@pytest.mark.parametrize("learner", ["gbt", "logreg"])
def test_saved_model_scores_the_same(spark, planted, runs, sizes, learner, tmp_path):
    artefact = runs[learner].artefact
    for _ in range(2):
        save_artefact(artefact, str(tmp_path))
    loaded = load_artefact(spark, str(tmp_path), "model_2024_05_01.pkl")
    assert loaded.version == artefact.version == "model_2024_05_01"
    before, after = (
        sorted(map(tuple, score_snapshot(planted[1], m, "m", MONTHS[3]).collect()))
        for m in (artefact.model, loaded.model)
    )
    assert len(before) == 200 and before == after
    assert all(0 <= row[3] <= 1 for row in before)
    oot = runs[learner].scored.filter("split = 'oot'").select("split", "label", "score")
    rescored = learners.with_score(loaded.model.transform(runs[learner].scored.drop(
        "score", "features", "probability", "prediction", "rawPrediction", *runs[learner].preparation.scaler.inputs()
    ))).filter("split = 'oot'").select("split", "label", "score")
    assert auc(oot).first()["auc"] == auc(rescored).first()["auc"]
    record = loaded.record.first()
    assert record["learner"] == learner and record["features"] == FEATURES
    assert record["data_dates"]["oot_start"] == MONTHS[3]
    assert record["row_counts"] == sizes
    assert record["gini"]["oot"] == round(2 * record["auc"]["oot"] - 1, 3)
    assert record["train_test_ratio"] == 0.8


def test_search_picks_the_better_candidate(planted):
    weak = {"C": 0.0001, "penalty": "l1", "max_iter": 100}
    result = train(*planted, TRAIN_DATE, "logreg", candidates=[weak, *ONE["logreg"]]).search
    assert result.params == ONE["logreg"][0]
    assert result.scores.count() == 6
    best = result.scores.filter("candidate = 1").agg(F.avg("auc")).first()[0]
    assert result.score == pytest.approx(best) and best > 0.8


def test_search_spaces():
    assert len(sample_candidates(learners.GBT_SPACE, 1000)) == 192
    sampled = sample_candidates(learners.GBT_SPACE)
    assert len(sampled) == 100 == len({tuple(c.values()) for c in sampled})
    assert sampled == sample_candidates(learners.GBT_SPACE)
    assert sampled != sample_candidates(learners.GBT_SPACE, seed=43)
    assert len(sample_candidates(learners.LOGREG_SPACE)) == 24


def test_search_plan_lists_every_fit(spark):
    folded = spark.createDataFrame([(i % 3, i % 2) for i in range(31)], "fold int, label int")
    plan = search_plan(folded, sample_candidates(learners.LOGREG_SPACE, 5)).collect()
    assert len(plan) == 15
    assert all(r["n_scored"] + r["n_fitted"] == 31 for r in plan)


def test_parameters_reach_the_learners():
    params = dict(zip(learners.GBT_SPACE, (50, 2, 0.01, 0.6, 0.8, 0.1, 5), strict=True))
    tree = learners.gbt(params, 100)
    assert (tree.getMaxIter(), tree.getMaxDepth(), tree.getStepSize()) == (50, 2, 0.01)
    assert (tree.getSubsamplingRate(), tree.getFeatureSubsetStrategy()) == (0.6, "0.8")
    assert (tree.getMinInfoGain(), tree.getMinInstancesPerNode(), tree.getSeed()) == (0.1, 5, 88)
    line = learners.logreg({"C": 10, "penalty": "l1", "max_iter": 300}, 200)
    assert (line.getRegParam(), line.getElasticNetParam(), line.getMaxIter()) == (1 / 2000, 1.0, 300)
    assert not line.getStandardization()


def test_failures_are_raised(planted):
    labels, features = planted
    with pytest.raises(Exception):
        train(labels.filter("label = 1"), features, TRAIN_DATE, "unknown learner")


def test_run_record_comes_from_the_whole_search(spark, data, monkeypatch):
    asked = {}

    def remember(labels, features, train_date, learner, **options):
        asked.update(options, learner=learner)
        raise StopIteration

    monkeypatch.setattr(registry.training, "train", remember)
    with pytest.raises(StopIteration):
        registry.run_record(spark, data)
    space = learners.SPACES[asked["learner"]]
    assert asked.get("candidates") is None
    assert len(sample_candidates(space, asked["n_iter"])) == len(sample_candidates(space, 10_000))
