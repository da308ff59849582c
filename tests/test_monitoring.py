import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from scoremill import testdata
from scoremill.operators.scoring import as_predictions
from scoremill.plans.inference import infer
from scoremill.plans.monitoring import monitor, prediction_label_join, run_monitoring
from scoremill.plans.training import train
from scoremill.schemas import (
    DEBT,
    LABEL_STORE,
    MODEL,
    PREDICTIONS,
    SCORE,
    SNAPSHOT,
    feature_store_schema,
)
from scoremill.session import materialise, shared_root
from scoremill.sources import reports
from scoremill.sources.artefacts import save_artefact

APR, MAY, JUN = date(2024, 4, 1), date(2024, 5, 1), date(2024, 6, 1)
NAME = "model_2024_06_01.pkl"


def stores_of(spark, features, labels=()):
    store = spark.createDataFrame(features, feature_store_schema([DEBT]))
    label_rows = [(c, f"L{c}", y, "d", day) for c, y, day in labels]
    predictions = as_predictions(store.withColumn("score", F.lit(0.5) + F.rand(1) / 10), NAME)
    return predictions, store, spark.createDataFrame(label_rows, LABEL_STORE)


def metrics_of(tables):
    return {r["metric"]: r["value"] for r in tables.summary.collect()}


def test_full_summary(spark):
    features = [(f"c{i}", (APR, MAY, JUN)[i % 3], float(i)) for i in range(60)]
    labels = [(f"c{i}", i % 2, JUN) for i in range(2, 32, 3)]
    tables = monitor(*stores_of(spark, features, labels), NAME, "2024-06-01")
    got = metrics_of(tables)
    assert (got["predictions"], got["features"], got["labels"]) == ("20", "60", "10")
    assert got["feature"] == DEBT and got["psi_status"].startswith("Low risk")
    row = tables.psi.first()
    assert (row[MODEL], row[SNAPSHOT], row["baseline_date"]) == (NAME, JUN, MAY)
    assert got["psi_value"] == f"{row['psi_value']:.4f}"
    assert tables.buckets.count() == 10
    assert {r["feature"]: r["count"] for r in tables.curves.groupBy("feature").count().collect()} == {
        DEBT: 200, SCORE: 200
    }


def test_without_baseline_or_labels(spark):
    features = [(f"c{i}", JUN, float(i)) for i in range(10)]
    got = metrics_of(monitor(*stores_of(spark, features), NAME, JUN))
    assert got == {"predictions": "10", "features": "10"}


def test_baseline_with_negatives_only(spark):
    features = [(f"c{i}", MAY, -1.0) for i in range(5)] + [(f"d{i}", JUN, float(i)) for i in range(5)]
    assert "psi_value" not in metrics_of(monitor(*stores_of(spark, features), NAME, JUN))


def test_labels_that_match_no_prediction_are_counted_as_zero(spark):
    features = [(f"c{i}", JUN, float(i)) for i in range(5)]
    got = metrics_of(monitor(*stores_of(spark, features, [("other", 1, JUN)]), NAME, JUN))
    assert got["labels"] == "0"


def test_feature_that_is_not_in_the_store(spark):
    features = [(f"c{i}", (MAY, JUN)[i % 2], float(i)) for i in range(10)]
    tables = monitor(*stores_of(spark, features), NAME, JUN, watched=["no_such_feature"])
    assert tables.psi.isEmpty() and "psi_value" not in metrics_of(tables)
    assert {r["feature"] for r in tables.curves.select("feature").distinct().collect()} == {SCORE}


def test_current_scope_snapshot(spark):
    features = [(f"c{i}", (APR, MAY, JUN)[i % 3], float(i % 7)) for i in range(60)]
    tables = monitor(*stores_of(spark, features), NAME, JUN, current_scope="snapshot")
    assert metrics_of(tables)["features"] == "20"


def test_inner_join_of_predictions_and_labels(spark):
    predictions, _, labels = stores_of(
        spark, [("a", JUN, 1.0), ("b", JUN, 2.0)], [("a", 1, JUN), ("z", 0, JUN)]
    )
    rows = prediction_label_join(predictions, labels).collect()
    assert [(r["customer_id"], r["label"]) for r in rows] == [("a", 1)]
    assert rows[0].asDict().keys() == {*PREDICTIONS.fieldNames(), "label"}


def test_no_predictions_writes_nothing(spark, tmp_path):
    predictions, store, labels = stores_of(spark, [("a", MAY, 1.0)])
    assert run_monitoring(predictions, store, labels, NAME, JUN, str(tmp_path / "out")) is None
    assert not os.path.exists(tmp_path / "out")


def test_rerun_leaves_the_same_tables(spark, tmp_path):
    features = [(f"c{i}", (APR, MAY, JUN)[i % 3], float(i)) for i in range(60)]
    frames, out = stores_of(spark, features), str(tmp_path)
    for day in (MAY, JUN, JUN):
        run_monitoring(*frames, NAME, day, out)
    history = reports.read_psi_history(spark, os.path.join(out, "psi_results"))
    assert sorted(r[SNAPSHOT] for r in history.collect()) == [MAY, JUN]
    summary = reports.read_summary(spark, os.path.join(out, "summary"))
    assert summary.count() == 10
    text = spark.read.text(os.path.join(out, "summary_text"), wholetext=True)
    assert all("Data Stability (PSI):" in r["value"] for r in text.collect())
    assert spark.read.parquet(os.path.join(out, "psi_buckets")).count() == 20


def test_shared_folder_is_the_sessions_own(spark):
    root = shared_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or root == configured
    frame = materialise(spark.range(5).toDF("x"), "test")
    assert frame.count() == 5
    assert all(root in path for path in frame.inputFiles())


def test_six_months_end_to_end(spark, data, tmp_path):
    """Train once, then score and monitor six snapshots, each from what the last step stored."""
    labels = materialise(testdata.label_store(spark, data), "labels")
    features = materialise(testdata.feature_store(spark, data), "features")
    bank, scored, out = (str(tmp_path / name) for name in ("bank", "predictions", "monitor"))
    one = [{"C": 1, "penalty": "l2", "max_iter": 20}]
    artefact = train(labels, features, "2001-06-01", "logreg", candidates=one).artefact
    save_artefact(artefact, bank)
    days = [date(2001, month, 1) for month in range(1, 7)]
    for day in days:
        infer(features, bank, "model_2001_06_01.pkl", day, scored)
        predictions = reports.read_predictions(spark, scored)
        assert run_monitoring(predictions, features, labels, "model_2001_06_01.pkl", day, out)
    history = reports.read_psi_history(spark, os.path.join(out, "psi_results")).collect()
    assert sorted(r[SNAPSHOT] for r in history) == days
    june = next(r for r in history if r[SNAPSHOT] == days[-1])
    assert round(june["psi_value"], 6) == 0.096841
    counts = reports.read_predictions(spark, scored).groupBy(SNAPSHOT).count().collect()
    expected = features.filter(F.col(SNAPSHOT).isin(days)).groupBy(SNAPSHOT).count().collect()
    assert sorted(counts) == sorted(expected)
    assert pytest.approx(0.5, abs=0.5) == artefact.record.first()["auc"]["oot"]
