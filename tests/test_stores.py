import os
from datetime import date


import pytest
from pyspark.errors import AnalysisException
from scoremill.schemas import (
    DEBT,
    LABEL_STORE,
    MODEL,
    PREDICTIONS,
    PSI_RESULTS,
    SNAPSHOT,
    SUMMARY,
    feature_store_schema,
)
from scoremill.sources import reports, stores

JAN, FEB = date(2024, 1, 1), date(2024, 2, 1)
FEATURES = feature_store_schema([DEBT])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_store_scan_prunes_to_one_snapshot(spark, tmp_path):
    root = str(tmp_path / "features")
    written = spark.createDataFrame([("a", JAN, 1.0), ("b", JAN, None), ("a", FEB, 2.0)], FEATURES)
    stores.write_store(written, root)
    store = stores.scan_store(spark, root, FEATURES)
    assert store.schema == FEATURES
    assert rows_of(store) == rows_of(written)
    one = stores.at_snapshot(store, "2024-02-01").select(DEBT)
    assert one.collect()[0][DEBT] == 2.0
    plan = one._jdf.queryExecution().executedPlan().toString()
    partition_filter = plan.split("PartitionFilters: ")[1]
    assert partition_filter.startswith("[isnotnull(snapshot_date") and "2024-02-01" in partition_filter
    assert "ReadSchema: struct<outstanding_debt:double>" in plan
    assert stores.in_window(store, JAN, JAN).count() == 2


def test_zero_byte_files_are_empty(spark, tmp_path):
    root = tmp_path / "features"
    os.makedirs(root)
    (root / "part-0.parquet").touch()
    assert stores.scan_store(spark, str(root), FEATURES).count() == 0
    extra = spark.createDataFrame([("a", JAN, 1.0)], FEATURES)
    extra.coalesce(1).write.mode("append").parquet(str(root))
    assert rows_of(stores.scan_store(spark, str(root), FEATURES)) == [("a", JAN, 1.0)]


def test_missing_store_is_an_empty_table(spark, tmp_path):
    with pytest.raises(AnalysisException):
        stores.scan_store(spark, str(tmp_path / "nothing"), LABEL_STORE)
    store = stores.scan_store(spark, str(tmp_path / "nothing"), LABEL_STORE, missing_ok=True)
    assert store.schema == LABEL_STORE and store.isEmpty()


def test_prediction_rerun_replaces_its_partition_only(spark, tmp_path):
    root = str(tmp_path / "predictions")

    def predictions(day, score):
        return spark.createDataFrame([("a", day, "m.pkl", score), ("b", day, "m.pkl", score)], PREDICTIONS)

    reports.write_predictions(predictions(JAN, 0.1), root)
    reports.write_predictions(predictions(FEB, 0.2), root)
    for _ in range(2):
        reports.write_predictions(predictions(FEB, 0.3), root)
    stored = reports.read_predictions(spark, root)
    assert rows_of(stored) == rows_of(predictions(JAN, 0.1).union(predictions(FEB, 0.3)))
    assert os.path.isdir(os.path.join(root, f"{MODEL}=m.pkl", f"{SNAPSHOT}=2024-02-01"))


def psi_row(spark, day, value):
    row = ("m", day, date(2023, 12, 1), DEBT, value, "Low risk - No significant change")
    return spark.createDataFrame([row], PSI_RESULTS)


def test_psi_history_file_upsert(spark, tmp_path):
    root = str(tmp_path / "psi")
    assert reports.read_psi_history(spark, root).isEmpty()
    for day, value in ((JAN, 0.1), (FEB, 0.2), (FEB, 0.3), (FEB, 0.3)):
        reports.write_psi_history(psi_row(spark, day, value), root)
    history = reports.read_psi_history(spark, root)
    assert rows_of(history.select(SNAPSHOT, "psi_value")) == [(JAN, 0.1), (FEB, 0.3)]
    assert history.schema == PSI_RESULTS


def test_upsert_twice_is_upsert_once(spark):
    keys = [MODEL, "feature_name", SNAPSHOT]
    old = psi_row(spark, JAN, 0.1).union(psi_row(spark, FEB, 0.2))
    once = reports.upsert(old, psi_row(spark, FEB, 0.3), keys)
    twice = reports.upsert(once, psi_row(spark, FEB, 0.3), keys)
    assert rows_of(once.select("psi_value")) == [(0.1,), (0.3,)]
    assert rows_of(once) == rows_of(twice)


def test_summary_text_leaves_out_what_was_not_computed(spark):
    full = [
        ("feature", DEBT),
        ("psi_value", "0.0968"),
        ("psi_status", "Low risk - No significant change"),
        ("predictions", "10"),
        ("features", "20"),
        ("labels", "9"),
    ]
    rows = [("m", JAN, DEBT if at < 3 else None, *metric) for at, metric in enumerate(full)]
    rows += [("m", JAN, "income", "feature", "income"), ("m", JAN, "income", "psi_value", "0.0001")]
    rows += [("m", FEB, None, *metric) for metric in full[3:5]]
    texts = {r[SNAPSHOT]: r["text"] for r in reports.summary_text(spark.createDataFrame(rows, SUMMARY)).collect()}
    assert f"- Feature: {DEBT}\n- PSI Value: 0.0968\n- Status: Low risk" in texts[JAN]
    assert "- Feature: income\n- PSI Value: 0.0001" in texts[JAN]
    assert texts[JAN].endswith("Data Volumes:\n- Predictions: 10\n- Features: 20\n- Labels (for AUC): 9")
    assert "PSI" not in texts[FEB] and texts[FEB].endswith("- Predictions: 10\n- Features: 20")
