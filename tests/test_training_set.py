import hashlib
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from scoremill import testdata
from scoremill.functions.dates import TrainingWindows
from scoremill.operators import splits
from scoremill.operators.training_set import (
    feature_columns,
    label_feature_join,
    split_stats,
    with_period,
)
from scoremill.plans.training import training_table
from scoremill.schemas import DEBT, LABEL_STORE, feature_store_schema
from scoremill.sources.stores import in_window

JAN, FEB, MAR = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
FEATURES = feature_store_schema([DEBT, "income"])


def labels_of(spark, rows):
    return spark.createDataFrame([(c, f"L{c}", y, "d", day) for c, y, day in rows], LABEL_STORE)


def test_join_keeps_unmatched_labels_and_fans_out(spark):
    labels = labels_of(spark, [("a", 1, JAN), ("b", 0, JAN), (None, 0, JAN)])
    features = spark.createDataFrame(
        [("a", JAN, 1.0, 5.0), ("a", FEB, 2.0, 6.0), ("a", MAR, 3.0, None), ("z", JAN, 9.0, 9.0)],
        FEATURES,
    )
    joined = label_feature_join(labels, features)
    assert joined.columns == [*LABEL_STORE.fieldNames(), DEBT, "income"]
    got = Counter((r["customer_id"], r["loan_id"], r[DEBT], r["income"]) for r in joined.collect())
    assert got == Counter(
        [("a", "La", 1.0, 5.0), ("a", "La", 2.0, 6.0), ("a", "La", 3.0, None), ("b", "Lb", None, None),
         (None, "LNone", None, None)]
    )
    assert set(joined.select("snapshot_date").distinct().collect()) == {(JAN,)}


def test_hot_customer_on_both_sides(spark):
    labels = labels_of(spark, [("hot", i % 2, JAN) for i in range(40)] + [("c", 1, JAN)])
    features = spark.createDataFrame([("hot", JAN, float(i), 0.0) for i in range(30)], FEATURES)
    joined = label_feature_join(labels, features)
    assert joined.count() == 40 * 30 + 1
    assert joined.distinct().count() == 2 * 30 + 1


def test_feature_columns_are_numeric_and_not_keys(spark):
    frame = spark.createDataFrame([], "customer_id string, Label int, snapshot_date date, x int, y double, s string")
    assert feature_columns(frame) == ["x", "y"]


def test_periods_are_closed_ranges(spark):
    days = [date(2024, 1, 31), date(2024, 2, 1), date(2024, 4, 30), date(2024, 5, 1), date(2024, 5, 31), date(2024, 6, 1)]
    frame = with_period(labels_of(spark, [("a", 1, day) for day in days]), TrainingWindows.at("2024-06-01"))
    got = {r["snapshot_date"]: r["period"] for r in frame.collect()}
    assert [got[day] for day in days] == [None, "train_test", "train_test", "oot", "oot", None]


def test_small_split_rounds_the_test_share_up(spark):
    rows = [(f"p{i}", 1, JAN) for i in range(10)] + [(f"n{i}", 0, JAN) for i in range(7)]
    split = splits.stratified_split(labels_of(spark, rows))
    assert Counter((r["label"], r["split"]) for r in split.collect()) == Counter(
        {(1, "test"): 2, (1, "train"): 8, (0, "test"): 2, (0, "train"): 5}
    )


def brute_order(rows, seed=88):
    digest = lambda c: hashlib.md5(f"{c}|L{c}|{seed}".encode()).hexdigest()
    return sorted(rows, key=digest)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 1000])
def test_split_and_folds_against_a_plain_sort(spark, n):
    rows = [(f"k{i}", int(i % 3 == 0), JAN) for i in range(n)]
    frame = labels_of(spark, rows).withColumn("period", F.lit("train_test"))
    out = splits.split_and_folds(frame).collect()
    assert len(out) == n
    got = {r["customer_id"]: (r["split"], r["fold"]) for r in out}
    for label in (0, 1):
        ordered = brute_order([c for c, y, _ in rows if y == label])
        tested = -(-len(ordered) // 5)
        left = len(ordered) - tested
        expected = {c: ("test", None) for c in ordered[:tested]}
        bounds = [left * f // 3 for f in range(4)]
        for fold in range(3):
            for c in ordered[tested + bounds[fold] : tested + bounds[fold + 1]]:
                expected[c] = ("train", fold)
        assert {c: got[c] for c in ordered} == expected


def test_folds_differ_by_one_row_at_most(spark):
    frame = labels_of(spark, [(f"k{i}", int(i < 100), JAN) for i in range(331)])
    counts = Counter((r["label"], r["fold"]) for r in splits.cv_folds(frame, folds=5).collect())
    for label in (0, 1):
        sizes = [counts[label, fold] for fold in range(5)]
        assert max(sizes) - min(sizes) <= 1
    assert sum(counts.values()) == 331


def test_copies_of_a_label_stay_on_one_side(spark):
    """A third of all rows are copies of one label; they share its side, and no row is lost."""
    rows = [(f"k{i}", 0, JAN) for i in range(200)] + [("hot", 0, JAN)] * 100
    split = splits.stratified_split(labels_of(spark, rows), grouped=True).collect()
    assert len(split) == 300
    assert len({r["split"] for r in split if r["customer_id"] == "hot"}) == 1


@pytest.mark.parametrize("equal", [True, False])
def test_shares_are_exact_after_a_fan_out(spark, equal):
    """One label has 400 of 500 joined rows, which may even be equal in every column."""
    rows = [(f"k{i}", 0, JAN, float(i)) for i in range(100)]
    rows += [("hot", 0, JAN, 0.0 if equal else float(i)) for i in range(400)]
    schema = "customer_id string, label int, snapshot_date date, debt double"
    frame = spark.createDataFrame(rows, schema).selectExpr("*", "concat('L', customer_id) AS loan_id")
    frame = frame.withColumn("period", F.lit("train_test"))
    counts = Counter((r["split"], r["fold"]) for r in splits.split_and_folds(frame).collect())
    assert counts == {("test", None): 100, ("train", 0): 133, ("train", 1): 133, ("train", 2): 134}


def test_rows_outside_the_windows_get_no_split(spark):
    frame = labels_of(spark, [(f"k{i}", i % 2, JAN) for i in range(20)])
    frame = frame.withColumn("period", F.lit(None).cast("string"))
    assert splits.split_and_folds(frame).filter("split IS NOT NULL OR fold IS NOT NULL").isEmpty()


def test_other_labels_are_refused(spark):
    frame = labels_of(spark, [("a", 1, JAN), ("b", 2, JAN)])
    with pytest.raises(ValueError, match="0 or 1"):
        splits.stratified_split(frame)


def test_rows_without_a_label_are_kept_without_a_split(spark):
    frame = labels_of(spark, [("a", 1, JAN), ("b", None, JAN), ("c", 0, JAN)])
    got = {r["customer_id"]: r["split"] for r in splits.stratified_split(frame).collect()}
    assert got == {"a": "test", "b": None, "c": "test"}


def test_seed_changes_the_split(spark):
    frame = labels_of(spark, [(f"k{i}", 0, JAN) for i in range(100)])
    first, second = (
        {r["customer_id"] for r in splits.stratified_split(frame, seed=s).filter("split = 'test'").collect()}
        for s in (88, 89)
    )
    assert len(first) == len(second) == 20 and first != second


def test_assigning_rows_does_not_shuffle_them(spark, tmp_path):
    path = str(tmp_path / "labels")
    labels_of(spark, [(f"k{i}", i % 2, JAN) for i in range(50)]).write.parquet(path)
    plan = splits.stratified_split(spark.read.schema(LABEL_STORE).parquet(path))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Window" not in text and "Join" not in text


def test_known_split_of_the_provided_orders(spark, data):
    labels = in_window(testdata.label_store(spark, data), "2001-02-01", "2001-04-30")
    split = splits.stratified_split(labels)
    counts = {(r["label"], r["split"]): r["n_rows"] for r in split_stats(split, ("label", "split")).collect()}
    assert counts == {(0, "train"): 268, (0, "test"): 67, (1, "train"): 156, (1, "test"): 40}


def test_known_fan_out_of_the_provided_orders(spark, data):
    labels = in_window(testdata.label_store(spark, data, "o_custkey"), "2001-02-01", "2001-05-31")
    features = testdata.feature_store(spark, data, "o_custkey")
    assert labels.count() == 725
    assert label_feature_join(labels, features).count() == 7927


def test_training_table_covers_its_input_once(spark, data):
    labels, features = testdata.label_store(spark, data), testdata.feature_store(spark, data)
    table = training_table(labels, features, TrainingWindows.at("2001-06-01"))
    assert table.count() == 725
    assert table.select("loan_id").distinct().count() == 725
    assert table.filter("split IS NULL").isEmpty()
    assert table.filter("(split = 'train') <> (fold IS NOT NULL)").isEmpty()
