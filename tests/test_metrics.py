import random
from itertools import product

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from scoremill import testdata
from scoremill.operators import metrics
from scoremill.plans.training import evaluate

SCHEMA = "split string, label int, score double"


def brute_auc(pairs):
    wins = [(p > n) + (p == n) / 2 for (a, p), (b, n) in product(pairs, pairs) if a == 1 and b == 0]
    return sum(wins) / len(wins)


def auc_of(spark, rows, by=("split",)):
    return {r["split"]: r["auc"] for r in metrics.auc(spark.createDataFrame(rows, SCHEMA), by).collect()}


def test_ties_count_half(spark):
    rows = [("s", 1, 0.5), ("s", 0, 0.5), ("s", 1, 0.9), ("s", 0, 0.1)]
    assert auc_of(spark, rows) == {"s": 0.875}


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_has_no_auc(spark, label):
    assert auc_of(spark, [("s", label, 0.5), ("s", label, 0.6)]) == {"s": None}


def test_groups_against_all_pairs(spark):
    rng = random.Random(5)
    rows = [(s, rng.randint(0, 1), round(rng.random(), 2)) for s in ("a", "b", "c") for _ in range(150)]
    expected = {s: brute_auc([(y, x) for g, y, x in rows if g == s]) for s in ("a", "b", "c")}
    assert auc_of(spark, rows) == pytest.approx(expected)
    flipped = [(s, y, -x) for s, y, x in rows]
    assert auc_of(spark, flipped) == pytest.approx({s: 1 - v for s, v in expected.items()})


def test_hot_score_and_crowded_scores(spark):
    """A third of the rows share one score and the rest lie within a billionth of each other."""
    rng = random.Random(6)
    rows = [("s", rng.randint(0, 1), 0.5 if i % 3 == 0 else 0.5 + rng.random() * 1e-9) for i in range(600)]
    assert auc_of(spark, rows)["s"] == pytest.approx(brute_auc([(y, x) for _, y, x in rows]))


def test_without_groups_and_with_missing_scores(spark):
    rows = [("s", 1, 0.9), ("s", 0, 0.1), ("s", 1, None), ("s", 0, float("nan")), ("s", None, 0.4)]
    row = metrics.auc(spark.createDataFrame(rows, SCHEMA), by=()).first()
    assert (row["auc"], row["n_pos"], row["n_neg"]) == (1.0, 1, 1)


def test_rows_without_score_or_label_are_counted_and_refused(spark):
    rows = [("s", 1, 0.9), ("s", 0, 0.1), ("s", 1, None), ("s", 0, float("nan")), ("s", None, 0.4), ("t", 2, 0.3)]
    measured = metrics.auc(spark.createDataFrame(rows, SCHEMA))
    assert {r["split"]: (r["n_pos"], r["n_excluded"]) for r in measured.collect()} == {"s": (1, 3), "t": (0, 1)}
    for refused in (metrics.complete(measured), evaluate(spark.createDataFrame(rows, SCHEMA))):
        with pytest.raises(Exception, match="no score or a label other"):
            refused.collect()
    sound = metrics.complete(metrics.auc(spark.createDataFrame(rows[:2], SCHEMA)))
    assert sound.columns == ["split", "auc", "n_pos", "n_neg"] and sound.first()["auc"] == 1.0


@pytest.mark.parametrize("row", [("s", 2, 1.0), ("s", None, 1.0), ("s", 1, None), ("s", 1, float("nan"))])
def test_confusion_matrix_refuses_rows_of_no_cell(spark, row):
    frame = spark.createDataFrame([("s", 1, 1.0), row], "split string, label int, prediction double")
    with pytest.raises(Exception, match="other than 0 and 1"):
        metrics.confusion_matrix(frame).collect()


def test_known_auc_equals_the_library_evaluator(spark, data):
    customers = testdata.table(spark, data, "customer").selectExpr(
        "c_acctbal AS score", "CAST(c_mktsegment = 'BUILDING' AS INT) AS label"
    )
    auc = metrics.auc(customers, by=()).first()["auc"]
    assert round(auc, 6) == 0.508166
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert evaluator.evaluate(customers) == pytest.approx(auc, abs=1e-12)


def test_gini_is_twice_auc_less_one(spark):
    frame = spark.createDataFrame([("s", 1, 0.5), ("s", 0, 0.5), ("s", 1, 0.9), ("s", 0, 0.1)], SCHEMA)
    assert metrics.auc_and_gini(frame).first()["gini"] == 0.75


def test_hard_label_auc_is_the_auc_of_the_labels(spark):
    rng = random.Random(7)
    rows = [("s", rng.randint(0, 1), float(rng.randint(0, 1))) for _ in range(200)]
    frame = spark.createDataFrame(rows, SCHEMA)
    hard = metrics.hard_label_auc(frame, prediction="score").first()["auc"]
    assert hard == pytest.approx(brute_auc([(y, x) for _, y, x in rows]))


def test_confusion_matrix_keeps_empty_cells(spark):
    frame = spark.createDataFrame([("s", 1, 1.0), ("s", 1, 0.0), ("s", 0, 0.0)], "split string, label int, prediction double")
    cells = {(r["label"], r["prediction"]): r["n_rows"] for r in metrics.confusion_matrix(frame).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 1}


def test_importances_are_ranked(spark):
    ranked = metrics.feature_importance(spark, {"b": 0.2, "a": 0.2, "c": 0.6}).collect()
    assert [(r["rank"], r["feature"]) for r in ranked] == [(1, "c"), (2, "a"), (3, "b")]


def test_hard_label_auc_refuses_rows_that_it_has_no_place_for(spark):
    schema = "label int, prediction double"
    good = [(0, 0.0), (1, 1.0), (1, 0.0)]
    assert metrics.hard_label_auc(spark.createDataFrame(good, schema)).first()["auc"] == 0.75
    for bad in ((None, 1.0), (1, None), (2, 1.0), (1, float("nan"))):
        with pytest.raises(Exception, match="1 rows have a label or prediction"):
            metrics.hard_label_auc(spark.createDataFrame([*good, bad], schema)).collect()
