"""Newton steps on Gram sums against the conditions of the optimum and against MLlib."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from scoremill.operators import expressions, logistic, scaling
from scoremill.operators.logistic import LogisticFit, design, fit_all
from scoremill.operators.search import logistic_search

NAMES = ["a", "b", "c"]
SCHEMA = "a double, b double, c double, label int, fold int"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    out = []
    for i in range(500):
        a, b, c = draw.gauss(0, 1), draw.gauss(0, 2), draw.gauss(1, 1)
        out.append((a, b, c, int(a - b / 2 + 0.4 + draw.gauss(0, 1) > 0), i % 3))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def blocks(frame):
    return design(frame, NAMES, "fold")


def slope(fit, rows):
    """Gradient of the smooth part at the fit's weights."""
    used = [r for r in rows if r[4] != fit.held_out]
    x = np.array([[1, *r[:3]] for r in used])
    y = np.array([r[3] for r in used])
    g = fit.C * x.T @ (1 / (1 + np.exp(-x @ fit.weights)) - y)
    return g + fit.penalised() * fit.weights if fit.penalty == "l2" else g


def test_weights_meet_the_conditions_of_the_optimum(blocks, rows):
    fits = [
        LogisticFit(c, penalty, 100, fold, own)
        for c in (0.01, 1, 10) for penalty in ("l1", "l2") for fold in (None, 1) for own in (True, False)
    ]
    fit_all(blocks, fits, 4)
    for fit in fits:
        assert fit.converged and fit.iterations < 40
        g = slope(fit, rows)
        if fit.penalty == "l2":
            assert np.abs(g).max() < 1e-5
            continue
        for weight, own, at in zip(fit.weights, fit.penalised(), g, strict=True):
            if weight == 0:
                assert abs(at) <= own + 1e-5
            else:
                assert at == pytest.approx(-own * np.sign(weight), abs=1e-5)


def test_strong_l1_leaves_no_weight(blocks):
    fit = LogisticFit(0.0001, "l1", 50)
    fit_all(blocks, [fit], 4)
    assert fit.converged and not fit.weights.any()


def test_free_intercept_equals_mllib(frame, blocks, rows):
    vectors = VectorAssembler(inputCols=NAMES, outputCol="x").transform(frame)
    for penalty, mix in (("l2", 0.0), ("l1", 1.0)):
        own = LogisticFit(0.5, penalty, 100, None, False)
        fit_all(blocks, [own], 4)
        theirs = LogisticRegression(featuresCol="x", regParam=1 / (0.5 * len(rows)), elasticNetParam=mix,
                                    standardization=False, tol=1e-10, maxIter=500).fit(vectors)
        assert own.weights == pytest.approx([theirs.intercept, *theirs.coefficients], abs=1e-4)


def test_max_iter_stops_and_paths_are_kept(blocks):
    fit = LogisticFit(1, "l2", 2)
    fit_all(blocks, [fit], 4, tolerance=0.0)
    assert (fit.iterations, len(fit.path), fit.converged) == (2, 3, False)


def test_separable_and_one_class_rows(spark):
    rows = [(float(i), 0.0, 0.0, int(i > 5), 0) for i in range(12)]
    fit, one = LogisticFit(10, "l2", 100), LogisticFit(10, "l2", 100)
    fit_all(design(spark.createDataFrame(rows, SCHEMA), NAMES), [fit], 4)
    assert fit.converged and np.isfinite(fit.weights).all()
    fit_all(design(spark.createDataFrame(rows[:4], SCHEMA), NAMES), [one], 4)
    assert one.converged and one.weights[0] < 0
    empty = LogisticFit()
    fit_all(design(spark.createDataFrame([], SCHEMA), NAMES), [empty], 4)
    assert empty.converged and not empty.weights.any()


def test_bad_parameters_and_missing_inputs_are_refused(spark):
    for bad in ({"penalty": "elastic"}, {"C": 0}):
        with pytest.raises(ValueError):
            LogisticFit(**bad)
    with pytest.raises(Exception, match="an input is missing"):
        design(spark.createDataFrame([(1.0, None, 1.0, 1, 0)], SCHEMA), NAMES)


def test_search_and_its_expression(spark, frame, rows):
    scaler = scaling.fit_scaler(frame, NAMES)
    prepared = scaler.stage().transform(frame)
    candidates = [{"C": 1e-5, "penalty": "l1", "max_iter": 100}, {"C": 1, "penalty": "l2", "max_iter": 1},
                  {"C": 1, "penalty": "l2", "max_iter": 50}]
    result = logistic_search(prepared, scaler, candidates)
    scores = {(r["candidate"], r["fold"]): r["auc"] for r in result.scores.collect()}
    assert len(scores) == 9 and all(scores[0, fold] == 0.5 for fold in range(3))
    assert result.score == pytest.approx(max(np.mean([scores[n, f] for f in range(3)]) for n in range(3)))
    scored = result.model.transform(frame).select(*NAMES, "label", "score", "prediction").collect()
    hits = np.mean([r["prediction"] == r["label"] for r in scored])
    assert hits > 0.75

    blocks = design(prepared, scaler.inputs())
    fit = LogisticFit(float(result.params["C"]), result.params["penalty"], result.params["max_iter"])
    fit_all(blocks, [fit], len(scaler.inputs()) + 1)
    weights = dict(zip(scaler.inputs(), fit.weights[1:], strict=True))
    margin = expressions.logistic_margin(weights, fit.weights[0], scaler)
    again = {tuple(r[:3]): r["score"] for r in expressions.scored(frame, margin).select(*NAMES, "score").collect()}
    assert {tuple(r[:3]): r["score"] for r in scored} == pytest.approx(again)


def test_expression_of_an_mllib_model(spark, frame):
    scaler = scaling.fit_scaler(frame, NAMES)
    prepared = VectorAssembler(inputCols=scaler.inputs(), outputCol="x").transform(scaler.stage().transform(frame))
    model = LogisticRegression(featuresCol="x", regParam=0.01).fit(prepared)
    theirs = model.transform(prepared).select("a", vector_to_array("probability")[1].alias("p")).collect()
    own = expressions.scored(frame, expressions.logistic_expression(model, scaler)).select("a", "score").collect()
    assert {r["a"]: r["score"] for r in own} == pytest.approx({r["a"]: r["p"] for r in theirs})


def test_a_pass_shuffles_sums(blocks):
    sums = logistic.statistics(blocks, {0: np.zeros(4), 3: np.ones(4)}, {0: None, 3: 1})
    assert sums.count() == 2 * (1 + 4 + 16)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Join" not in plan
