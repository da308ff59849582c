"""Boosted trees against sums over plain rows, and their expression against the trees."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoremill.operators import boosting, expressions, learners, metrics
from scoremill.operators.boosting import BoostedModel, Fit, Params, Split, Tree
from scoremill.operators.search import boosted_search, sample_candidates

NAMES = ["a", "b", "c"]
SCHEMA = "key string, a double, b double, c double, label int, fold int"


def made(n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = draw.gauss(0, 1), draw.choice([1.0, 2.0, 3.0, 4.0])
        c = draw.choice([None, math.nan, draw.random(), draw.random()])
        gone = c is None or math.isnan(c)
        label = int(a + (b > 2) - gone + draw.gauss(0, 0.4) > 0.3)
        rows.append((f"k{i}", a, b, c, label, i % 3))
    return rows


@pytest.fixture(scope="module")
def rows():
    return made(400)


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def matrix(frame):
    return boosting.binned(frame, NAMES, ["key"], "fold", max_bins=16)


def goes_left(split, row):
    value = row[1 + split.feature]
    if value is None or math.isnan(value):
        return split.missing_left
    return split.cut is None or value < split.cut


def leaf_of(tree, row):
    node = 0
    while node in tree.splits:
        node = 2 * node + (1 if goes_left(tree.splits[node], row) else 2)
    return node


def check_model(model, cuts, rows, held_out=None):
    """Every split is the best one over its node's rows, every leaf has the weight of its rows."""
    params, margins = model.params, np.zeros(len(rows))
    y = np.array([r[4] for r in rows])
    keys = np.array([int(hashlib.md5(r[0].encode()).hexdigest()[:8], 16) % boosting.PRIME for r in rows])
    for number, tree in enumerate(model.trees):
        factor, offset = boosting.row_draw(number)
        used = (keys * factor + offset) % boosting.PRIME < int(params.subsample * boosting.PRIME)
        used &= np.array([r[5] for r in rows]) != (-9 if held_out is None else held_out)
        p = 1 / (1 + np.exp(-margins))
        g, h = p - y, p * (1 - p)

        def score(some, g=g, h=h):
            return max(abs(g[some].sum()) - params.reg_alpha, 0) ** 2 / (h[some].sum() + params.reg_lambda)

        def inspect(node, some, depth, tree=tree, g=g, h=h, score=score, number=number):
            gains = {}
            for f in boosting.drawn_features(NAMES, number, params.colsample_bytree) if depth else ():
                for cut in [*cuts[f], None]:
                    for missing_left in (False, True):
                        split = Split(f, 0, cut, missing_left, 0.0)
                        goes = np.array([goes_left(split, r) for r in rows])
                        sides = [some & goes, some & ~goes]
                        if all(h[s].sum() >= params.min_child_weight and s.any() for s in sides):
                            gains[f, cut, missing_left] = sum(map(score, sides)) - score(some)
            best = max(gains.values(), default=0.0)
            if node not in tree.splits:
                assert best < max(params.gamma, 2e-6) or depth == 0
                assert tree.leaves[node] == pytest.approx(params.weight(g[some].sum(), h[some].sum()))
                return
            split = tree.splits[node]
            chosen = gains[split.feature, split.cut, split.missing_left]
            assert split.gain == pytest.approx(best) and chosen == pytest.approx(best) and best >= params.gamma
            goes = np.array([goes_left(split, r) for r in rows])
            inspect(2 * node + 1, some & goes, depth - 1)
            inspect(2 * node + 2, some & ~goes, depth - 1)

        inspect(0, used, params.max_depth)
        margins += [tree.leaves[leaf_of(tree, r)] for r in rows]
    return margins


def assert_same(left, right):
    """The same splits, and weights that differ by the order of sums at most."""
    assert len(left.trees) == len(right.trees)
    for a, b in zip(left.trees, right.trees, strict=True):
        places = [{n: (s.feature, s.cut, s.missing_left) for n, s in tree.splits.items()} for tree in (a, b)]
        assert places[0] == places[1] and a.leaves == pytest.approx(b.leaves)


CASES = [
    ({"n_estimators": 3, "max_depth": 2, "min_child_weight": 1}, None),
    ({"n_estimators": 3, "max_depth": 3, "subsample": 0.6, "colsample_bytree": 0.7, "reg_alpha": 1}, 1),
    ({"n_estimators": 2, "max_depth": 3, "gamma": 4, "reg_lambda": 0, "min_child_weight": 6}, 2),
    ({"n_estimators": 2, "max_depth": 1, "learning_rate": 1, "min_child_weight": 1000}, None),
]


def test_splits_and_leaves_equal_sums_over_rows(matrix, rows):
    fits = [Fit(Params(**params), fold) for params, fold in CASES]
    for (_, fold), model in zip(CASES, boosting.boost(matrix, fits), strict=True):
        check_model(model, matrix.cuts, rows, fold)


def test_fits_grown_together_equal_fits_grown_alone(matrix):
    fits = [Fit(Params(**params), fold) for params, fold in CASES]
    for model, fit in zip(boosting.boost(matrix, fits), fits, strict=True):
        assert_same(model, boosting.boost(matrix, [fit])[0])


def test_expression_equals_the_trees(spark, frame, matrix, rows):
    model = boosting.boost(matrix, [Fit(Params(n_estimators=4, max_depth=3))])[0]
    margins = check_model(model, matrix.cuts, rows)
    again = BoostedModel.from_json(model.to_json())
    found = expressions.scored(frame, expressions.boosted_margin(again)).select("key", "score", "prediction").collect()
    expected = {r[0]: 1 / (1 + math.exp(-m)) for r, m in zip(rows, margins, strict=True)}
    assert {r["key"]: r["score"] for r in found} == pytest.approx(expected)
    assert all(r["prediction"] == (r["score"] > 0.5) for r in found)
    plan = expressions.scored(frame, expressions.boosted_margin(again))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_expressions_read_the_same_in_another_engine(frame, matrix, rows):
    duckdb = pytest.importorskip("duckdb")
    model = boosting.boost(matrix, [Fit(Params(n_estimators=3, max_depth=3))])[0]
    margin = expressions.boosted_margin(model)
    known = frame.toPandas()  # noqa: F841
    there = dict(duckdb.sql(f"SELECT key, {expressions.probability(margin)} FROM known").fetchall())
    here = {r["key"]: r["score"] for r in expressions.scored(frame, margin).collect()}
    assert there == pytest.approx(here, abs=1e-12)


def test_planted_signal_is_found(spark, matrix):
    model = boosting.boost(matrix, [Fit(Params(n_estimators=25, max_depth=3, learning_rate=0.1))])[0]
    fresh = spark.createDataFrame(made(600, seed=2), SCHEMA).withColumn("split", F.lit("new"))
    assert metrics.auc(expressions.scored(fresh, expressions.boosted_margin(model))).first()["auc"] > 0.9
    assert set(model.importances()) == set(NAMES) and sum(model.importances().values()) == pytest.approx(1)


def test_empty_constant_and_missing_columns(spark):
    rows = [(f"k{i}", 5.0, None, math.inf if i % 2 else -math.inf, i % 2, None) for i in range(40)]
    matrix = boosting.binned(spark.createDataFrame(rows, SCHEMA), NAMES, ["key"], "fold", max_bins=8)
    model = boosting.boost(matrix, [Fit(Params(n_estimators=1, max_depth=2))])[0]
    assert [s.feature for s in model.trees[0].splits.values()] == [2]
    scored = expressions.scored(spark.createDataFrame(rows, SCHEMA), expressions.boosted_margin(model))
    assert scored.filter("(score > 0.5) != (label = 1)").count() == 0

    nothing = boosting.binned(spark.createDataFrame([], SCHEMA), NAMES, ["key"])
    tree = boosting.boost(nothing, [Fit(Params(n_estimators=2))])[0].trees[0]
    assert tree == Tree()
    assert expressions.tree_expression(tree, NAMES) == "(0.0e0)"


def test_missing_labels_and_too_many_bins_are_refused(spark):
    with pytest.raises(Exception, match="a label is missing"):
        boosting.binned(spark.createDataFrame([("k", 1.0, 1.0, 1.0, None, 0)], SCHEMA), NAMES, ["key"])
    with pytest.raises(ValueError):
        boosting.binned(spark.createDataFrame([], SCHEMA), NAMES, ["key"], max_bins=256)
    with pytest.raises(ValueError, match="booster"):
        Params.of({"n_estimators": 1, "booster": "dart"})


def test_search_scores_held_out_folds(frame, matrix, rows):
    weak = {"n_estimators": 1, "max_depth": 1, "min_child_weight": 10_000}
    good = {"n_estimators": 6, "max_depth": 3, "learning_rate": 0.3}
    short = {**good, "n_estimators": 2}
    result = boosted_search(frame, NAMES, ["key"], [weak, short, good], max_bins=16)
    scores = {(r["candidate"], r["fold"]): r["auc"] for r in result.scores.collect()}
    assert len(scores) == 9 and result.params == good
    assert result.score == pytest.approx(sum(scores[2, f] for f in range(3)) / 3)
    for number, params in ((1, short), (2, good)):
        for fold in range(3):
            model = boosting.boost(matrix, [Fit(Params(**params), fold)])[0]
            margins = check_model(model, matrix.cuts, rows, fold)
            hits = {0: [], 1: []}
            for row, margin in zip(rows, margins, strict=True):
                if row[5] == fold:
                    hits[row[4]].append((margin > 0) == row[4])
            assert scores[number, fold] == pytest.approx(sum(sum(h) / len(h) for h in hits.values()) / 2)
    assert_same(result.trees, boosting.boost(matrix, [Fit(Params(**good))])[0])


def test_search_space_has_nine_axes():
    assert len(sample_candidates(learners.BOOSTED_SPACE, 10_000)) == 1728
    assert all(Params.of(c) for c in sample_candidates(learners.BOOSTED_SPACE))


def test_passes_shuffle_sums_not_rows(matrix):
    """What meets in a shuffle is bounded by nodes, features and bins; nothing is joined to rows."""
    fits = [Fit(Params(max_depth=1))]
    empty = {0: boosting.Forest([], 1)}
    sums = boosting.histograms(matrix, fits, empty, {0: boosting.Forest([Tree()], 1)}, {0: [0]}, 0)
    assert sums.count() <= len(NAMES) * 17
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_a_pass_adds_up_few_trees_and_finds_the_same(matrix, monkeypatch):
    fits = [Fit(Params(n_estimators=n, max_depth=2, subsample=0.8), fold) for n, fold in ((7, 0), (3, 1), (7, None))]
    most = []

    def watched(*args, made=boosting.histograms):
        most.append(max(len(forest.feature) for forest in args[2].values()))
        return made(*args)

    monkeypatch.setattr(boosting, "histograms", watched)
    monkeypatch.setattr(boosting, "TREES_PER_STEP", 2, raising=False)
    stepped = [model.to_json() for model in boosting.boost(matrix, fits)]
    assert max(most) == 1  # six trees were walked for the last one before
    monkeypatch.setattr(boosting, "TREES_PER_STEP", 99, raising=False)
    assert [model.to_json() for model in boosting.boost(matrix, fits)] == stepped


def test_nodes_split_by_split_equal_those_level_by_level(monkeypatch):
    draw = np.random.default_rng(3)
    tree = Tree({i: Split(int(draw.integers(3)), int(draw.integers(9)), 0.0, bool(i % 2), 1.0) for i in (0, 1, 2, 4, 5)})
    forest, bins = boosting.Forest([tree], 3), draw.integers(0, 9, (3, 500)).astype(np.uint8)
    few = forest.nodes(0, bins, 8)
    monkeypatch.setattr(boosting, "FEW_SPLITS", 0)
    assert few.tolist() == forest.nodes(0, bins, 8).tolist() and len(set(few.tolist())) > 4
