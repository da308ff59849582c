"""Random hyper-parameter search with stratified cross-validation."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.base import Model
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from scoremill.operators import boosting, logistic
from scoremill.operators.boosting import BoostedModel, Fit
from scoremill.operators.expressions import boosted_margin, logistic_margin, scoring_stage
from scoremill.operators.learners import INPUTS, LEARNERS, Params
from scoremill.operators.logistic import LogisticFit
from scoremill.operators.metrics import hard_label_auc
from scoremill.operators.scaling import Scaler
from scoremill.schemas import LABEL


def sample_candidates(
    space: Mapping[str, Sequence[object]], n_iter: int = 100, seed: int = 42
) -> list[dict[str, object]]:
    """``n_iter`` combinations without repeats, or all of a smaller space.

    The order is that of the md5 of the values, written as in the space, and the seed.
    """
    names = list(space)
    combinations = product(*space.values())
    ordered = sorted(combinations, key=lambda values: _digest(values, seed))
    return [dict(zip(names, values, strict=True)) for values in ordered[:n_iter]]


def _digest(values: Sequence[object], seed: int) -> str:
    text = "|".join([*map(str, values), str(seed)])
    return hashlib.md5(text.encode()).hexdigest()


def search_plan(
    folded: DataFrame, candidates: Sequence[Mapping[str, object]], label: str = LABEL
) -> DataFrame:
    """Every fit of the search: candidate and fold, with the rows it fits on and is scored on."""
    listed = F.array(
        *(
            F.struct(
                F.lit(number).alias("candidate"),
                *(F.lit(str(value)).alias(name) for name, value in candidate.items()),
            )
            for number, candidate in enumerate(candidates)
        )
    )
    sizes = folded.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_scored"), F.sum(label).cast("bigint").alias("n_scored_pos")
    )
    total = sizes.agg(F.sum("n_scored").alias("n")).scalar()
    return sizes.select(
        "fold", "n_scored", "n_scored_pos", (total - F.col("n_scored")).alias("n_fitted"),
        F.inline(listed),
    )


@dataclass(frozen=True)
class SearchResult:
    """Best candidate refitted on all training rows, and the score of every fit."""

    model: Model
    params: dict[str, object]
    score: float
    scores: DataFrame
    trees: BoostedModel | None = None


def random_search(
    train: DataFrame,
    learner: str,
    candidates: Sequence[Params],
    folds: int = 3,
    parallelism: int = 4,
) -> SearchResult:
    """Cross-validate the candidates on ``train(label, fold, features)`` and refit the best.

    A fit is scored by the AUC of its hard 0/1 predictions. The training matrix is kept on the
    executors for the length of the search; ``parallelism`` fits run at a time.
    """
    spark = train.sparkSession
    make = LEARNERS[learner]
    matrix = train.select(LABEL, "fold", INPUTS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {row["fold"]: row["count"] for row in matrix.groupBy("fold").count().collect()}
        n_rows = sum(sizes.values())

        def fit_and_score(task: tuple[int, int]) -> tuple[int, int, float]:
            number, fold = task
            estimator = make(candidates[number], n_rows - sizes.get(fold, 0))
            model = estimator.fit(matrix.filter(F.col("fold") != fold))
            held_out = model.transform(matrix.filter(F.col("fold") == fold))
            auc = hard_label_auc(held_out).first()["auc"]
            return number, fold, math.nan if auc is None else auc

        tasks = [(number, fold) for number in range(len(candidates)) for fold in range(folds)]
        with ThreadPool(min(parallelism, len(tasks))) as pool:
            scored = pool.map(inheritable_thread_target(spark)(fit_and_score), tasks)

        best, mean = _best(scored, len(candidates), folds)
        model = make(candidates[best], n_rows).fit(matrix)
    finally:
        matrix.unpersist()
    return SearchResult(model, dict(candidates[best]), mean, _scores(train, scored, candidates))


def _best(scored: Sequence[tuple[int, int, float]], n_candidates: int, folds: int) -> tuple[int, float]:
    """The candidate of the best mean score, the first of equals."""
    means = [sum(auc for number, _, auc in scored if number == wanted) / folds for wanted in range(n_candidates)]
    if all(map(math.isnan, means)):
        raise ValueError("no candidate has a score: a fold is empty or holds one class only")
    # A fold of one class has no score; its candidate comes last.
    best = max(range(n_candidates), key=lambda i: -math.inf if math.isnan(means[i]) else means[i])
    return best, means[best]


def _scores(
    train: DataFrame, scored: Sequence[tuple[int, int, float]], candidates: Sequence[Params]
) -> DataFrame:
    rows = [
        (number, fold, auc, {key: str(value) for key, value in candidates[number].items()})
        for number, fold, auc in scored
    ]
    return train.sparkSession.createDataFrame(
        rows, "candidate int, fold int, auc double, params map<string,string>"
    )


def boosted_search(
    train: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    candidates: Sequence[Params],
    folds: int = 3,
    max_bins: int = boosting.MAX_BINS,
) -> SearchResult:
    """Cross-validate boosted trees on ``train(label, fold, keys, features)`` and refit the best.

    All candidates and folds grow in the same passes over one binned matrix. Candidates that differ in the number of
    trees only are one fit: the smaller model is the beginning of the larger. A fit is scored by the AUC of its hard
    0/1 predictions, from four counts of the rows it left out.
    """
    matrix = boosting.binned(train, features, keys, "fold", max_bins=max_bins)
    wanted = [boosting.Params.of(candidate) for candidate in candidates]
    longest: dict[tuple, boosting.Params] = {}
    for params in wanted:
        for fold in range(folds):
            known = longest.setdefault((replace(params, n_estimators=0), fold), params)
            if params.n_estimators > known.n_estimators:
                longest[replace(params, n_estimators=0), fold] = params
    fits = {key: Fit(params, key[1]) for key, params in longest.items()}
    grown = dict(zip(fits, boosting.boost(matrix, list(fits.values())), strict=True))

    tasks = [(number, fold) for number in range(len(wanted)) for fold in range(folds)]
    models = []
    for number, fold in tasks:
        params = wanted[number]
        whole = grown[replace(params, n_estimators=0), fold]
        models.append(BoostedModel(whole.features, params, whole.trees[: params.n_estimators]))
    counted = boosting.held_out_counts(matrix, [Fit(wanted[n], fold) for n, fold in tasks], models).collect()
    scored = _from_counts(tasks, counted)
    best, mean = _best(scored, len(wanted), folds)
    trees = boosting.boost(matrix, [Fit(wanted[best])])[0]
    stage = scoring_stage(boosted_margin(trees))
    return SearchResult(stage, dict(candidates[best]), mean, _scores(train, scored, candidates), trees)


def _from_counts(tasks: Sequence[tuple[int, int]], counted: Sequence[Row]) -> list[tuple[int, int, float]]:
    """Candidate, fold and AUC of hard predictions of each fit, not a number where a class is absent."""
    counts = {(row["fit"], row["y"], row["predicted"]): row["n"] for row in counted}

    def hit_rate(fit: int, label: int) -> float:
        hit, missed = (counts.get((fit, label, p), 0) for p in (label, 1 - label))
        return hit / (hit + missed) if hit + missed else math.nan

    return [(n, fold, (hit_rate(i, 0) + hit_rate(i, 1)) / 2) for i, (n, fold) in enumerate(tasks)]


def logistic_search(
    train: DataFrame, scaler: Scaler, candidates: Sequence[Params], folds: int = 3, penalise_intercept: bool = True
) -> SearchResult:
    """Cross-validate logistic regressions on ``train(label, fold, inputs of the scaler)`` and refit the best.

    All candidates and folds take their Newton steps in the same passes; those that differ in ``max_iter`` only are
    one fit as long as it converges within the smaller number.
    """
    inputs = scaler.inputs()
    blocks = logistic.design(train, inputs, "fold")

    def made(params: Params, fold: int | None) -> LogisticFit:
        return LogisticFit(float(params.get("C", 1)), str(params.get("penalty", "l2")),
                           int(params.get("max_iter", 100)), fold, penalise_intercept)

    tasks = [(number, fold) for number in range(len(candidates)) for fold in range(folds)]
    fits = [made(candidates[number], fold) for number, fold in tasks]
    shared: dict[tuple, LogisticFit] = {}
    for fit in sorted(fits, key=lambda f: f.max_iter):
        shared.setdefault((fit.C, fit.penalty, fit.held_out), fit)
    logistic.fit_all(blocks, list(shared.values()), len(inputs) + 1)
    again = []
    for i, fit in enumerate(fits):
        known = shared[fit.C, fit.penalty, fit.held_out]
        if known.converged or known.max_iter == fit.max_iter:
            fits[i] = known
        else:
            again.append(fit)
    logistic.fit_all(blocks, again, len(inputs) + 1)
    scored = _from_counts(tasks, logistic.held_out_counts(blocks, fits).collect())
    best, mean = _best(scored, len(candidates), folds)
    final = made(candidates[best], None)
    logistic.fit_all(blocks, [final], len(inputs) + 1)
    weights = dict(zip(inputs, map(float, final.weights[1:]), strict=True))
    stage = scoring_stage(logistic_margin(weights, float(final.weights[0]), scaler))
    return SearchResult(stage, dict(candidates[best]), mean, _scores(train, scored, candidates))
