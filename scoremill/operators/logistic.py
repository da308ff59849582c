"""Logistic regression from sufficient statistics: Newton steps on Gram sums, any number of fits in one pass.

The loss of a fit is ``C`` times the log loss plus half the squared weights (``l2``) or their absolute values
(``l1``), as in the original; the intercept is penalised like any weight unless asked otherwise. A pass over the
matrix gives, for all fits at once, the loss, its gradient and the weighted Gram matrix at the fit's current weights.
Tasks add up their blocks, Spark adds up the tasks, and a fit's sums, as many as the square of its columns, go to the
driver, which takes the step: a linear system for ``l2``, coordinate descent on the quadratic model for ``l1``. A step
that doesn't lower the loss is halved. Fits that have converged drop out of the passes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.operators.boosting import NO_FOLD
from scoremill.schemas import LABEL
from scoremill.session import materialise

#: A fit has converged when no weight moves by more than this.
TOLERANCE = 1e-8
HALVINGS = 30


@dataclass
class LogisticFit:
    """Parameters of one fit, its weights (intercept first) and how far it has come."""

    C: float = 1.0
    penalty: str = "l2"
    max_iter: int = 100
    held_out: int | None = None
    penalise_intercept: bool = True
    weights: np.ndarray | None = None
    iterations: int = 0
    converged: bool = False
    path: list[np.ndarray] = field(default_factory=list)
    loss: float = np.inf
    step: np.ndarray | None = None
    share: float = 1.0

    def __post_init__(self) -> None:
        if self.penalty not in ("l1", "l2") or self.C <= 0:
            raise ValueError(f"penalty {self.penalty!r} and C {self.C!r}: l1 or l2, and C above 0")

    def penalised(self) -> np.ndarray:
        mask = np.ones(len(self.weights))
        mask[0] = float(self.penalise_intercept)
        return mask

    def trial(self) -> np.ndarray:
        return self.weights if self.step is None else self.weights + self.share * self.step

    def target(self, log_loss: float, weights: np.ndarray) -> float:
        own = self.penalised()
        penalty = np.abs(own * weights).sum() if self.penalty == "l1" else (own * weights**2).sum() / 2
        return self.C * log_loss + penalty


def design(rows: DataFrame, inputs: Sequence[str], fold: str | None = None, label: str = LABEL) -> DataFrame:
    """``rows`` as blocks of doubles with a leading 1, written once; missing inputs are refused."""
    numbers = rows.select(
        *(
            F.expr(f"coalesce(CAST(`{name}` AS DOUBLE), raise_error('an input is missing'))").alias(f"x{i}")
            for i, name in enumerate(inputs)
        ),
        F.expr(f"CAST(coalesce({label}, raise_error('a label is missing')) AS DOUBLE) AS y"),
        (F.coalesce(F.col(fold), F.lit(NO_FOLD)) if fold else F.lit(NO_FOLD)).cast("int").alias("fold"),
    )
    width = len(inputs)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.ones((batch.num_rows, width + 1))
                for i in range(width):
                    x[:, i + 1] = batch.column(i).to_numpy()
                parts = (x, batch.column(width).to_numpy(), batch.column(width + 1).to_numpy())
                yield pa.RecordBatch.from_pydict({
                    name: pa.array([part.tobytes()], pa.binary())
                    for name, part in zip(("x", "y", "fold"), parts, strict=True)
                })

    return materialise(numbers.mapInArrow(block, "x binary, y binary, fold binary"), "design")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for x, y, fold in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            labels = np.frombuffer(y)
            yield np.frombuffer(x).reshape(len(labels), -1), labels, np.frombuffer(fold, np.int32)


def statistics(blocks: DataFrame, weights: dict[int, np.ndarray], held_out: dict[int, int | None]) -> DataFrame:
    """``fit, place, value``: log loss (place 0), gradient and Gram matrix of each fit, in this order."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {i: np.zeros(1 + len(w) + len(w) ** 2) for i, w in weights.items()}
        seen = False
        for x, y, fold in _unpacked(batches):
            seen = True
            for i, w in weights.items():
                used = slice(None) if held_out[i] is None else fold != held_out[i]
                some, labels = x[used], y[used]
                margin = some @ w
                p = 1 / (1 + np.exp(-margin))
                loss = np.logaddexp(0, margin).sum() - (labels * margin).sum()
                gram = some.T @ (some * (p * (1 - p))[:, None])
                sums[i] += np.concatenate([[loss], some.T @ (p - labels), gram.ravel()])
        if seen:
            for i, values in sums.items():
                yield pa.RecordBatch.from_pydict({
                    "fit": pa.array(np.full(len(values), i, np.int32)),
                    "place": pa.array(np.arange(len(values), dtype=np.int32)),
                    "value": pa.array(values),
                })

    partial = blocks.mapInArrow(add_up, "fit int, place int, value double")
    return partial.groupBy("fit", "place").agg(F.sum("value").alias("value"))


def fit_all(blocks: DataFrame, fits: Sequence[LogisticFit], width: int, tolerance: float = TOLERANCE) -> None:
    """Take steps from zero until every fit has converged or had its ``max_iter``; ``width`` counts the intercept."""
    for fit in fits:
        fit.weights = np.zeros(width)
    live = {i: fit for i, fit in enumerate(fits) if fit.max_iter > 0}
    while live:
        trials = {i: fit.trial() for i, fit in live.items()}
        found = {i: np.zeros(1 + width + width**2) for i in live}
        for row in statistics(blocks, trials, {i: fit.held_out for i, fit in live.items()}).collect():
            found[row["fit"]][row["place"]] = row["value"]
        for i, fit in list(live.items()):
            log_loss, gradient, gram = found[i][0], found[i][1 : 1 + width], found[i][1 + width :]
            if _advance(fit, trials[i], log_loss, gradient, gram.reshape(width, width), tolerance):
                del live[i]


def _advance(
    fit: LogisticFit, trial: np.ndarray, log_loss: float, gradient: np.ndarray, gram: np.ndarray, tolerance: float
) -> bool:
    """Accept or halve the step that led to ``trial``, plan the next one; whether the fit is done."""
    loss = fit.target(log_loss, trial)
    if fit.step is not None:
        if loss > fit.loss + 1e-12 * abs(fit.loss):
            fit.share /= 2
            fit.converged = fit.share < 0.5**HALVINGS  # no lower point along the way: rounding decides by now
            return fit.converged
        fit.iterations += 1
        fit.converged = bool(np.abs(trial - fit.weights).max() <= tolerance)
    fit.weights, fit.loss, fit.share = trial, loss, 1.0
    fit.path.append(trial)
    if fit.converged or fit.iterations >= fit.max_iter:
        return True
    smooth, curved, own = fit.C * gradient, fit.C * gram, fit.penalised()
    if fit.penalty == "l2":
        system, slope = curved + np.diag(own), smooth + own * trial
        fit.step = -np.linalg.lstsq(system, slope, rcond=None)[0]
    else:
        fit.step = _proximal_step(trial, smooth, curved, own)
    return False


def _proximal_step(weights: np.ndarray, slope: np.ndarray, gram: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Step to the minimum of the quadratic model plus the absolute weights, one weight at a time."""
    step, model = np.zeros(len(weights)), slope.copy()
    for _ in range(10_000):
        largest = 0.0
        for j in np.flatnonzero(np.diag(gram) > 0):
            at, curve = weights[j] + step[j], gram[j, j]
            best = at - model[j] / curve
            best = np.sign(best) * max(abs(best) - own[j] / curve, 0.0)
            move = best - at
            if move:
                step[j] += move
                model += gram[:, j] * move
                largest = max(largest, abs(move))
        if largest < 1e-12:
            break
    return step


def held_out_counts(blocks: DataFrame, fits: Sequence[LogisticFit]) -> DataFrame:
    """``fit, y, predicted, n``: hard predictions of the rows each fit left out, counted in one pass."""
    weights = [fit.weights for fit in fits]
    folds = [fit.held_out for fit in fits]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((len(folds), 4), np.int64)
        for x, y, fold in _unpacked(batches):
            for i, held_out in enumerate(folds):
                if held_out is not None:
                    own = fold == held_out
                    cells[i] += np.bincount((2 * y[own] + (x[own] @ weights[i] > 0)).astype(int), minlength=4)
        i, cell = np.nonzero(cells)
        yield pa.RecordBatch.from_pydict({
            "fit": pa.array(i.astype(np.int32)), "y": pa.array((cell // 2).astype(np.int32)),
            "predicted": pa.array((cell % 2).astype(np.int32)), "n": pa.array(cells[i, cell]),
        })

    counted = blocks.mapInArrow(count, "fit int, y int, predicted int, n long")
    return counted.groupBy("fit", "y", "predicted").agg(F.sum("n").alias("n"))
