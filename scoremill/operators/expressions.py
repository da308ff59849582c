"""Fitted models as one SQL expression, so that scoring stays in generated code.

The text holds to what Spark SQL and DuckDB both read: ``CASE``, arithmetic, ``coalesce``, ``nullif``, ``exp``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.feature import SQLTransformer
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame

from scoremill.operators.boosting import BoostedModel, Tree
from scoremill.operators.scaling import MISSING, SCALED, Scaler

NAN = "CAST('NaN' AS DOUBLE)"


def number(value: float) -> str:
    """A double as both dialects read it: with an exponent it can't become a decimal."""
    text = repr(float(value))
    if text.lstrip("-") in ("inf", "nan"):
        return f"CAST('{text}' AS DOUBLE)"
    return f"({text}{'' if 'e' in text else 'e0'})"


def column(name: str) -> str:
    """A feature column with NaN as null."""
    return f"nullif({name}, {NAN})"


def probability(margin: str) -> str:
    return f"1e0 / (1e0 + exp(-({margin})))"


def tree_expression(tree: Tree, columns: list[str], node: int = 0) -> str:
    """Nested conditions of one tree; a comparison with a missing value is neither true nor false."""
    if node not in tree.splits:
        return number(tree.leaves.get(node, 0.0))
    split = tree.splits[node]
    name, missing = columns[split.feature], "true" if split.missing_left else "false"
    left, right = (tree_expression(tree, columns, child) for child in (2 * node + 1, 2 * node + 2))
    goes = f"{name} IS NOT NULL" if split.cut is None else f"coalesce({name} < {number(split.cut)}, {missing})"
    return f"CASE WHEN {goes} THEN {left} ELSE {right} END"


def boosted_margin(model: BoostedModel) -> str:
    """Sum of the trees, in their order."""
    columns = [column(name) for name in model.features]
    return " + ".join([number(0.0), *(f"({tree_expression(tree, columns)})" for tree in model.trees)])


def logistic_margin(coefficients: Mapping[str, float], intercept: float, scaler: Scaler) -> str:
    """Weighted scaled features and missing flags, by the names that the scaler gives them."""
    terms = [number(intercept)]
    for name in scaler.features:
        x = column(name)
        scaled = f"({x} - {number(scaler.means[name])}) / {number(scaler.divisors[name])}"
        terms.append(f"{number(coefficients[name + SCALED])} * coalesce({scaled}, 0e0)")
        terms.append(f"CASE WHEN {x} IS NULL THEN {number(coefficients[name + MISSING])} ELSE 0e0 END")
    return " + ".join(terms)


def logistic_expression(model: LogisticRegressionModel, scaler: Scaler) -> str:
    """Margin of a fitted logistic regression over the scaler's inputs."""
    by_input = dict(zip(scaler.inputs(), map(float, model.coefficients), strict=True))
    return logistic_margin(by_input, float(model.intercept), scaler)


def scoring_stage(margin: str) -> SQLTransformer:
    """A pipeline stage that adds ``score`` and the hard ``prediction``; it is saved and loaded as text."""
    score = probability(margin)
    return SQLTransformer(
        statement=f"SELECT *, CAST(score > 0.5D AS DOUBLE) AS prediction FROM (SELECT *, {score} AS score FROM __THIS__)"
    )


def scored(rows: DataFrame, margin: str) -> DataFrame:
    return scoring_stage(margin).transform(rows)
