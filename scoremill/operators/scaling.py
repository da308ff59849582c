"""Standard scaling by training means and population deviations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.functions.numeric import nan_to_null

SCALED = "_scaled"
MISSING = "_missing"


def scaler_stats(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each feature, missing values left out, in one pass."""
    value = nan_to_null
    stats = ", ".join(
        f"struct('{name}' AS feature, count({value(name)}) AS n, avg({value(name)}) AS mean, "
        f"stddev_pop({value(name)}) AS std)"
        for name in features
    )
    return train.agg(F.expr(f"array({stats}) AS stats")).select(F.inline("stats"))


@dataclass(frozen=True)
class Scaler:
    """Fitted means and divisors: two numbers per feature, all the driver ever holds."""

    means: dict[str, float]
    divisors: dict[str, float]

    @property
    def features(self) -> list[str]:
        return list(self.means)

    def scaled(self, name: str) -> str:
        """SQL text of ``(x - mean) / std``; missing stays null."""
        mean, divisor = f"({self.means[name]!r}D)", f"{self.divisors[name]!r}D"
        return f"({nan_to_null(name)} - {mean}) / {divisor}"

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace each feature by its scaled value."""
        return df.withColumns({name: F.expr(self.scaled(name)) for name in self.features})

    def stage(self) -> SQLTransformer:
        """The scaler as a pipeline stage that is saved and loaded with the model.

        The learners take no missing values, so a missing one becomes the training mean (0 after
        scaling) and is flagged in a column of its own.
        """
        columns = []
        for name in self.features:
            columns.append(f"coalesce({self.scaled(name)}, 0D) AS `{name}{SCALED}`")
            columns.append(f"CAST({nan_to_null(name)} IS NULL AS DOUBLE) AS `{name}{MISSING}`")
        return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")

    def inputs(self) -> list[str]:
        """Columns that :meth:`stage` adds, in order."""
        return [name + suffix for name in self.features for suffix in (SCALED, MISSING)]


def fit_scaler(train: DataFrame, features: Sequence[str]) -> Scaler:
    """Fit on the training rows only. A feature without spread, or without values, divides by 1."""
    rows = scaler_stats(train, features).collect()
    return Scaler(
        means={row["feature"]: row["mean"] or 0.0 for row in rows},
        divisors={row["feature"]: row["std"] or 1.0 for row in rows},
    )
