"""Gaussian kernel density curves."""

from __future__ import annotations

from collections.abc import Sequence
from math import factorial, pi, sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.functions.numeric import present
from scoremill.operators.drift import by_feature

# Points of the curve, bandwidths it reaches past the data, Scott's exponent.
GRID_POINTS = 200
CUT = 3.0
SCOTT = -0.2
# exp(-z*z/2) is exactly 0.0 in double precision from z = 38.6 on.
REACH = 39.0
#: Cells per bandwidth and moments per cell (from the 0th): what a curve loses by them is below 1e-12 of a kernel.
CELLS, MOMENTS = 4, 13


def kde_curves(values: DataFrame, points: int = GRID_POINTS) -> DataFrame:
    """Density curve ``(feature, point, x, density)`` of each feature of the long ``values``.

    A fast Gauss transform: values become moments of small cells, summed on the map side, so what is shuffled
    is a row per cell and task whatever the number of rows or distinct values. A kernel around a value is that
    around its cell's centre times a series in the value's distance from it, whose terms are Hermite
    polynomials; the curve is summed from cells, each for the grid points that it reaches in double precision.
    Features with fewer than two values, or without spread, give no curve.
    """
    grid = (
        values.groupBy("feature")
        .agg(
            F.expr("count(1) AS n"),
            F.expr("stddev_samp(value) AS std"),
            F.expr("min(value) AS low"),
            F.expr("max(value) AS high"),
        )
        .filter("n >= 2 AND std > 0")
        .selectExpr("*", f"std * pow(CAST(n AS DOUBLE), {SCOTT}D) AS width")
        .selectExpr("*", f"low - {CUT}D * width AS start", f"high + {CUT}D * width AS end")
        .selectExpr("feature", "n", "width", "start", f"(end - start) / {points - 1} AS step")
    )
    reach = f"{REACH}D * width"
    near = (
        f"sequence(CAST(greatest(0, floor((centre - start - {reach}) / step)) AS INT), "
        f"CAST(least({points - 1}, ceil((centre - start + {reach}) / step)) AS INT)) AS near"
    )
    own_grid = by_feature(grid, ["width", "start", "step"])
    powers = [" * ".join(["off"] * k) or "1D" for k in range(MOMENTS)]
    placed = (
        values.withColumn("grid", own_grid)
        .filter("grid IS NOT NULL")
        .selectExpr("feature", "value", "grid.*")
        .selectExpr("*", f"CAST(floor((value - start) * {CELLS}D / width) AS DOUBLE) AS cell")
        .selectExpr("feature", "cell", f"(value - start) / width - (cell + 0.5D) / {CELLS}D AS off")
    )
    cells = placed.groupBy("feature", "cell").agg(
        F.expr("count(1) AS m0"), *(F.expr(f"sum({power}) AS m{k}") for k, power in enumerate(powers) if k)
    )
    reached = (
        cells.withColumn("grid", own_grid)
        .selectExpr("*", "grid.*")
        .selectExpr("*", f"start + (cell + 0.5D) * width / {CELLS}D AS centre")
        .selectExpr("*", near)
        .selectExpr("*", "explode(near) AS point")
        .selectExpr("*", f"point * step / width - (cell + 0.5D) / {CELLS}D AS u")
        .selectExpr("*", "1D AS h0", "u AS h1")
    )
    for k in range(2, MOMENTS):
        reached = reached.selectExpr("*", f"u * h{k - 1} - {k - 1}D * h{k - 2} AS h{k}")
    terms = " + ".join(f"m{k} * h{k} / {factorial(k)}D" for k in range(MOMENTS))
    sums = reached.groupBy("feature", "point").agg(F.expr(f"sum(exp(-0.5D * u * u) * ({terms})) AS mass"))
    every = grid.selectExpr("*", f"explode(sequence(0, {points - 1})) AS point")
    return every.join(sums, ["feature", "point"], "left").selectExpr(
        "feature",
        "point",
        "start + point * step AS x",
        f"greatest(coalesce(mass, 0D), 0D) / (n * width * {sqrt(2 * pi)!r}D) AS density",
    )


def series(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """One column as long values, missing ones left out."""
    return df.filter(present(column)).selectExpr(
        f"'{name or column}' AS feature", f"CAST(`{column}` AS DOUBLE) AS value"
    )


def curves_of(named: Sequence[DataFrame]) -> DataFrame:
    """Curves of several long frames in one plan."""
    together = named[0]
    for frame in named[1:]:
        together = together.unionByName(frame)
    return kde_curves(together)
