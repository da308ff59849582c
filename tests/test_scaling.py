from math import sqrt

import pytest

from scoremill.operators.scaling import fit_scaler, scaler_stats

NAN = float("nan")


@pytest.fixture
def frame(spark):
    rows = [(1.0, 3.0, None, 1), (2.0, 3.0, None, 2), (3.0, 3.0, None, 3), (None, 3.0, None, 4), (NAN, 3.0, None, 5)]
    return spark.createDataFrame(rows, "x double, same double, none double, whole int")


def test_population_deviation_without_missing_values(frame):
    stats = {r["feature"]: r for r in scaler_stats(frame, ["x", "whole"]).collect()}
    assert stats["x"]["n"] == 3 and stats["x"]["mean"] == 2.0
    assert stats["x"]["std"] == pytest.approx(sqrt(2 / 3))
    assert stats["whole"]["mean"] == 3.0


def test_no_spread_divides_by_one(frame):
    scaler = fit_scaler(frame, ["x", "same", "none"])
    assert scaler.divisors["same"] == 1.0 and scaler.divisors["none"] == 1.0
    rows = scaler.transform(frame).collect()
    assert [r["same"] for r in rows] == [0.0] * 5
    assert [r["none"] for r in rows] == [None] * 5
    assert [r["x"] for r in rows[3:]] == [None, None]
    assert rows[0]["x"] == pytest.approx(-1 / sqrt(2 / 3))


def test_stage_fills_and_flags_missing_values(frame):
    scaler = fit_scaler(frame, ["x", "same"])
    staged = scaler.stage().transform(frame).select(scaler.inputs()).collect()
    assert scaler.inputs() == ["x_scaled", "x_missing", "same_scaled", "same_missing"]
    expected = [r["x"] or 0.0 for r in scaler.transform(frame).collect()]
    assert [r["x_scaled"] for r in staged] == expected
    assert [r["x_missing"] for r in staged] == [0.0, 0.0, 0.0, 1.0, 1.0]


def test_fit_uses_the_rows_it_is_given_only(spark, frame):
    other = spark.createDataFrame([(10.0,), (20.0,)], "x double")
    scaled = fit_scaler(frame, ["x"]).transform(other).collect()
    assert [r["x"] for r in scaled] == pytest.approx([8 / sqrt(2 / 3), 18 / sqrt(2 / 3)])
