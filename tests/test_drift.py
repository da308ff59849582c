from datetime import date

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoremill import testdata
from scoremill.operators import density, drift
from scoremill.schemas import DEBT, feature_store_schema
from scoremill.sources.stores import at_snapshot

NAN = float("nan")


def numpy_psi(expected, actual, k=10):
    """PSI by way of NumPy's histogram, for comparison."""
    shares = []
    for side in (np.array(expected, float), np.array(actual, float)):
        with np.errstate(invalid="ignore"):
            x = (side - side.min()) / (side.max() - side.min())
        share = np.histogram(x[~np.isnan(x)], bins=np.arange(k + 1) / k)[0] / len(side)
        shares.append(np.where(share == 0, 0.0001, share))
    e, a = shares
    return float(((a - e) * np.log(a / e)).sum())


def psi(expected, actual):
    rows = drift.psi_total(drift.psi_buckets(expected, actual)).collect()
    return {r["feature"]: r["psi_value"] for r in rows}


def test_cleaning_keeps_zero_and_positive(spark):
    frame = spark.createDataFrame([(v,) for v in (None, NAN, -1.0, 0.0, 5.0)], f"{DEBT} double")
    assert [r["value"] for r in drift.non_negative_values(frame, [DEBT]).collect()] == [0.0, 5.0]
    both = frame.withColumn("twice", F.col(DEBT) * 2)
    rows = drift.non_negative_values(both, [DEBT, "twice", "absent"]).collect()
    assert sorted((r["feature"], r["value"]) for r in rows) == [
        (DEBT, 0.0), (DEBT, 5.0), ("twice", 0.0), ("twice", 10.0)
    ]
    assert drift.non_negative_values(frame, ["absent"]).isEmpty()


def test_single_feature_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.createDataFrame([("a", 1.0, 2.0)], f"customer_id string, {DEBT} double, y double").write.parquet(path)
    plan = drift.non_negative_values(spark.read.parquet(path), [DEBT])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual({DEBT},0.0)" in text and f"ReadSchema: struct<{DEBT}:double>" in text


def test_edges_fall_in_the_bucket_they_open(spark):
    frame = spark.createDataFrame([(v,) for v in (0.0, 0.1, 0.3, 0.7, 1.0)], "x double")
    got = [r[0] for r in frame.select(drift.equal_width_bucket("x")).collect()]
    assert got == [1, 2, 4, 8, 10]


def test_histogram_counts_every_row(values):
    rows = drift.equal_width_histogram(values([0, 1, 2, 3, 10])).collect()
    assert {r["bucket"]: r["n_bucket"] for r in rows if r["n_bucket"]} == {1: 1, 2: 1, 3: 1, 4: 1, 10: 1}
    assert len(rows) == 10 and {r["n"] for r in rows} == {5}


def test_constant_side_has_floor_shares_only(values):
    rows = drift.psi_buckets(values([7, 7, 7]), values([7, 7, 7])).collect()
    assert {(r["expected_pct"], r["actual_pct"], r["psi_value"]) for r in rows} == {(0.0001, 0.0001, 0.0)}
    one_sided = psi(values([7, 7, 7]), values(range(50)))
    assert one_sided["x"] == pytest.approx(numpy_psi([7, 7, 7], range(50)))


def test_pure_shift_is_no_drift(values):
    assert psi(values(range(100)), values(range(1000, 1100)))["x"] == pytest.approx(0, abs=1e-12)


def test_empty_side_gives_no_rows(values):
    assert psi(values([]), values([1, 2])) == {} == psi(values([1, 2]), values([]))


def test_features_do_not_mix(spark, values):
    expected = values([0, 1, 2, 9], "a").union(values([5, 6, 7], "b"))
    actual = values([0, 8, 9], "a").union(values([0, 0, 0, 1], "b")).union(values([1, 2], "only here"))
    got = psi(expected, actual)
    assert got == pytest.approx({"a": numpy_psi([0, 1, 2, 9], [0, 8, 9]), "b": numpy_psi([5, 6, 7], [0, 0, 0, 1])})


numbers = st.lists(st.integers(0, 1000).map(lambda i: i / 8), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(expected=numbers, actual=numbers)
def test_psi_equals_numpy_and_is_never_negative(values, expected, actual):
    got = psi(values(expected), values(actual))["x"]
    assert got == pytest.approx(numpy_psi(expected, actual), abs=1e-9)
    assert got >= 0
    assert psi(values(expected), values(expected))["x"] == pytest.approx(0, abs=1e-12)


@pytest.mark.parametrize(("sf", "known"), [("0.001", 1.610618), ("0.01", 0.096841), ("0.1", 0.007525)])
def test_known_psi_of_the_provided_tables(spark, data, sf, known):
    store = testdata.feature_store(spark, data.replace("0.01", sf))
    baseline = drift.non_negative_values(at_snapshot(store, "2001-05-01"), [DEBT])
    got = psi(baseline, drift.non_negative_values(store, [DEBT]))[DEBT]
    assert round(got, 6) == known


@pytest.mark.parametrize("scope", ["all", "snapshot"])
def test_history_equals_single_runs(spark, scope):
    days = [date(2024, 1, 1), date(2024, 2, 1), date(2024, 4, 1)]
    rows = [(f"c{i}", days[i % 3], float((i * 37) % 101)) for i in range(90)]
    store = spark.createDataFrame(rows, feature_store_schema([DEBT]))
    history = drift.psi_history(store, current_scope=scope).collect()
    assert [(r["snapshot_date"], r["baseline_date"]) for r in history] == [(days[1], days[0])]
    baseline = drift.non_negative_values(at_snapshot(store, days[0]), [DEBT])
    current = store if scope == "all" else at_snapshot(store, days[1])
    single = psi(baseline, drift.non_negative_values(current, [DEBT]))[DEBT]
    assert history[0]["psi_value"] == pytest.approx(single)


def test_history_clamps_month_ends(spark):
    days = [date(2024, 2, 29), date(2024, 3, 31)]
    rows = [(f"c{i}", days[i % 2], float(i)) for i in range(20)]
    history = drift.psi_history(spark.createDataFrame(rows, feature_store_schema([DEBT]))).collect()
    assert [(r["snapshot_date"], r["baseline_date"]) for r in history] == [(days[1], days[0])]


def brute_kde(numbers, points=200):
    x = np.array(numbers, float)
    width = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 3 * width, x.max() + 3 * width, points)
    z = (grid[:, None] - x[None, :]) / width
    return grid, np.exp(-0.5 * z * z).sum(axis=1) / (len(x) * width * np.sqrt(2 * np.pi))


def test_density_equals_the_direct_sum(values):
    rng = np.random.default_rng(3)
    numbers = [0.0] * 60 + list(rng.gamma(2.0, 50.0, 120).round(2)) + [5000.0]
    rows = sorted(density.kde_curves(values(numbers)).collect(), key=lambda r: r["point"])
    grid, expected = brute_kde(numbers)
    assert np.allclose([r["x"] for r in rows], grid)
    assert np.allclose([r["density"] for r in rows], expected, rtol=1e-9, atol=1e-15)
    assert np.trapezoid(expected, grid) == pytest.approx(1, abs=0.01)


def test_no_curve_without_spread(values):
    assert density.kde_curves(values([5, 5, 5])).isEmpty()
    assert density.kde_curves(values([5])).isEmpty()
    assert density.kde_curves(values([])).isEmpty()


def test_curves_of_two_series_do_not_mix(values):
    curves = density.curves_of([values([1, 2, 4], "a"), values([10, 20, 50, 50], "b")]).collect()
    for name, numbers in (("a", [1, 2, 4]), ("b", [10, 20, 50, 50])):
        got = sorted((r["point"], r["density"]) for r in curves if r["feature"] == name)
        assert np.allclose([d for _, d in got], brute_kde(numbers)[1])


def test_known_curve_of_the_provided_customers(spark, data):
    customers = testdata.table(spark, data, "customer").withColumnRenamed("c_acctbal", DEBT)
    curve = density.kde_curves(drift.non_negative_values(customers, [DEBT])).collect()
    assert len(curve) == 200
    assert round(min(r["x"] for r in curve), 3) == -2085.402


def test_infinite_values_are_in_no_bucket(values):
    cells = drift.equal_width_histogram(values([0.0, 1.0, float("inf")])).collect()
    assert sum(r["n_bucket"] for r in cells) == 2 and cells[0]["n"] == 3
