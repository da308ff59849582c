"""Drift from the state per snapshot against the full scan, after any order of months."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from scoremill.operators import drift, drift_state
from scoremill.schemas import SNAPSHOT, feature_store_schema

MONTHS = [date(2024, m, 1) for m in range(1, 7)]
RUN = MONTHS[3]
NAMES = ["debt", "income", "flat"]
SCHEMA = feature_store_schema(NAMES)


def rows_of(day, seed, wide=1.0):
    draw = random.Random(seed)
    out = []
    for i in range(40):
        debt = draw.choice([None, -1.0, float("nan"), draw.uniform(10, 20) * wide, draw.uniform(10, 20)])
        out.append((f"c{i}", day, debt, float(draw.randrange(5)), 3.0))
    return out


def full(store, day=RUN, scope="all"):
    baseline = store.filter(F.col(SNAPSHOT) == F.lit(date(day.year, day.month - 1, 1)))
    current = store.filter(F.col(SNAPSHOT) == F.lit(day)) if scope == "snapshot" else store
    return drift.psi_buckets(drift.non_negative_values(baseline, NAMES), drift.non_negative_values(current, NAMES))


def ordered(df):
    names = ["feature", "bucket", "expected_pct", "actual_pct", "psi_value", "band"]
    return sorted(map(tuple, df.select(names).collect()))


def check(spark, root, store, scope="all"):
    found = drift_state.psi_from_state(drift_state.read_state(spark, root), RUN, scope)
    assert ordered(found) == ordered(full(store, RUN, scope)) != []


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_equals_the_full_scan(spark, tmp_path, seed):
    draw = random.Random(seed)
    months = draw.sample(MONTHS, len(MONTHS))
    held, root = [], str(tmp_path / "state")
    for i, day in enumerate(months):
        held += rows_of(day, i, wide=draw.choice([0.5, 1.0, 1.5]))
        store = spark.createDataFrame(held, SCHEMA)
        drift_state.update_state(store, root, [day], NAMES)
    check(spark, root, store)
    check(spark, root, store, "snapshot")


def test_changed_and_vanished_months(spark, tmp_path):
    root = str(tmp_path / "state")
    parts = {day: rows_of(day, i) for i, day in enumerate(MONTHS)}
    parts[MONTHS[0]] = rows_of(MONTHS[0], 0, wide=9.0)  # holds the largest value
    store = spark.createDataFrame(sum(parts.values(), []), SCHEMA)
    drift_state.update_state(store, root, MONTHS, NAMES)
    check(spark, root, store)
    parts[MONTHS[0]] = []  # and goes: the range narrows
    parts[MONTHS[4]] = rows_of(MONTHS[4], 77)
    store = spark.createDataFrame(sum(parts.values(), []), SCHEMA)
    assert drift_state.update_state(store, root, [MONTHS[0], MONTHS[4]], NAMES) == ["debt"]
    check(spark, root, store)


def test_a_month_within_the_range_reads_its_own_rows_only(spark, tmp_path):
    root, data = str(tmp_path / "state"), str(tmp_path / "store")
    edge = [("lo", MONTHS[0], 0.0, 0.0, 3.0), ("hi", MONTHS[0], 1000.0, 9.0, 3.0)]
    every = sum((rows_of(day, i) for i, day in enumerate(MONTHS)), edge)
    spark.createDataFrame(every, SCHEMA).write.partitionBy(SNAPSHOT).parquet(data)
    store = spark.read.schema(SCHEMA).parquet(data).select(SCHEMA.fieldNames())
    drift_state.update_state(store, root, MONTHS[:-1], NAMES)
    # Without the files of other months only the new month can be read.
    for day in MONTHS[:-1]:
        for file in (tmp_path / "store" / f"{SNAPSHOT}={day}").glob("*.parquet"):
            file.write_bytes(b"unreadable")
    assert drift_state.update_state(store, root, MONTHS[-1:], NAMES) == []
    whole = spark.createDataFrame(every, SCHEMA)
    check(spark, root, whole)


def test_features_are_kept_apart(spark, tmp_path):
    root = str(tmp_path / "state")
    store = spark.createDataFrame(sum((rows_of(day, i) for i, day in enumerate(MONTHS)), []), SCHEMA)
    drift_state.update_state(store, root, MONTHS, ["debt"])
    drift_state.update_state(store, root, MONTHS, ["income", "flat"])
    check(spark, root, store)
    assert drift_state.update_state(store, root, [], NAMES) == []


def test_nothing_to_compare(spark, tmp_path):
    root = str(tmp_path / "state")
    assert drift_state.psi_from_state(drift_state.read_state(spark, root), RUN).collect() == []
    drift_state.update_state(spark.createDataFrame([], SCHEMA), root, MONTHS, NAMES)
    assert drift_state.read_state(spark, root).isEmpty()
