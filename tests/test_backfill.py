"""Labels met by the windows of many training dates, against plain loops."""

from collections import Counter
from datetime import date, timedelta

import pytest

from scoremill.functions.dates import TrainingWindows
from scoremill.operators.backfill import backfill_stats, in_periods, training_periods
from scoremill.schemas import LABEL_STORE

START = date(2023, 12, 20)
LABELS = [(f"c{i}", f"L{i}", int(i % 3 == 0), "d", START + timedelta(days=i * 3 % 140)) for i in range(300)]
LABELS += [("c0", "L0", 1, "d", date(2024, 2, 29))] * 4 + [("n", "n", 1, "d", None)]
DATES = [date(2024, 3, 1), date(2024, 3, 31), date(2024, 2, 29), date(2024, 4, 15), date(2019, 1, 1), None]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, LABEL_STORE)


@pytest.fixture(scope="module")
def dates(spark):
    return spark.createDataFrame([(d,) for d in [*DATES, DATES[0]]], "train_date date")


def windows(oot, months):
    for day in filter(None, DATES):
        w = TrainingWindows.at(day, oot, months)
        yield day, "oot", w.oot_start, w.oot_end
        yield day, "train_test", w.train_test_start, w.train_test_end


@pytest.mark.parametrize("oot, months", [(1, 3), (2, 4)])
def test_windows_equal_the_calendar(dates, oot, months):
    found = [tuple(r) for r in training_periods(dates, oot, months).collect()]
    assert sorted(found) == sorted(windows(oot, months))


def test_rows_of_every_window(labels, dates):
    rows = in_periods(labels, training_periods(dates))
    assert rows.columns == ["train_date", "period", *labels.columns]
    expected = Counter(
        (day, period, *row) for day, period, lo, hi in windows(1, 3) for row in LABELS if row[4] and lo <= row[4] <= hi
    )
    assert Counter(map(tuple, rows.collect())) == expected


def test_stats_of_every_window(labels, dates):
    stats = {(r["train_date"], r["period"]): r for r in backfill_stats(labels, training_periods(dates)).collect()}
    assert len(stats) == 10
    for day, period, lo, hi in windows(1, 3):
        rows = [r for r in LABELS if r[4] and lo <= r[4] <= hi]
        found = stats[day, period]
        per_class = Counter(r[2] for r in rows)
        assert (found["start_date"], found["end_date"]) == (lo, hi)
        assert (found["n_rows"], found["n_pos"]) == (len(rows), per_class[1])
        tested = sum(-(-n // 5) for n in per_class.values()) if period == "train_test" else 0
        assert found["n_test"] == tested
        assert found["first_date"] == min((r[4] for r in rows), default=None)
        assert found["last_date"] == max((r[4] for r in rows), default=None)
        assert found["label_rate"] == (pytest.approx(per_class[1] / len(rows), abs=0.0051) if rows else None)


def test_join_is_an_equi_join_and_counts_come_first(labels, dates):
    plan = backfill_stats(labels, training_periods(dates))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    below = plan[plan.index("Join", plan.index("_cell") - 200) :]
    assert "partial_count(1)" in below


def test_no_dates_or_labels(labels, dates):
    assert backfill_stats(labels, training_periods(dates.limit(0))).collect() == []
    assert {r["n_rows"] for r in backfill_stats(labels.limit(0), training_periods(dates)).collect()} == {0}
