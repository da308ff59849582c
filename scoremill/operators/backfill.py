"""Training sets of many training dates at once: the calendar joined to labels by range.

A range join has no key to shuffle by, so each window is spelled out as the calendar months it touches. Rows meet
windows by month, an equi-join, and the boundary test cuts the first and the last month to size. No plan of these
holds a nested loop, and a month with a third of all rows is split like any hot key of an inner join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.functions.dates import with_training_windows
from scoremill.schemas import LABEL, SNAPSHOT

TRAIN_DATE = "train_date"
OOT, TRAIN_TEST = "oot", "train_test"


def training_periods(train_dates: DataFrame, oot_months: int = 1, train_test_months: int = 3) -> DataFrame:
    """``train_date, period, start_date, end_date``: the two closed windows of each distinct training date.

    Null dates have no windows.
    """
    dates = train_dates.select(TRAIN_DATE).filter(F.col(TRAIN_DATE).isNotNull()).distinct()
    bounds = with_training_windows(dates, TRAIN_DATE, oot_months, train_test_months)
    windows = F.array(
        *(
            F.struct(
                F.lit(period).alias("period"),
                F.col(f"{period}_start").alias("start_date"),
                F.col(f"{period}_end").alias("end_date"),
            )
            for period in (OOT, TRAIN_TEST)
        )
    )
    return bounds.select(TRAIN_DATE, F.inline(windows))


def in_periods(rows: DataFrame, periods: DataFrame, date: str = SNAPSHOT) -> DataFrame:
    """Each row once for every window its date falls in, with the window's ``train_date`` and ``period``.

    Windows may overlap, be empty (end before start) or lie outside the data; rows without a date are in none.
    """
    month = "trunc({}, 'MM')".format
    cells = periods.filter("start_date <= end_date").withColumn(
        "cell", F.expr(f"explode(sequence({month('start_date')}, {month('end_date')}, interval 1 month))")
    )
    met = rows.withColumn("_cell", F.expr(month(date))).join(cells, F.col("_cell") == F.col("cell"))
    inside = F.col(date).between(F.col("start_date"), F.col("end_date"))
    return met.filter(inside).select(TRAIN_DATE, "period", *rows.columns)


def backfill_stats(
    labels: DataFrame, periods: DataFrame, test_percent: int = 20, label: str = LABEL, date: str = SNAPSHOT
) -> DataFrame:
    """Rows, positives, label rate and size of the stratified test set of every window, empty ones included.

    Windows to train in are those whose period ends in ``train_test``; their test set takes a share of each class,
    rounded up. Labels are counted by day first, so what meets the windows is a row per day and class, however many labels.
    """
    by_day = labels.groupBy(date, label).agg(F.count(F.lit(1)).alias("n"))
    by_class = in_periods(by_day, periods, date).groupBy(TRAIN_DATE, "period", label).agg(
        F.sum("n").alias("n"), F.min(date).alias("first"), F.max(date).alias("last")
    )
    tested = F.expr(f"(n * {test_percent} + 99) div 100")
    stats = by_class.groupBy(TRAIN_DATE, "period").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col(label) == 1, F.col("n")).otherwise(0)).alias("n_pos"),
        F.sum(F.when(F.col("period").endswith(TRAIN_TEST), tested).otherwise(0)).alias("n_test"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
    )
    whole = periods.join(stats, [TRAIN_DATE, "period"], "left")
    return whole.select(
        TRAIN_DATE,
        "period",
        "start_date",
        "end_date",
        *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_rows", "n_pos", "n_test")),
        F.expr("round(try_divide(n_pos, n_rows), 2)").alias("label_rate"),
        "first_date",
        "last_date",
    )
