"""Calendar helpers: month steps, date formats and the training windows."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_date(text: str | date) -> date:
    """``YYYY-MM-DD`` to a date; dates pass through."""
    return text if isinstance(text, date) else date.fromisoformat(text)


def months_before(day: date, months: int) -> date:
    """``day`` minus whole months, clamped to the end of a shorter month."""
    year, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(day.day, last))


def parsed_date(text: Column) -> Column:
    return F.to_date(text, "yyyy-MM-dd")


def formatted_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def date_literal(day: str | date) -> Column:
    """A date-typed literal, so that filters on a date partition prune without casts."""
    return F.lit(parse_date(day))


@dataclass(frozen=True)
class TrainingWindows:
    """The four closed bounds around one training date."""

    train_date: date
    train_test_start: date
    train_test_end: date
    oot_start: date
    oot_end: date

    @classmethod
    def at(
        cls, train_date: str | date, oot_months: int = 1, train_test_months: int = 3
    ) -> TrainingWindows:
        day = parse_date(train_date)
        oot_start = months_before(day, oot_months)
        return cls(
            train_date=day,
            train_test_start=months_before(oot_start, train_test_months),
            train_test_end=oot_start - timedelta(days=1),
            oot_start=oot_start,
            oot_end=day - timedelta(days=1),
        )


def with_training_windows(
    train_dates: DataFrame,
    train_date: str = "train_date",
    oot_months: int = 1,
    train_test_months: int = 3,
) -> DataFrame:
    """The same four bounds as columns, for a whole table of training dates."""
    day = F.col(train_date)
    oot_start = F.add_months(day, -oot_months)
    return train_dates.withColumns(
        {
            "train_test_start": F.add_months(oot_start, -train_test_months),
            "train_test_end": F.date_sub(oot_start, 1),
            "oot_start": oot_start,
            "oot_end": F.date_sub(day, 1),
        }
    )
