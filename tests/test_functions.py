from datetime import date

import pytest
from pyspark.sql import functions as F

from scoremill.functions import names, numeric
from scoremill.functions.dates import (
    TrainingWindows,
    formatted_date,
    months_before,
    parsed_date,
    with_training_windows,
)


@pytest.mark.parametrize(
    ("day", "months", "expected"),
    [
        (date(2024, 3, 31), 1, date(2024, 2, 29)),
        (date(2024, 2, 29), 1, date(2024, 1, 29)),
        (date(2024, 1, 15), 1, date(2023, 12, 15)),
        (date(2024, 6, 1), 18, date(2022, 12, 1)),
    ],
)
def test_months_before_is_clamped_as_in_spark(spark, day, months, expected):
    assert months_before(day, months) == expected
    shifted = spark.range(1).select(F.add_months(F.lit(day), -months).alias("d")).first()["d"]
    assert shifted == expected


def test_training_windows_of_both_variants():
    script = TrainingWindows.at("2024-06-01")
    assert (script.train_test_start, script.train_test_end) == (date(2024, 2, 1), date(2024, 4, 30))
    assert (script.oot_start, script.oot_end) == (date(2024, 5, 1), date(2024, 5, 31))
    notebook = TrainingWindows.at("2024-06-01", oot_months=2, train_test_months=4)
    assert (notebook.train_test_start, notebook.oot_start) == (date(2023, 12, 1), date(2024, 4, 1))
    assert TrainingWindows.at("2024-03-31").oot_start == date(2024, 2, 29)


def test_window_columns_agree_with_the_dataclass(spark):
    days = [date(2024, 3, 31), date(2024, 6, 1), date(2023, 1, 30)]
    frame = spark.createDataFrame([(day,) for day in days], "train_date date")
    for row in with_training_windows(frame).collect():
        windows = TrainingWindows.at(row["train_date"])
        for name in ("train_test_start", "train_test_end", "oot_start", "oot_end"):
            assert row[name] == getattr(windows, name)


def test_names(spark):
    assert names.model_version("2024-06-01") == "model_2024_06_01"
    assert names.model_version("2024-06-01", "credit_model") == "credit_model_2024_06_01"
    assert names.bare_model_name("model_2024_06_01.pkl") == "model_2024_06_01"
    assert names.bare_model_name("model_2024_06_01") == "model_2024_06_01"
    row = (
        spark.createDataFrame([("a-b.pkl", "2024-02-03")], "n string, d string")
        .select(
            names.underscored(F.col("n")).alias("u"),
            names.without_suffix(F.col("n")).alias("w"),
            formatted_date(parsed_date(F.col("d"))).alias("d"),
        )
        .first()
    )
    assert tuple(row) == ("a_b.pkl", "a-b", "2024-02-03")


def test_psi_bands_are_closed_on_the_left(spark):
    frame = spark.createDataFrame([(v,) for v in (0.0999, 0.1, 0.1999, 0.2)], "psi double")
    bands = [r[0] for r in frame.select(numeric.psi_band("psi")).collect()]
    assert [band.split()[0] for band in bands] == ["Low", "Medium", "Medium", "High"]


def test_bucket_bands(spark):
    frame = spark.createDataFrame([(v,) for v in (0.05, 0.06, 0.1, 0.11)], "psi double")
    bands = [r[0] for r in frame.select(numeric.bucket_band("psi")).collect()]
    assert bands == ["green", "orange", "orange", "red"]
