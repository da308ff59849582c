"""Names of models and of the files made for them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoremill.functions.dates import parse_date

ARTEFACT_SUFFIX = ".pkl"


def model_version(train_date: str | date, prefix: str = "model") -> str:
    """``model_2024_06_01`` for 2024-06-01."""
    return f"{prefix}_{underscored_date(train_date)}"


def underscored_date(day: str | date) -> str:
    return parse_date(day).isoformat().replace("-", "_")


def bare_model_name(name: str) -> str:
    """Model name without the artefact suffix, whether or not it was given."""
    return name.removesuffix(ARTEFACT_SUFFIX)


def underscored(text: Column) -> Column:
    return F.translate(text, "-", "_")


def without_suffix(name: Column) -> Column:
    return F.regexp_replace(name, r"\.pkl$", "")
