"""Numeric predicates, bands and roundings used by the monitoring tables.

Each takes a column name and is one SQL expression: building the same from column calls costs a
round trip to the JVM per operator, which adds up in the larger plans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Share given to an empty bucket, the band limits and the band texts.
EMPTY_SHARE = 0.0001
PSI_LOW = 0.1
PSI_MEDIUM = 0.2
PSI_LOW_TEXT = "Low risk - No significant change"
PSI_MEDIUM_TEXT = "Medium risk - Some change detected"
PSI_HIGH_TEXT = "High risk - Significant change detected"
BUCKET_RED = 0.1
BUCKET_ORANGE = 0.05


def present(name: str) -> Column:
    """Neither null nor NaN."""
    return F.expr(f"`{name}` IS NOT NULL AND NOT isnan(CAST(`{name}` AS DOUBLE))")


def present_non_negative(name: str) -> Column:
    """Present and at least zero; NaN has to go first because Spark ranks it above every number."""
    return F.expr(
        f"`{name}` IS NOT NULL AND NOT isnan(CAST(`{name}` AS DOUBLE)) AND `{name}` >= 0"
    )


def nan_to_null(name: str) -> str:
    """SQL text of the value as a double, with NaN as null."""
    return f"nanvl(CAST(`{name}` AS DOUBLE), CAST(NULL AS DOUBLE))"


def share_or_floor(share: str) -> Column:
    return F.expr(f"CASE WHEN {share} = 0 THEN {EMPTY_SHARE}D ELSE {share} END")


def psi_band(psi: str) -> Column:
    return F.expr(
        f"CASE WHEN {psi} < {PSI_LOW}D THEN '{PSI_LOW_TEXT}' "
        f"WHEN {psi} < {PSI_MEDIUM}D THEN '{PSI_MEDIUM_TEXT}' ELSE '{PSI_HIGH_TEXT}' END"
    )


def bucket_band(psi: str) -> Column:
    return F.expr(
        f"CASE WHEN {psi} > {BUCKET_RED}D THEN 'red' "
        f"WHEN {psi} > {BUCKET_ORANGE}D THEN 'orange' ELSE 'green' END"
    )


def gini(auc: str) -> Column:
    return F.expr(f"round(2 * {auc} - 1, 3)")
