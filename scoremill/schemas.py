"""Column layout of the stores, in one place.

The two gold stores are known only by how they are used, so the names of the two extra label
columns (``loan_id``, ``label_def``) are ours.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

CUSTOMER = "customer_id"
LOAN = "loan_id"
SNAPSHOT = "snapshot_date"
LABEL = "label"
DEBT = "outstanding_debt"
SCORE = "model_predictions"
MODEL = "model_name"

LABEL_STORE = T.StructType(
    [
        T.StructField(CUSTOMER, T.StringType()),
        T.StructField(LOAN, T.StringType()),
        T.StructField(LABEL, T.IntegerType()),
        T.StructField("label_def", T.StringType()),
        T.StructField(SNAPSHOT, T.DateType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField(CUSTOMER, T.StringType()),
        T.StructField(SNAPSHOT, T.DateType()),
        T.StructField(MODEL, T.StringType()),
        T.StructField(SCORE, T.DoubleType()),
    ]
)

PSI_RESULTS = T.StructType(
    [
        T.StructField(MODEL, T.StringType()),
        T.StructField(SNAPSHOT, T.DateType()),
        T.StructField("baseline_date", T.DateType()),
        T.StructField("feature_name", T.StringType()),
        T.StructField("psi_value", T.DoubleType()),
        T.StructField("psi_status", T.StringType()),
    ]
)

SUMMARY = T.StructType(
    [
        T.StructField(MODEL, T.StringType()),
        T.StructField(SNAPSHOT, T.DateType()),
        T.StructField("feature", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def feature_store_schema(features: Iterable[str]) -> T.StructType:
    """Feature store layout: the two keys, then one nullable double per feature."""
    return T.StructType(
        [T.StructField(CUSTOMER, T.StringType()), T.StructField(SNAPSHOT, T.DateType())]
        + [T.StructField(name, T.DoubleType()) for name in features]
    )
