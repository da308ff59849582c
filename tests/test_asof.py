"""Labels with the last features known at their date, against a plain search."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from scoremill.operators.training_set import label_feature_asof_join
from scoremill.schemas import LABEL_STORE, feature_store_schema

START = date(2023, 1, 15)
SCHEMA = feature_store_schema(["debt", "income"])


def plain(labels, features):
    out = []
    for customer, loan, label, note, day in labels:
        own = [f for f in features if f[0] == customer and customer is not None and day and f[1] and f[1] <= day]
        last = max((f[1] for f in own), default=None)
        values = max(((f[2] is not None, f[2] or 0, f[3] is not None, f[3] or 0, f[2], f[3]) for f in own if f[1] == last),
                     default=(None,) * 6)[4:]
        out.append((customer, loan, label, note, day, last, *values))
    return out


def joined(spark, labels, features):
    frame = label_feature_asof_join(spark.createDataFrame(labels, LABEL_STORE), spark.createDataFrame(features, SCHEMA))
    return frame, sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_a_plain_search(spark, seed):
    draw = random.Random(seed)

    def day():
        return draw.choice([None, *[START + timedelta(days=draw.randrange(400))] * 9])

    customers = ["a", "a", "b", "c", None]
    features = [(draw.choice(customers), day(), draw.choice([None, 1.0, 2.0]), draw.random()) for _ in range(120)]
    labels = [(draw.choice([*customers, "unknown"]), f"L{i}", i % 2, "d", day()) for i in range(90)]
    labels += labels[:5]
    frame, found = joined(spark, labels, features)
    assert found == sorted(plain(labels, features), key=str)
    assert frame.columns == [*LABEL_STORE.fieldNames(), "feature_date", "debt", "income"]


def test_state_is_carried_over_empty_months(spark):
    features = [("a", date(2020, 1, 31), 1.0, None), ("a", date(2024, 5, 2), 2.0, None)]
    labels = [("a", f"L{i}", 0, "d", d) for i, d in enumerate(
        [date(2020, 1, 30), date(2020, 1, 31), date(2020, 2, 1), date(2024, 5, 1), date(2024, 5, 2), date(2030, 1, 1)])]
    found = {r[1]: r[6] for r in joined(spark, labels, features)[1]}
    assert found == {"L0": None, "L1": 1.0, "L2": 1.0, "L3": 1.0, "L4": 2.0, "L5": 2.0}


def test_no_rows(spark):
    assert joined(spark, [], [("a", START, 1.0, 1.0)])[1] == []
    assert joined(spark, [("a", "L", 1, "d", START)], [])[1] == [("a", "L", 1, "d", START, None, None, None)]


def test_a_hot_customer_is_a_row_per_date_before_any_window(spark):
    n = 30_000
    features = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("customer_id"),
        F.date_add(F.lit(START), (F.col("id") % 50).cast("int")).alias("snapshot_date"),
        F.rand(1).alias("debt"), F.rand(2).alias("income"),
    )
    labels = features.selectExpr(
        "customer_id", "concat('L', monotonically_increasing_id()) AS loan_id", "1 AS label", "'d' AS label_def",
        "snapshot_date",
    )
    frame = label_feature_asof_join(labels, features)
    assert frame.count() == n and frame.filter("feature_date != snapshot_date OR feature_date IS NULL").count() == 0
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Python" not in plan
    for window in plan.split("Window [")[1:]:
        assert "Aggregate" in window  # dates are grouped below every window
