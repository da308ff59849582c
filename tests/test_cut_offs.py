"""Cut-offs by refined prefixes against a plain sort; equal rows numbered where they are."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scoremill.operators import splits

SCHEMA = "customer_id string, loan_id string, label int, x double"


def digest(*parts):
    return hashlib.md5("|".join(parts).encode()).hexdigest()


def plain(rows, percent=20):
    """Keys of the rows that are tested: the first share of each label by hash."""
    out = set()
    for label in (0, 1):
        own = sorted((digest(c, n, "88"), c, n) for c, n, v, _ in rows if v == label)
        out |= {row[1:] for row in own[: -(-len(own) * percent // 100)]}
    return out


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_refinement_equals_a_sort(spark, monkeypatch, digits):
    monkeypatch.setattr(splits, "PREFIX_DIGITS", digits)
    rows = [(f"c{i}", f"L{i}", int(i % 5 == 0), float(i)) for i in range(1500)]
    out = splits.stratified_split(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["customer_id"], r["loan_id"]) for r in out if r["split"] == "test"} == plain(rows)
    folds = splits.cv_folds(spark.createDataFrame(rows, SCHEMA), folds=7).collect()
    sizes = Counter((r["label"], r["fold"]) for r in folds)
    assert {size for (label, _), size in sizes.items() if label == 1} <= {42, 43}


def test_a_pass_per_prefix_and_no_more(spark, monkeypatch):
    passes = []
    monkeypatch.setattr(splits, "_refined", lambda *a, f=splits._refined: passes.append(a[2]) or f(*a))
    rows = [(f"c{i}", f"L{i}", i % 2, float(i)) for i in range(3000)]
    splits.stratified_split(spark.createDataFrame(rows, SCHEMA))
    assert passes in ([], [8])


def test_a_third_of_equal_rows_is_cut_exactly(spark):
    """All rows but some are one row; shares are exact and no task gathers the equal ones."""
    n = 9_000
    frame = spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("c"), "id")).otherwise("same").alias("customer_id"),
        F.lit("L").alias("loan_id"), F.lit(1).alias("label"), F.lit(1.0).alias("x"),
    )
    for percent in (1, 20, 50, 77):
        out = splits.stratified_split(frame, test_percent=percent)
        assert out.filter("split = 'test'").count() == -(-n * percent // 100)
    folds = splits.cv_folds(frame, folds=4)
    assert {r["count"] for r in folds.groupBy("fold").count().collect()} == {n // 4}
    plan = folds._jdf.queryExecution().executedPlan().toString()
    rows_moved = [part for part in plan.split("Exchange ")[1:] if "customer_id" in part.split("\n")[0]]
    assert not rows_moved


def test_all_rows_equal_and_no_rows(spark):
    same = spark.createDataFrame([("c", "L", i % 2, 1.0) for i in range(40)], SCHEMA)
    counts = Counter((r["label"], r["split"]) for r in splits.stratified_split(same).collect())
    assert counts == {(0, "test"): 4, (0, "train"): 16, (1, "test"): 4, (1, "train"): 16}
    assert splits.stratified_split(same.limit(0)).collect() == []
