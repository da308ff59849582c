"""Drift from a state per snapshot instead of the whole store.

A monitoring run compares one snapshot with all of the store, and reads all of it each month. The state keeps, for
each feature and snapshot, the number of values, their range, and their counts in the equal-width buckets of two
ranges: the snapshot's own and that of the whole store. Counts of snapshots add up, so a new month reads its own
partition only, unless it changes a feature's whole range: then the buckets have moved, and that feature is counted
again over the store. The result is that of the full scan, whatever the order in which months arrive, come again with
other rows, or go.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoremill.functions.dates import months_before, parse_date
from scoremill.functions.numeric import bucket_band, share_or_floor
from scoremill.operators.drift import equal_width_bucket, min_max_scaled, non_negative_values, value_ranges
from scoremill.schemas import DEBT, SNAPSHOT
from scoremill.session import discard, materialise
from scoremill.sources.versions import publish, read

STATE = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField(SNAPSHOT, T.DateType()),
        T.StructField("n", T.LongType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("whole_low", T.DoubleType()),
        T.StructField("whole_high", T.DoubleType()),
        T.StructField("own", T.ArrayType(T.LongType())),
        T.StructField("whole", T.ArrayType(T.LongType())),
    ]
)
BUCKETS = 10


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """A row for each feature and snapshot that has values; none for a state that isn't there yet."""
    return read(spark, root, STATE)


def _counts(values: DataFrame, ranges: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Counts by bucket of each snapshot and feature, in the range that ``ranges`` gives for ``by`` and feature."""
    scaled = min_max_scaled(values, ranges, by)
    cells = ", ".join(f"count_if(bucket = {i})" for i in range(1, BUCKETS + 1))
    bucketed = scaled.select(SNAPSHOT, "feature", equal_width_bucket("scaled", BUCKETS).alias("bucket"))
    return bucketed.groupBy(SNAPSHOT, "feature").agg(F.expr(f"array({cells})").alias(name))


def _whole_ranges(rows: DataFrame) -> DataFrame:
    return rows.groupBy("feature").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def update_state(
    store: DataFrame, root: str, days: Sequence[str | date], features: Sequence[str] = (DEBT,)
) -> list[str]:
    """Bring the state up to date with the snapshots ``days`` of ``store``; returns the features counted anew.

    Name every snapshot whose rows are new, changed or gone. The others are read only for features whose whole
    range, over all snapshots, is no longer the one that their buckets stand for. All changes become visible at once.
    """
    spark = store.sparkSession
    dates = [parse_date(day) for day in days]
    if not dates:
        return []
    changed = materialise(non_negative_values(store.filter(F.col(SNAPSHOT).isin(dates)), features, [SNAPSHOT]), "changed")
    ranges = value_ranges(changed, [SNAPSHOT])
    own = _counts(changed, ranges.select(SNAPSHOT, "feature", "low", "high"), [SNAPSHOT], "own")
    fresh = materialise(ranges.join(own, [SNAPSHOT, "feature"]), "fresh")

    state = read_state(spark, root)
    kept = state.filter(~F.col(SNAPSHOT).isin(dates) & F.col("feature").isin(list(features)))
    others = state.filter(~F.col("feature").isin(list(features)))
    columns = ["feature", SNAPSHOT, "n", "low", "high", "own"]
    every = kept.select(*columns).unionByName(fresh.select(*columns))
    # A row per feature: the ranges now, and those that the kept buckets stand for.
    now = {r["feature"]: (r["low"], r["high"]) for r in _whole_ranges(every).collect()}
    before = {
        r["feature"]: (r["low"], r["high"])
        for r in kept.groupBy("feature").agg(F.min("whole_low").alias("low"), F.max("whole_high").alias("high")).collect()
    }
    moved = sorted(name for name, ends in now.items() if name in before and before[name] != ends)
    whole = spark.createDataFrame([(name, *ends) for name, ends in now.items()], "feature string, low double, high double")

    counted = _counts(changed, whole, [], "whole")
    if moved:
        again = non_negative_values(store.filter(~F.col(SNAPSHOT).isin(dates)), moved, [SNAPSHOT])
        counted = counted.unionByName(_counts(again, whole, [], "whole"))
    still = kept.filter(~F.col("feature").isin(moved)).select(SNAPSHOT, "feature", "whole")
    ends = whole.select("feature", F.col("low").alias("whole_low"), F.col("high").alias("whole_high"))
    rows = every.join(counted.unionByName(still), [SNAPSHOT, "feature"]).join(F.broadcast(ends), "feature")
    rows = rows.select(STATE.fieldNames()).unionByName(others)
    if not moved:
        rows = rows.filter(F.col(SNAPSHOT).isin(dates))
    publish(rows, root, (SNAPSHOT,), [{SNAPSHOT: day} for day in dates])
    discard(changed, fresh)
    return moved


def psi_from_state(state: DataFrame, day: str | date, current_scope: str = "all") -> DataFrame:
    """``feature, bucket, expected_pct, actual_pct, psi_value, band``, as ``drift.psi_buckets`` gives them.

    The baseline is the snapshot a month earlier; the current side is the whole store, or with ``snapshot`` the day's.
    Features without values on either side give no rows.
    """
    run_date = parse_date(day)

    def shares(rows: DataFrame, counts: str, name: str) -> DataFrame:
        sizes = rows.groupBy("feature").agg(F.sum("n").alias("n"))
        cells = rows.select("feature", F.posexplode(counts).alias("place", "count"))
        cells = cells.groupBy("feature", (F.col("place") + 1).alias("bucket")).agg(F.sum("count").alias("n_bucket"))
        return cells.join(sizes, "feature").select("feature", "bucket", share_or_floor("(n_bucket / n)").alias(name))

    baseline = state.filter(F.col(SNAPSHOT) == F.lit(months_before(run_date, 1)))
    if current_scope == "snapshot":
        actual = shares(state.filter(F.col(SNAPSHOT) == F.lit(run_date)), "own", "actual_pct")
    else:
        actual = shares(state, "whole", "actual_pct")
    terms = shares(baseline, "own", "expected_pct").join(actual, ["feature", "bucket"])
    term = F.expr("(actual_pct - expected_pct) * ln(actual_pct / expected_pct)")
    return terms.withColumn("psi_value", term).withColumn("band", bucket_band("psi_value"))
