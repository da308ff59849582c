"""Population stability index of a current against a baseline population.

Each side is scaled to [0, 1] on its own range, so a pure shift of the values counts as no drift.
Values are handled in long form ``(keys.., feature, value)``: any number of features, and of run
dates, costs the same two passes over the value columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoremill.functions.numeric import (
    bucket_band,
    present_non_negative,
    psi_band,
    share_or_floor,
)
from scoremill.schemas import DEBT, SNAPSHOT


def non_negative_values(
    df: DataFrame, features: Sequence[str], keep: Sequence[str | Column] = ()
) -> DataFrame:
    """Long form ``(keep.., feature, value)`` of the present, non-negative values.

    Features the frame does not have are left out. A single feature stays a plain projection, so
    its filter reaches the scan; several are unpivoted in the same pass.
    """
    present = set(df.columns)
    names = [name for name in features if name in present]
    if len(names) == 1:
        named = [f"'{names[0]}' AS feature", f"CAST(`{names[0]}` AS DOUBLE) AS value"]
        return df.filter(present_non_negative(names[0])).select(*keep, *map(F.expr, named))
    if not names:
        nothing = ["CAST(NULL AS STRING) AS feature", "CAST(NULL AS DOUBLE) AS value"]
        return df.filter("false").select(*keep, *map(F.expr, nothing))
    kept = df.select(*keep, *(F.expr(f"CAST(`{name}` AS DOUBLE) AS `{name}`") for name in names))
    keys = [name for name in kept.columns if name not in names]
    return kept.unpivot(keys, names, "feature", "value").filter(present_non_negative("value"))


def value_ranges(values: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, least and greatest value of each feature (and of each ``by`` group)."""
    return values.groupBy(*by, "feature").agg(
        F.expr("count(1) AS n"), F.expr("min(value) AS low"), F.expr("max(value) AS high")
    )


def by_feature(stats: DataFrame, columns: Sequence[str]) -> Column:
    """Struct of the row's own feature's statistics, from a scalar subquery.

    The subquery holds one entry per feature of a given list, and is computed once.
    """
    entries = f"map_from_entries(collect_list(struct(feature, struct({', '.join(columns)}))))"
    return F.element_at(stats.agg(F.expr(entries)).scalar(), F.col("feature"))


def min_max_scaled(values: DataFrame, ranges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add ``scaled`` in [0, 1]; null where all values are the same.

    ``ranges`` has one row per feature and ``by`` group. Grouped by dates, it is bounded by the
    calendar times the feature list and is broadcast; for other groups Spark picks the join.
    """
    # An infinite end of the range leaves NaN, which is in no bucket.
    scaled = F.expr("nanvl(try_divide(value - range.low, range.high - range.low), NULL) AS scaled")
    if by:
        looked_up = ranges.selectExpr(*by, "feature", "struct(low, high) AS range")
        kinds = dict(looked_up.dtypes)
        if all(kinds[name] == "date" for name in by):
            looked_up = F.broadcast(looked_up)
        ranged = values.join(looked_up, [*by, "feature"])
    else:
        ranged = values.withColumn("range", by_feature(ranges, ["low", "high"]))
    return ranged.select(*values.columns, scaled)


def equal_width_bucket(scaled: str, buckets: int = 10) -> Column:
    """Bucket 1..buckets of a value in [0, 1], closed on the left; 1.0 falls in the last.

    The value is compared with the edges ``i / buckets`` themselves: multiplying it by ``buckets``
    instead would move values that lie on an edge.
    """
    edges = (f"CAST({scaled} >= {edge / buckets!r}D AS INT)" for edge in range(1, buckets))
    return F.expr(" + ".join(["1", *edges]))


def equal_width_histogram(
    values: DataFrame, by: Sequence[str] = (), buckets: int = 10
) -> DataFrame:
    """Row count of every bucket of each feature, empty buckets included, and the feature total."""
    keys = [*by, "feature"]
    scaled = min_max_scaled(values, value_ranges(values, by), by)
    cells = ", ".join(
        f"struct({i} AS bucket, count_if(bucket = {i}) AS n_bucket)" for i in range(1, buckets + 1)
    )
    return (
        scaled.select(*keys, equal_width_bucket("scaled", buckets).alias("bucket"))
        .groupBy(*keys)
        .agg(F.expr("count(1) AS n"), F.expr(f"array({cells}) AS cells"))
        .select(*keys, "n", F.inline("cells"))
    )


def bucket_shares(values: DataFrame, by: Sequence[str] = (), buckets: int = 10) -> DataFrame:
    """Share of each bucket; an empty one gets the floor, the others are not renormalised."""
    return equal_width_histogram(values, by, buckets).select(
        *by, "feature", "bucket", share_or_floor("(n_bucket / n)").alias("pct")
    )


def psi_buckets(
    expected: DataFrame,
    actual: DataFrame,
    by: Sequence[str] = (),
    actual_by: Sequence[str] | None = None,
    buckets: int = 10,
) -> DataFrame:
    """Shares of both sides and the PSI term of each bucket.

    ``expected`` and ``actual`` are long values. ``actual_by`` may name fewer groups than ``by``,
    for a current side that all run dates share. A side without values gives no rows.
    """
    common = list(by if actual_by is None else actual_by)
    term = F.expr("(actual_pct - expected_pct) * ln(actual_pct / expected_pct)")
    return (
        bucket_shares(expected, by, buckets)
        .withColumnRenamed("pct", "expected_pct")
        .join(
            bucket_shares(actual, common, buckets).withColumnRenamed("pct", "actual_pct"),
            [*common, "feature", "bucket"],
        )
        .select(*by, "feature", "bucket", "expected_pct", "actual_pct", term.alias("psi_value"))
        .withColumn("band", bucket_band("psi_value"))
    )


def psi_total(terms: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """PSI of each feature and its risk band."""
    return (
        terms.groupBy(*by, "feature")
        .agg(F.sum("psi_value").alias("psi_value"))
        .withColumn("psi_status", psi_band("psi_value"))
    )


def psi_history(
    store: DataFrame, features: Sequence[str] = (DEBT,), current_scope: str = "all", buckets: int = 10
) -> DataFrame:
    """PSI of every snapshot that has a baseline one month earlier, in one plan.

    The current side is the whole store (``all``) or the run date's own snapshot (``snapshot``).
    """
    baseline = F.expr(f"add_months({SNAPSHOT}, -1) AS baseline_date")
    calendar = store.select(SNAPSHOT).distinct().select(SNAPSHOT, baseline)
    keep = [F.col(SNAPSHOT).alias("baseline_date")]
    # One row per run date: bounded by the calendar.
    expected = (
        non_negative_values(store, features, keep)
        .join(F.broadcast(calendar), "baseline_date")
        .drop("baseline_date")
    )
    if current_scope == "snapshot":
        actual, actual_by = non_negative_values(store, features, keep=[SNAPSHOT]), [SNAPSHOT]
    else:
        actual, actual_by = non_negative_values(store, features), []
    terms = psi_buckets(expected, actual, [SNAPSHOT], actual_by, buckets)
    return psi_total(terms, [SNAPSHOT]).withColumn(
        "baseline_date", F.expr(f"add_months({SNAPSHOT}, -1)")
    )
