"""Monitoring of one model and snapshot: drift, density curves and the summary."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoremill.functions.dates import date_literal, months_before, parse_date
from scoremill.functions.names import ARTEFACT_SUFFIX, bare_model_name
from scoremill.operators.density import curves_of, series
from scoremill.operators.drift import non_negative_values, psi_buckets, psi_total
from scoremill.schemas import (
    CUSTOMER,
    DEBT,
    LABEL,
    MODEL,
    PSI_RESULTS,
    SCORE,
    SNAPSHOT,
    SUMMARY,
)
from scoremill.session import materialise
from scoremill.sources.reports import replace_run, summary_text, write_psi_history, write_summary
from scoremill.sources.stores import at_snapshot


@dataclass(frozen=True)
class MonitorTables:
    """Results of a monitoring run; every one is lazy until written or read."""

    buckets: DataFrame
    psi: DataFrame
    curves: DataFrame
    summary: DataFrame


def prediction_label_join(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Predictions with the label of the same customer and snapshot."""
    return predictions.join(labels.select(CUSTOMER, SNAPSHOT, LABEL), [CUSTOMER, SNAPSHOT])


def psi_rows(totals: DataFrame, model_name: str, day: str | date) -> DataFrame:
    """PSI totals in the layout of the drift history."""
    run_date = parse_date(day)
    return totals.select(
        F.lit(model_name).alias(MODEL),
        F.lit(run_date).alias(SNAPSHOT),
        F.lit(months_before(run_date, 1)).alias("baseline_date"),
        F.col("feature").alias("feature_name"),
        "psi_value",
        "psi_status",
    ).select(PSI_RESULTS.fieldNames())


def monitor_summary(
    predictions: DataFrame,
    current: DataFrame,
    merged: DataFrame,
    psi: DataFrame,
    model_name: str,
    day: str | date,
    labels: DataFrame,
) -> DataFrame:
    """One row per metric; drift metrics name their feature, the others have none.

    Metrics of a part that was not computed are absent: drift without a baseline, and the label
    count when the snapshot has no labels at all.
    """
    drift = psi.select(
        F.inline(
            F.array(
                _metric("feature", F.col("feature_name")),
                _metric("psi_value", F.format_string("%.4f", "psi_value")),
                _metric("psi_status", F.col("psi_status")),
            )
        )
    )
    volumes = _volume(predictions, "predictions").unionByName(_volume(current, "features"))
    labelled = labels.agg(F.count(F.lit(1)).alias("n_labels")).filter("n_labels > 0")
    counted = merged.agg(F.count(F.lit(1)).alias("n"))
    merged_volume = labelled.select(
        F.lit(None).cast("string").alias("feature"),
        F.lit("labels").alias("metric"),
        counted.scalar().cast("string").alias("value"),
    )
    metrics = drift.unionByName(volumes).unionByName(merged_volume)
    return metrics.select(
        F.lit(model_name).alias(MODEL), date_literal(day).alias(SNAPSHOT), "feature", "metric", "value"
    ).select(SUMMARY.fieldNames())


def monitor(
    predictions: DataFrame,
    features: DataFrame,
    labels: DataFrame,
    model_name: str,
    day: str | date,
    watched: Sequence[str] = (DEBT,),
    current_scope: str = "all",
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, purpose: df,
) -> MonitorTables:
    """Drift of the watched features against the snapshot one month earlier, with curves and counts.

    The current side is the whole feature store, baseline included, unless ``current_scope`` is
    ``snapshot``. ``keep`` may store the two small tables that others are derived from, so that the
    stores are scanned once for them.
    """
    run_date = parse_date(day)
    of_model = at_snapshot(predictions.filter(F.col(MODEL) == model_name), run_date)
    labels_now = at_snapshot(labels, run_date)
    current = at_snapshot(features, run_date) if current_scope == "snapshot" else features
    baseline = at_snapshot(features, months_before(run_date, 1))

    current_values = non_negative_values(current, watched)
    buckets = psi_buckets(non_negative_values(baseline, watched), current_values)
    buckets = keep(buckets, "psi-buckets")
    psi = psi_rows(psi_total(buckets), model_name, run_date)
    curves = curves_of([current_values, series(of_model, SCORE)])
    summary = monitor_summary(
        of_model,
        current,
        prediction_label_join(of_model, labels_now),
        psi,
        model_name,
        run_date,
        labels_now,
    )
    return MonitorTables(buckets, psi, curves, keep(summary, "summary"))


def run_monitoring(
    predictions: DataFrame,
    features: DataFrame,
    labels: DataFrame,
    model_name: str,
    day: str | date,
    out: str,
    watched: Sequence[str] = (DEBT,),
    current_scope: str = "all",
) -> MonitorTables | None:
    """Compute and write all tables below ``out``; nothing happens without predictions that day.

    ``model_name`` may carry the artefact suffix; predictions are looked up, and tables stored, by the bare name.
    """
    model_name = bare_model_name(model_name)
    both = F.col(MODEL).isin(model_name, model_name + ARTEFACT_SUFFIX)  # older runs stored it with the suffix
    scored = predictions.filter(both).withColumn(MODEL, F.lit(model_name))
    if at_snapshot(scored, day).isEmpty():
        return None
    tables = monitor(
        scored, features, labels, model_name, day, watched, current_scope, keep=materialise
    )
    keys = [F.lit(model_name).alias(MODEL), date_literal(day).alias(SNAPSHOT)]
    write_psi_history(tables.psi, os.path.join(out, "psi_results"))
    run = {MODEL: model_name, SNAPSHOT: parse_date(day)}
    for name, table in (("psi_buckets", tables.buckets), ("kde_curves", tables.curves)):
        replace_run(table.select(*keys, "*"), os.path.join(out, name), run)
    write_summary(tables.summary, os.path.join(out, "summary"))
    replace_run(summary_text(tables.summary), os.path.join(out, "summary_text"), run, "text")
    return tables


def _metric(name: str, value: Column) -> Column:
    return F.struct(
        F.col("feature_name").alias("feature"), F.lit(name).alias("metric"), value.alias("value")
    )


def _volume(df: DataFrame, metric: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("string").alias("value")).select(
        F.lit(None).cast("string").alias("feature"), F.lit(metric).alias("metric"), "value"
    )

