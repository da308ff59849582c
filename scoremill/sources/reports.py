"""Sinks of the monthly job: predictions, drift history and the monitoring summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.functions.dates import formatted_date
from scoremill.schemas import MODEL, PREDICTIONS, PSI_RESULTS, SNAPSHOT, SUMMARY
from scoremill.session import materialise
from scoremill.sources.versions import partition_path, publish, read

BY_RUN = (MODEL, SNAPSHOT)


def write_predictions(df: DataFrame, root: str, replaced: Sequence[Mapping[str, object]] = ()) -> None:
    """Predictions by model and snapshot; a rerun replaces its own partition only, at one stroke."""
    publish(df.select(PREDICTIONS.fieldNames()), root, BY_RUN, replaced)


def read_predictions(spark: SparkSession, root: str) -> DataFrame:
    return read(spark, root, PREDICTIONS)


def replace_run(
    df: DataFrame, root: str, run: Mapping[str, object], file_format: str = "parquet"
) -> None:
    """Replace the files of one run in a plain folder that any reader can open.

    The rows are stored apart first. The old partition goes only when the new one is complete, or when there are no
    rows to put in its place.
    """
    spark = df.sparkSession
    df = materialise(df, "run")
    if df.isEmpty():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{partition_path(spark, run)}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return
    (
        df.write.partitionBy(*run)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .format(file_format)
        .save(root)
    )


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows without those whose key is in ``new``, followed by ``new``."""
    kept = existing.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new)


def write_psi_history(df: DataFrame, root: str) -> None:
    """Add drift rows to the CSV history, replacing rows of the same model, feature and date.

    Partitions are runs, a model and a date, so the files don't grow with the number of features. What
    the run's partitions hold for other features is written again beside the new rows.
    """
    runs = df.select(*BY_RUN).distinct()
    earlier = read_psi_history(df.sparkSession, root).join(runs, list(BY_RUN), "left_semi")
    merged = upsert(earlier, df.select(PSI_RESULTS.fieldNames()), [*BY_RUN, "feature_name"])
    # The file format knows columns by their place only.
    publish(merged.select(PSI_RESULTS.fieldNames()), root, BY_RUN, file_format="csv", header=True)


def read_psi_history(spark: SparkSession, root: str) -> DataFrame:
    return read(spark, root, PSI_RESULTS, "csv", header=True)


def write_summary(df: DataFrame, root: str) -> None:
    publish(df.select(SUMMARY.fieldNames()), root, BY_RUN)


def read_summary(spark: SparkSession, root: str) -> DataFrame:
    return read(spark, root, SUMMARY)


def summary_text(summary: DataFrame) -> DataFrame:
    """The summary as readable lines, one text per model and snapshot."""
    # Headings, bullet texts and their order.
    line = (
        F.when(F.col("metric") == "feature", F.concat(F.lit("- Feature: "), "value"))
        .when(F.col("metric") == "psi_value", F.concat(F.lit("- PSI Value: "), "value"))
        .when(F.col("metric") == "psi_status", F.concat(F.lit("- Status: "), "value"))
        .when(F.col("metric") == "predictions", F.concat(F.lit("- Predictions: "), "value"))
        .when(F.col("metric") == "features", F.concat(F.lit("- Features: "), "value"))
        .when(F.col("metric") == "labels", F.concat(F.lit("- Labels (for AUC): "), "value"))
    )
    metrics = ["feature", "psi_value", "psi_status", "predictions", "features", "labels"]
    order = F.array_position(F.array(*map(F.lit, metrics)), F.col("metric"))
    stability = F.col("metric").isin("feature", "psi_value", "psi_status")
    # Lines of one feature stay together.
    placed = F.struct(F.coalesce("feature", F.lit("")).alias("of"), order.alias("at"), line.alias("line"))
    grouped = summary.groupBy(MODEL, SNAPSHOT).agg(
        F.array_sort(F.collect_list(F.when(stability, placed))).alias("stability"),
        F.array_sort(F.collect_list(F.when(~stability, placed))).alias("volumes"),
    )
    texts = {name: F.transform(F.col(name), lambda x: x["line"]) for name in ("stability", "volumes")}
    head = F.array(
        F.lit("Model Monitoring Summary"),
        F.lit("========================"),
        F.lit(""),
        F.concat(F.lit("Model: "), F.col(MODEL)),
        F.concat(F.lit("Snapshot Date: "), formatted_date(F.col(SNAPSHOT))),
        F.concat(F.lit("Generated: "), F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")),
        F.lit(""),
    )
    drift = F.when(
        F.size("stability") > 0,
        F.concat(F.array(F.lit("Data Stability (PSI):")), texts["stability"], F.array(F.lit(""))),
    ).otherwise(F.array().cast("array<string>"))
    volumes = F.concat(F.array(F.lit("Data Volumes:")), texts["volumes"])
    return grouped.select(
        MODEL, SNAPSHOT, F.array_join(F.concat(head, drift, volumes), "\n").alias("text")
    )

