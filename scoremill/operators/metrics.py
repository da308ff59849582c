"""Exact ROC AUC, Gini, confusion matrices and ranked importances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoremill.functions.numeric import gini, present
from scoremill.schemas import LABEL


def auc(
    df: DataFrame, by: Sequence[str] = ("split",), label: str = LABEL, score: str = "score"
) -> DataFrame:
    """ROC AUC per group with tied scores counted half; null where one class is absent.

    Rows without a score (null, NaN) or with a label other than 0 and 1 have no place in it: ``n_excluded``
    counts them, and ``complete`` fails where there are any.

    Rows are first counted per distinct score, which folds hot scores on the map side. The distinct
    scores are range-partitioned, so blocks are even whatever the score distribution; each block
    counts its own pairs, and only one row per block goes on to the running total across blocks.
    """
    group = list(by)
    usable = present(score) & F.expr(f"coalesce({label} IN (0, 1), false)")
    per_score = (
        df.select(
            *group,
            F.when(usable, F.expr(f"CAST({score} AS DOUBLE)")).alias("score"),
            F.when(usable, F.col(label)).alias("_label"),
        )
        .groupBy(*group, "score")
        .agg(
            F.expr("CAST(count_if(_label = 1) AS DOUBLE) AS pos"),
            F.expr("CAST(count_if(_label = 0) AS DOUBLE) AS neg"),
            F.expr("count_if(_label IS NULL) AS excluded"),
        )
    )
    blocks = per_score.repartitionByRange(*group, "score").withColumn(
        "block", F.spark_partition_id()
    )
    before = (Window.unboundedPreceding, -1)
    in_block = Window.partitionBy(*group, "block").orderBy("score").rowsBetween(*before)
    block_sums = (
        blocks.withColumn("below", F.sum("neg").over(in_block))
        .groupBy(*group, "block")
        .agg(
            F.expr("sum(pos) AS pos"),
            F.expr("sum(neg) AS neg"),
            F.expr("sum(excluded) AS excluded"),
            F.expr("sum(pos * (coalesce(below, 0D) + neg / 2)) AS pairs"),
        )
    )
    # One row per block: bounded by the number of shuffle partitions, not by the data.
    across = Window.partitionBy(*group or [F.lit(0)]).orderBy("block").rowsBetween(*before)
    return (
        block_sums.withColumn("below", F.sum("neg").over(across))
        .groupBy(*group)
        .agg(
            F.expr(
                "try_divide(sum(pairs + pos * coalesce(below, 0D)), sum(pos) * sum(neg)) AS auc"
            ),
            F.expr("CAST(sum(pos) AS BIGINT) AS n_pos"),
            F.expr("CAST(sum(neg) AS BIGINT) AS n_neg"),
            F.expr("sum(excluded) AS n_excluded"),
        )
    )


def complete(measured: DataFrame) -> DataFrame:
    """``measured`` without ``n_excluded``; running it fails if a row was left out of the figures."""
    return measured.filter(
        "CASE WHEN n_excluded > 0 THEN raise_error(concat(n_excluded, "
        "' rows have no score or a label other than 0 and 1')) ELSE true END"
    ).drop("n_excluded")


def auc_and_gini(
    df: DataFrame, by: Sequence[str] = ("split",), label: str = LABEL, score: str = "score"
) -> DataFrame:
    return auc(df, by, label, score).withColumn("gini", gini("auc"))


def hard_label_auc(
    df: DataFrame, by: Sequence[str] = (), label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """AUC of 0/1 predictions, which is the mean of the two class hit rates; one plain aggregate.

    Running it fails on labels and predictions other than 0 and 1, null and NaN included.
    """
    hit_rate = "avg(CASE WHEN {0} = {1} THEN CAST({2} = {1} AS DOUBLE) END)".format
    rates = (hit_rate(label, value, prediction) for value in (0, 1))
    inside = f"{label} IN (0, 1) AND {prediction} IN (0, 1)"
    outside = f"count_if(NOT coalesce({inside}, false))"
    refused = f"raise_error(concat({outside}, ' rows have a label or prediction other than 0 and 1'))"
    auc_of = f"({' + '.join(rates)}) / 2"
    return df.groupBy(*by).agg(F.expr(f"CASE WHEN {outside} > 0 THEN CAST({refused} AS DOUBLE) ELSE {auc_of} END AS auc"))


def confusion_matrix(
    df: DataFrame,
    by: Sequence[str] = ("split",),
    label: str = LABEL,
    prediction: str = "prediction",
) -> DataFrame:
    """Row counts of the four label/prediction cells of each group, empty cells included.

    Running it fails on rows that belong to no cell: null, NaN and values other than 0 and 1.
    """
    group = list(by)
    cells = ", ".join(
        f"struct({actual} AS label, {predicted} AS prediction, "
        f"count_if({label} = {actual} AND {prediction} = {predicted}) AS n_rows)"
        for actual in (0, 1)
        for predicted in (0, 1)
    )
    inside = f"{label} IN (0, 1) AND {prediction} IN (0, 1)"
    counted = df.groupBy(*group).agg(
        F.expr(f"array({cells}) AS cells"),
        F.expr(f"count_if(NOT coalesce({inside}, false)) AS outside"),
    )
    counted = counted.filter(
        "CASE WHEN outside > 0 THEN raise_error(concat(outside, "
        "' rows have a label or prediction other than 0 and 1')) ELSE true END"
    )
    return counted.select(*group, F.inline("cells"))


def feature_importance(spark: SparkSession, importances: Mapping[str, float]) -> DataFrame:
    """Importances ranked from the highest down, ties by name."""
    ranked = sorted(importances.items(), key=lambda item: (-item[1], item[0]))
    rows = [(rank, name, float(value)) for rank, (name, value) in enumerate(ranked, start=1)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
