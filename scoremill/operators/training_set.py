"""Building the labelled training table and describing it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoremill.functions.dates import TrainingWindows
from scoremill.schemas import CUSTOMER, LABEL, LABEL_STORE, SNAPSHOT


def label_feature_join(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Left join of labels to every feature row of the same customer.

    The feature date is dropped, so a customer with several feature snapshots fans out and a label
    without features keeps one row of nulls.

    Labels with features take an inner join: Spark broadcasts the labels when they are few, as those of
    a window are, and then the features stay where they are; else adaptive execution splits a hot
    customer on either side, which it doesn't in a left join. Labels without any feature are added.
    """
    facts = features.drop(SNAPSHOT)
    wanted = labels.select(CUSTOMER).distinct()
    known = features.select(CUSTOMER).join(wanted, CUSTOMER, "left_semi").distinct()
    without = labels.join(known, CUSTOMER, "left_anti")
    return labels.join(facts, CUSTOMER).unionByName(without, allowMissingColumns=True)


def label_feature_asof_join(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Left join of labels to the customer's last feature snapshot at or before the label's date.

    Every label gives one row, without features where there is no earlier snapshot, no date or no customer;
    ``feature_date`` is the snapshot's date. Of several feature rows of a customer and date the greatest counts.

    Only dates take part in the search, each customer's once, and time is cut into months: within a month a
    window finds the last snapshot so far, a month's last snapshot is carried on to the months behind it. So
    a customer with a third of all rows is a row per date before any window sees it, and its labels and
    snapshots meet by customer and date.
    """
    day = F.col(SNAPSHOT)
    wanted = labels.filter(F.col(CUSTOMER).isNotNull() & day.isNotNull())
    facts = [name for name in features.columns if name not in (CUSTOMER, SNAPSHOT)]
    latest = (
        features.filter(day.isNotNull())
        .join(wanted.select(CUSTOMER).distinct(), CUSTOMER, "left_semi")
        .groupBy(CUSTOMER, SNAPSHOT)
        .agg(F.max(F.struct(*facts)).alias("facts"))
    )
    dates = (
        wanted.select(CUSTOMER, SNAPSHOT, F.lit(None).cast("date").alias("seen"))
        .unionByName(latest.select(CUSTOMER, SNAPSHOT, day.alias("seen")))
        .groupBy(CUSTOMER, SNAPSHOT)
        .agg(F.max("seen").alias("seen"))
        .withColumn("cell", F.trunc(SNAPSHOT, "month"))
    )
    so_far = Window.partitionBy(CUSTOMER, "cell").orderBy(SNAPSHOT).rowsBetween(Window.unboundedPreceding, 0)
    within = dates.withColumn("seen", F.max("seen").over(so_far))
    earlier = Window.partitionBy(CUSTOMER).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = dates.groupBy(CUSTOMER, "cell").agg(F.max("seen").alias("last"))
    carried = carried.select(CUSTOMER, "cell", F.max("last").over(earlier).alias("carried"))
    found = within.join(carried, [CUSTOMER, "cell"]).select(
        CUSTOMER, SNAPSHOT, F.coalesce("seen", "carried").alias("feature_date")
    )
    dated = labels.join(found, [CUSTOMER, SNAPSHOT], "left")
    latest = latest.select(CUSTOMER, day.alias("feature_date"), F.col("facts").alias("_facts"))
    joined = dated.join(latest, [CUSTOMER, "feature_date"], "left")
    return joined.select(*labels.columns, "feature_date", *(F.col(f"_facts.{name}").alias(name) for name in facts))


def with_period(df: DataFrame, windows: TrainingWindows) -> DataFrame:
    """Mark rows as ``oot``, ``train_test`` or null by their snapshot date."""
    day = F.col(SNAPSHOT)
    return df.withColumn(
        "period",
        F.when(day.between(F.lit(windows.oot_start), F.lit(windows.oot_end)), "oot").when(
            day.between(F.lit(windows.train_test_start), F.lit(windows.train_test_end)),
            "train_test",
        ),
    )


def feature_columns(df: DataFrame, exclude: Iterable[str] = LABEL_STORE.fieldNames()) -> list[str]:
    """Names of the numeric columns that are neither keys nor label."""
    left_out = {name.lower() for name in exclude}
    return [
        field.name
        for field in df.schema
        if isinstance(field.dataType, T.NumericType) and field.name.lower() not in left_out
    ]


def split_stats(df: DataFrame, by: Iterable[str] = ("split",), label: str = LABEL) -> DataFrame:
    """Row count and label rate of each split, in one pass."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(label), 2).alias("label_rate")
    )
