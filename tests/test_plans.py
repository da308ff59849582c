"""Plans at scale: what the registered queries may not contain, and how hot keys are split."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from scoremill.operators import density, metrics
from scoremill.operators.training_set import label_feature_join
from scoremill.oracle import ORACLE
from scoremill.registry import QUERIES
from scoremill.schemas import DEBT, LABEL_STORE

FITTED = {
    "gbt_fit_score",
    "logreg_fit_score",
    "feature_importance_rank",
    "random_search_cv",
    "run_record",
    "logistic_search_cv",
    "train_and_score",
    "tree_search_cv",
}
JAN = date(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql_but_the_fitted_ones():
    assert set(QUERIES) - set(ORACLE) == FITTED
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_all_pairs_and_no_python_in_the_plan(spark, data, name):
    text = plan_of(QUERIES[name](spark, data.replace("0.01", "0.001")))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert unwanted not in text


def test_entry_gives_the_known_value(spark, data):
    assert [r["psi_value"] for r in entry_points.entry(spark).collect()] == [1.610618]


def test_drift_reads_the_one_feature_it_needs(spark, data):
    text = plan_of(QUERIES["psi_total"](spark, data))
    assert "lineitem" not in text
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert schemas == {
        "o_custkey:bigint,o_orderdate:timestamp_ntz",
        "o_custkey:bigint",
        "c_custkey:bigint,c_acctbal:double",
    }
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in text


@pytest.fixture
def eager_skew_splitting(spark):
    """Small thresholds, so that small tables show what adaptive execution does to large ones."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_feature_key_is_split(spark, eager_skew_splitting):
    """One customer with a third of the feature rows can be split, as the join is an inner one."""
    features = spark.range(0, 30000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("customer_id"),
        F.lit(JAN).alias("snapshot_date"),
        F.rand(1).alias(DEBT),
    )
    labels = spark.createDataFrame(
        [(c, f"L{c}", 1, "d", JAN) for c in ("hot", "c1", "c2", "unknown")], LABEL_STORE
    )
    joined = label_feature_join(labels, features)
    assert len(joined.collect()) == 10000 + 3
    assert "skew=true" in plan_of(joined)


def test_hot_values_are_folded_before_the_shuffle(spark):
    """Grouping by score or value has a partial aggregate below its exchange."""
    frame = spark.range(0, 1000, numPartitions=4).selectExpr(
        "'s' AS split", "CAST(id % 2 AS INT) AS label", "IF(id % 3 = 0, 0.5D, rand(1)) AS score"
    )
    values = frame.selectExpr("split AS feature", "score AS value")
    for df in (metrics.auc(frame), density.kde_curves(values)):
        assert re.search(r"keys=\[[^\n]*normalizenanandzero[^\n]*functions=\[partial_count", plan_of(df))
