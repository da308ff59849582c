"""The two stores, derived from the provided order tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoremill.schemas import CUSTOMER, DEBT, LABEL, LABEL_STORE, LOAN, SNAPSHOT
from scoremill.sources.stores import scan_store

FEATURES = [
    DEBT,
    "total_price",
    "n_items",
    "sum_quantity",
    "sum_price",
    "avg_discount",
    "avg_tax",
]
TEXT_FEATURES = ["n_chars", "n_words", "n_lines", "non_letter_share", "upper_share"]
HIGH_PRIORITIES = ("1-URGENT", "2-HIGH")

TABLES = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "customer": "c_custkey bigint, c_acctbal double, c_mktsegment string",
    "lineitem": (
        "l_orderkey bigint, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double"
    ),
    "documents": "doc_id bigint, text string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = T.StructType.fromDDL(TABLES[name])
    return scan_store(spark, os.path.join(sf_dir, f"{name}.parquet"), schema)


def feature_store(spark: SparkSession, sf_dir: str, customer: str = "o_orderkey") -> DataFrame:
    """One feature row per order, dated the first of its month; line features may be null.

    Sums and means of doubles depend on the order of the rows in the last digits, which moves values
    that lie on a bucket edge. They are rounded, so that the store is the same in every run.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).cast("double").alias("n_items"),
            F.sum("l_quantity").alias("sum_quantity"),
            F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
            F.round(F.avg("l_discount"), 6).alias("avg_discount"),
            F.round(F.avg("l_tax"), 6).alias("avg_tax"),
        )
    )
    orders, holders = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return (
        orders.join(holders, F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col(customer).cast("string").alias(CUSTOMER),
            _month().alias(SNAPSHOT),
            F.col("c_acctbal").alias(DEBT),
            F.col("o_totalprice").alias("total_price"),
            *FEATURES[2:],
        )
    )


def label_store(spark: SparkSession, sf_dir: str, customer: str = "o_orderkey") -> DataFrame:
    """One label per order: 1 for the two highest priorities."""
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.col(customer).cast("string").alias(CUSTOMER),
            F.concat(F.lit("L"), F.col("o_orderkey").cast("string")).alias(LOAN),
            F.col("o_orderpriority").isin(*HIGH_PRIORITIES).cast("int").alias(LABEL),
            F.lit("high priority").alias("label_def"),
            _month().alias(SNAPSHOT),
        )
        .select(LABEL_STORE.fieldNames())
    )


def fixed_score() -> Column:
    """A score in [0, 1) that stands in for a model where SQL has to give the same answer."""
    return (F.col(DEBT) + 1000) / 11000


def quality_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with features of their whole text; ``label`` is the quality mark."""
    text = F.col("text")
    length = F.greatest(F.length(text), F.lit(1))
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    capitals = F.length(F.regexp_replace(text, r"\P{Lu}+", ""))
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(text, r"\s+")).cast("double").alias("n_words"),
        F.size(F.split(text, "\n")).cast("double").alias("n_lines"),
        (1 - letters / length).alias("non_letter_share"),
        (capitals / length).alias("upper_share"),
    )
    return documents.join(table(spark, sf_dir, "labels"), "doc_id").select(
        F.col("doc_id").cast("string").alias(CUSTOMER),
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias(LOAN),
        F.col("quality").alias(LABEL),
        *TEXT_FEATURES,
    )


def _month() -> Column:
    return F.trunc(F.col("o_orderdate").cast("date"), "month")
