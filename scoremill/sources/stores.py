"""Snapshot stores: one Parquet folder per entity, one partition per snapshot date."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoremill.functions.dates import date_literal
from scoremill.schemas import SNAPSHOT


def scan_store(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    file_format: str = "parquet",
    missing_ok: bool = False,
    **options: object,
) -> DataFrame:
    """Every file below ``root`` as one table, columns in schema order.

    The declared schema makes zero-byte files read as empty. With ``missing_ok`` a store that is not
    there yet is an empty table of the same schema; otherwise it raises, as an input has to be there.
    """
    try:
        stored = spark.read.schema(schema).options(**options).load(root, format=file_format)
        return stored.select(schema.fieldNames())
    except AnalysisException as error:
        if not missing_ok or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_store(df: DataFrame, root: str, by: tuple[str, ...] = (SNAPSHOT,)) -> None:
    """Write a store partitioned by ``by``, replacing only the partitions present in ``df``.

    The rebalance lets adaptive execution even out file sizes, also when one snapshot holds most
    of the rows.
    """
    (
        df.hint("rebalance", *by)
        .write.partitionBy(*by)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(root)
    )


def in_window(df: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Rows with ``start <= snapshot_date <= end``."""
    return df.filter(F.col(SNAPSHOT).between(date_literal(start), date_literal(end)))


def at_snapshot(df: DataFrame, day: str | date) -> DataFrame:
    """Rows of one snapshot; on a partitioned store this reads one folder."""
    return df.filter(F.col(SNAPSHOT) == date_literal(day))
