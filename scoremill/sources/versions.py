"""Stores whose partitions are replaced at one stroke.

A write goes to folders of its own, ``<partition>/version=<token>``, and touches nothing that is there. A list of the
live folders, ``_versions/<number>.json``, is then put in place by one rename that fails if the number is taken, so
two writers can't both win and the loser takes the next number. Readers follow the highest list. A job that dies at
any point leaves the old rows in place; what it wrote is in no list and goes with the next sweep.

Lists hold a line per partition (a model and a date), not per file or row. The rename has to be atomic, as it is on
HDFS and local file systems.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LISTS, VERSION = "_versions", "version"
ATTEMPTS = 20


class _Files:
    """The few file operations that are needed, by Hadoop's own file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        path = self.path(root)
        self.fs = path.getFileSystem(self.conf)
        self.root = self.fs.makeQualified(path).toString().rstrip("/")

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def found(self, pattern: str) -> list:
        return list(self.fs.globStatus(self.path(f"{self.root}/{pattern}")) or ())

    def text(self, name: str) -> str:
        stream = self.fs.open(self.path(f"{self.root}/{name}"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(f"{self.root}/{name}"), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> bool:
        """Rename unless the new name is taken; whether it was done."""
        source, target = (self.path(f"{self.root}/{name}") for name in (old, new))
        options = self.jvm.org.apache.hadoop.fs.Options
        none = self.gateway.new_array(getattr(options, "Rename"), 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self.conf)
        try:
            context.rename(source, target, none)
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(f"{self.root}/{name}"), True)


def _lists(files: _Files) -> list[int]:
    names = (status.getPath().getName() for status in files.found(f"{LISTS}/*.json"))
    return sorted(int(name.removesuffix(".json")) for name in names if name[0].isdigit())


def _live(files: _Files, number: int) -> dict[str, str]:
    return json.loads(files.text(f"{LISTS}/{number:09d}.json"))


def current(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """Number of the list in force and the live folder of each partition; 0 and nothing for a new store."""
    files = _Files(spark, root)
    numbers = _lists(files)
    return (numbers[-1], _live(files, numbers[-1])) if numbers else (0, {})


def partition_path(spark: SparkSession, values: Mapping[str, object]) -> str:
    """Folder of a partition, special characters written as Spark writes them."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(utils.getPartitionPathString(name, str(value)) for name, value in values.items())


def publish(
    df: DataFrame,
    root: str,
    by: Sequence[str],
    replaced: Sequence[Mapping[str, object]] = (),
    file_format: str = "parquet",
    **options: object,
) -> int:
    """Replace the partitions that ``df`` has rows of, and those in ``replaced`` also if it has none.

    Returns the number of the list that made the rows visible. Other partitions stay as the latest list has them.
    """
    spark = df.sparkSession
    files, token = _Files(spark, root), uuid.uuid4().hex
    written = _write(df, files, by, token, file_format, options)
    gone = {partition_path(spark, values) for values in replaced}
    return _switch(files, gone, written, token)


def _write(df: DataFrame, files: _Files, by: Sequence[str], token: str, file_format: str, options: dict) -> list[str]:
    """Write under the token; returns the partitions written."""
    (
        df.hint("rebalance", *by)
        .withColumn(VERSION, F.lit(token))
        .write.partitionBy(*by, VERSION)
        .format(file_format)
        .options(**options)
        .mode("append")
        .save(files.root)
    )
    folders = files.found("/".join(["*=*"] * len(by) + [f"{VERSION}={token}"]))
    return [status.getPath().getParent().toString().removeprefix(files.root + "/") for status in folders]


def _switch(files: _Files, gone: set[str], written: Sequence[str], token: str) -> int:
    draft = f"{LISTS}/.{token}.draft"
    for _ in range(ATTEMPTS):
        numbers = _lists(files)
        live = _live(files, numbers[-1]) if numbers else {}
        live = {path: version for path, version in live.items() if path not in gone}
        live |= dict.fromkeys(written, token)
        number = (numbers[-1] if numbers else 0) + 1
        files.put(draft, json.dumps(live, sort_keys=True))
        if files.rename(draft, f"{LISTS}/{number:09d}.json"):
            return number
        time.sleep(0.05)
    raise RuntimeError(f"{files.root}: other writers were faster {ATTEMPTS} times")


def read(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    file_format: str = "parquet",
    number: int | None = None,
    **options: object,
) -> DataFrame:
    """The live rows, or those of an earlier list that was not swept; a store that isn't there is empty."""
    files = _Files(spark, root)
    live = current(spark, root)[1] if number is None else _live(files, number)
    if not live:
        return spark.createDataFrame([], schema)
    folders = [f"{files.root}/{path}/{VERSION}={version}" for path, version in sorted(live.items())]
    whole = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    reader = spark.read.schema(whole).options(**options).option("basePath", files.root)
    return reader.load(folders, format=file_format).select(schema.fieldNames())


def sweep(spark: SparkSession, root: str, by: Sequence[str], keep: int = 2, older_than: float = 86_400) -> list[str]:
    """Delete folders that none of the last ``keep`` lists names, and the lists before these.

    Folders younger than ``older_than`` seconds stay: a writer may be about to list them. Returns what was deleted.
    """
    files = _Files(spark, root)
    numbers = _lists(files)
    kept = numbers[-keep:]
    named = {(path, version) for number in kept for path, version in _live(files, number).items()}
    before = time.time() - older_than
    removed = []
    for status in files.found("/".join(["*=*"] * len(by) + [f"{VERSION}=*"])):
        path = status.getPath()
        place = path.getParent().toString().removeprefix(files.root + "/")
        if (place, path.getName().split("=", 1)[1]) in named or status.getModificationTime() / 1000 > before:
            continue
        files.delete(f"{place}/{path.getName()}")
        removed.append(f"{place}/{path.getName()}")
    for number in numbers[: -keep or None]:
        files.delete(f"{LISTS}/{number:09d}.json")
    return removed
