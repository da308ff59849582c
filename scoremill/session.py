"""Session set-up and the shared folder that long jobs cut their lineage into."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it gets a folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="scoremill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path below the shared root."""
    return os.path.join(shared_root(spark), "scoremill", f"{purpose}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, purpose: str, **options: object) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and go on from the files.

    Later passes neither repeat the joins before it nor depend on executors that may be lost. ``options`` go to the
    writer.
    """
    path = run_folder(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._scoremill_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete what ``materialise`` wrote, once nothing that is still to be computed reads it."""
    for df in stored:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._scoremill_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
