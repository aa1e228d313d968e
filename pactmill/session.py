"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Duplicate JSON keys: the last one wins, as in a strict JSON reader that builds a dictionary.
# Generated methods above 8000 bytes of bytecode are never compiled by the JVM; Spark then splits the work instead.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # state of streams on local disk with change logs in the checkpoint, so that a batch writes what it changed
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_BYTES = 2 << 20  # planned bytes a partition; the planner counts compressed files, so that rows take several times this
MOST_PARTITIONS = 8192


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to a session someone else created, and send it this package."""
    for name, value in SESSION_SETTINGS.items():
        spark.conf.set(name, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per Spark context, wherever the driver imported it from."""
    context = spark.sparkContext
    if getattr(context, "_pactmill_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    with tempfile.TemporaryDirectory(prefix="pactmill-") as folder:
        staged = os.path.join(folder, "staged")
        shutil.copytree(package, os.path.join(staged, "pactmill"), ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="pactmill-"), "pactmill"), "zip", staged))
    context._pactmill_shipped = True


def build(app: str = "pactmill", master: str | None = None, **settings: str) -> SparkSession:
    """Create a session; ``settings`` use underscores twice for dots (``spark__driver__memory``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder the cluster names: ``spark.checkpoint.dir``, else the checkpoint folder of
    the Spark context. Where neither is set, a local one if the master is local, an error if it is not."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="pactmill-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a narrow intermediate table to the shared folder and read it back: later passes do not repeat the work
    behind it, and it survives the loss of executors."""
    folder = scratch_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def finer(*frames: DataFrame) -> None:
    """Let the session's shuffles start from as many partitions as tables of this size need, so that a task's share does not grow with them.

    AQE joins small ones to its advisory size again and splits hot ones, which it does not do where a repartitioning fixes their number. The
    setting stays with the session and is only ever raised.
    """
    spark = frames[0].sparkSession
    size = sum(_planned_bytes(df) for df in frames)
    known = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(-(-size // SHUFFLE_BYTES), MOST_PARTITIONS)
    if wanted > known:
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))


def _planned_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """Rows for costly work per row, dealt out evenly where the source is too small to give every core a task of its own.

    A Parquet file of one row group is read by one task, however long its rows take. Only a table that the planner takes to be smaller than a full
    split per core is dealt out; a larger one has splits enough and is left where it is. Filters and column choices still reach the scan.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    size = _planned_bytes(df)
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if size < cores * split else df
