"""Writing training corpora and run metrics. Rebalancing sizes the files and splits a hot split or run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

RUN_GROUPS = 64  # folders of a metrics table


def write_corpus(df: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> None:
    df.hint("rebalance", split).write.mode(mode).partitionBy(split).parquet(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Append rows (run_id, step, metric, value, ts) to a metrics table partitioned by groups of runs (``run_group``).

    A folder and a file for every run would cost more than its rows. Files are sorted by run, so that a reader of one run skips row groups.
    """
    grouped = df.withColumn("run_group", F.pmod(F.xxhash64("run_id"), F.lit(RUN_GROUPS)).cast("int"))
    ordered = grouped.hint("rebalance", "run_group").sortWithinPartitions("run_group", "run_id")
    ordered.write.mode("append").partitionBy("run_group").parquet(path)
