"""Run metrics: checkpoints to load and keep, final figures, cadence. Input is long: run_id, step, metric, value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pactmill import fixed_values as fv
from pactmill.functions import text as tx


def _figures(metrics: DataFrame, metric: str) -> DataFrame:
    """Rows of one metric that hold a figure; NULL and NaN are none."""
    return metrics.where((F.col("metric") == metric) & F.col("value").isNotNull() & ~F.isnan("value"))


def best_checkpoint(metrics: DataFrame, metric: str = "eval_loss") -> DataFrame:
    """Step with the lowest evaluation loss per run; the earliest one on ties. Partial aggregation, no sort."""
    best = F.min(F.struct("value", "step"))
    return _figures(metrics, metric).groupBy("run_id").agg(best.alias("b")).select(
        "run_id", F.col("b.step").alias("best_step"), F.col("b.value").alias("best_loss")
    )


def latest_checkpoint(metrics: DataFrame, save_every: int = fv.SAVE_EVERY) -> DataFrame:
    """Highest saved step per run, as a number: a checkpoint is written every ``save_every`` steps only. Runs without one do
    not appear."""
    return at_cadence(metrics, save_every).where(F.col("step") > 0).groupBy("run_id").agg(F.max("step").alias("latest_step"))


def final_figures(metrics: DataFrame) -> DataFrame:
    """Last training loss and runtime per run, NULL where a run has none, with the runtime in minutes too."""
    def last(metric: str):
        is_metric = F.col("metric") == metric
        return F.max_by(F.when(is_metric, F.col("value")), F.when(is_metric, F.col("step")))

    return (
        metrics.groupBy("run_id")
        .agg(last("train_loss").alias("final_loss"), last("train_runtime").alias("runtime_s"))
        .withColumn("runtime_min", tx.minutes(F.col("runtime_s")))
    )


def kept_checkpoints(metrics: DataFrame, keep: int = fv.KEEP_CHECKPOINTS, metric: str = "eval_loss") -> DataFrame:
    """The ``keep`` best checkpoints per run. Spark limits each task to ``keep`` rows per run before the shuffle."""
    order = Window.partitionBy("run_id").orderBy("value", "step")
    return (
        _figures(metrics, metric)
        .select("run_id", "step", F.col("value").alias("loss"), F.row_number().over(order).alias("place"))
        .where(F.col("place") <= keep)
    )


def at_cadence(metrics: DataFrame, every: int) -> DataFrame:
    """Rows whose step is a multiple of ``every``."""
    return metrics.where(F.col("step") % every == 0)
