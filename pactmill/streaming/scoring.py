"""Scoring answers as they complete, and running totals over the scored files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pactmill.operators import evaluation
from pactmill.streaming import assembly

SCORED = (
    "request_id string, how string, status string, strategy int, missing string, method_valid boolean, "
    "endpoint_valid boolean, valid boolean, score double, batch_id bigint"
)


def _scored(answers: DataFrame) -> DataFrame:
    return evaluation.evaluate(answers, "answer").select(
        "request_id", "how", "status", "strategy", F.array_join("missing", ",").alias("missing"),
        "method_valid", "endpoint_valid", "valid", "score",
    )


def batch_writer(out: str, unusable: str | None = None):
    """Writes a micro-batch of answers: scored rows to one folder of ``out``, rows that were no chunks to one of ``unusable``. A batch that is
    written again replaces both."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if unusable is None:
            _scored(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            return
        batch.persist()  # both writes are of one run of the batch
        try:
            lines = batch.where(F.col("how") == assembly.UNUSABLE).select(F.col("answer").alias("line"))
            lines.write.mode("overwrite").parquet(f"{unusable}/batch_id={batch_id}")
            answers = batch.where(F.col("how") != assembly.UNUSABLE)
            _scored(answers).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def start_scoring(answers: DataFrame, out: str, checkpoint: str, once: bool = True, unusable: str | None = None) -> StreamingQuery:
    """Extract, check and score every completed answer; one folder per micro-batch, rewritten when it is retried. With a folder for
    ``unusable`` rows, which ``assembled`` keeps on request, the same query writes these too: the source is read once for both."""
    return _start(answers.writeStream.foreachBatch(batch_writer(out, unusable)).outputMode("append"), checkpoint, once)


def start_totals(spark: SparkSession, scored: str, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Totals over the scored files, in a query of its own: one row per scored batch.

    Whenever files of a batch arrive, the totals of that batch are taken anew from what its folder holds by then. A batch that
    is scored again after a failure replaces its folder, and so its totals, instead of being counted twice.
    """
    def write(arrived: DataFrame, _: int) -> None:
        batches = arrived.select("batch_id").distinct()  # as many as there are new folders
        rows = spark.read.schema(SCORED).parquet(scored).join(F.broadcast(batches), "batch_id", "left_semi")
        totals = rows.groupBy("batch_id").agg(
            F.count_if("valid").alias("n_valid"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.round("score", 4).cast("decimal(9,4)")).alias("sum_score"),
        )
        totals.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out)

    rows = spark.readStream.schema(SCORED).parquet(scored)
    return _start(rows.writeStream.foreachBatch(write).outputMode("append"), checkpoint, once)


def latest_totals(spark: SparkSession, out: str) -> DataFrame:
    """The totals of all batches so far, with the mean score."""
    shape = "n_valid bigint, n bigint, sum_score decimal(19,4), batch_id bigint"
    found = spark.read.schema(shape).parquet(out).agg(*[F.sum(c).alias(c) for c in ("n_valid", "n", "sum_score")])
    return found.select(
        "n_valid", "n", F.round(F.try_divide(F.col("sum_score").cast("double"), F.col("n")), 6).alias("mean_score")
    )


def _start(writer, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
