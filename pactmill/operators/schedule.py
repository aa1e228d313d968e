"""Batch plan: which row goes into which step and micro-batch of which epoch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pactmill import fixed_values as fv
from pactmill.operators import ordering


def batch_plan(
    df: DataFrame,
    key: str,
    epochs: int = fv.EPOCHS,
    per_device: int = fv.BATCH_PER_DEVICE,
    accumulation: int = fv.ACCUMULATION,
    seed: int = fv.SPLIT_SEED,
) -> DataFrame:
    """Shuffle the keys anew in every epoch and cut them into steps of ``per_device * accumulation`` rows.

    Only the key is carried. Buckets are md5 prefixes, which are even whatever the keys look like; their number follows
    the rows.
    """
    digits = ordering.hex_digits(df.count())
    order = df.select(key, F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"))
    order = order.withColumn("_h", ordering.digest(F.col(key), F.col("epoch"), F.lit(seed)))
    order = order.withColumn("_bucket", F.substring("_h", 1, digits))
    offsets = ordering.bucket_offsets(order, "_bucket", F.lit(1), within=["epoch"])
    inside = Window.partitionBy("epoch", "_bucket").orderBy("_h", key)
    # offsets: one row per prefix and epoch
    pos = F.col("_offset") + F.row_number().over(inside) - 1
    per_step = per_device * accumulation
    return (
        order.join(F.broadcast(offsets), ["epoch", "_bucket"])
        .withColumn("pos", pos.cast("bigint"))
        .select(
            key,
            F.col("epoch").cast("bigint").alias("epoch"),
            "pos",
            F.expr(f"pos div {per_step}").alias("step"),
            F.expr(f"(pos div {per_device}) % {accumulation}").alias("micro"),
        )
    )
