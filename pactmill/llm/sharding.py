"""Shuffling a corpus into shards in two passes.

Pass one scatters rows uniformly into buckets that fit in memory, by a seeded hash of key and content. Pass two takes
one bucket at a time, shuffles it by Fisher-Yates and writes it. Buckets follow each other, so a row's place in the whole order is the rows
of earlier buckets plus its place in its own; dealing places out in turn gives shards whose counts differ by one at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pactmill import session

BUCKET_BYTES = 16 << 20  # text bytes of a bucket
OFFSETS_BROADCAST = 100_000  # more buckets than this are joined by a shuffle instead
ROW_OVERHEAD = 8


def size(text) -> F.Column:
    """UTF-8 bytes of the text, none for null, plus a fixed overhead."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + ROW_OVERHEAD


def crc(text) -> F.Column:
    """Unsigned CRC-32 of the UTF-8 text; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniformly random order of n places."""
    order = np.arange(n)
    picks = np.random.default_rng(seed).integers(0, np.arange(n) + 1) if n else order
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return order


def _shuffled(seed: int, row_type: pa.DataType):
    def run(table: pa.Table) -> pa.Table:
        """One bucket. Rows are first put in an order of their own, so the result does not depend on their arrival."""
        bucket = table.column("bucket")[0].as_py()
        settled = pc.sort_indices(table.select(["settle", "tie"]), [("settle", "ascending"), ("tie", "ascending")])
        order = settled.take(pa.array(fisher_yates(len(table), [seed, bucket])))
        rows = table.column("row").take(order).cast(row_type)
        return pa.table({"bucket": table.column("bucket"), "pos": pa.array(np.arange(len(table))), "row": rows})

    return run


def _placed(df: DataFrame, key: str, text: str, seed: int, buckets: int, bucket_bytes: int) -> DataFrame:
    """Rows with the bucket a seeded hash of key and text gives them. Rows that agree in both would all meet in one bucket: where they are larger than
    a bucket, each next bucketful of them is hashed apart, so that how many go where depends on nothing but their number.
    They are numbered by an offset per task that read them and a count inside of it."""
    rows = df.select(
        F.struct("*").alias("row"), F.xxhash64(F.lit(seed), F.col(key), crc(F.col(text))).alias("settle"),
        F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63))).alias("tie"),
    )
    bucket = lambda *parts: F.pmod(F.xxhash64(F.lit(seed + 1), *parts), F.lit(buckets))
    sized = rows.select("settle", size(F.col(f"row.`{text}`")).alias("size"))
    hot = sized.groupBy("settle").agg(F.sum("size").alias("all"), F.max("size").alias("one")).where(F.col("all") > bucket_bytes)
    # no more of these than there are buckets
    hot = session.stored(hot.select("settle", F.greatest(F.lit(1), F.expr(f"{bucket_bytes} div one")).alias("_per")), "hot-rows")
    n_hot = hot.count()
    if not n_hot:
        return rows.withColumn("bucket", bucket(F.col("settle")))
    hot = F.broadcast(hot) if n_hot <= OFFSETS_BROADCAST else hot
    inside = Window.partitionBy("settle", "_task").orderBy("tie")
    many = rows.withColumn("_task", F.spark_partition_id()).join(hot, "settle").withColumn("_n", F.row_number().over(inside))
    many = session.stored(many, "hot-row-numbers")
    before = Window.partitionBy("settle").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    offsets = many.groupBy("settle", "_task").agg(F.max("_n").alias("_rows")).select(
        "settle", "_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    turn = F.expr("(_offset + _n - 1) div _per")
    many = many.join(offsets, ["settle", "_task"]).withColumn("bucket", bucket(F.col("settle"), turn)).select("row", "settle", "tie", "bucket")
    few = rows.join(hot, "settle", "left_anti").withColumn("bucket", bucket(F.col("settle")))
    return few.select("row", "settle", "tie", "bucket").unionByName(many)


def write_shuffled(
    df: DataFrame, folder: str, key: str = "doc_id", text: str = "text", seed: int = 0, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Write ``df`` to ``folder`` in a random order and give the table back: bucket, pos, row (all columns as a struct).

    The same rows and seed give the same order. Rows that agree in key and text are interchangeable, also where other columns differ; no
    more than a bucketful of them is kept together.
    """
    total = df.agg(F.sum(size(F.col(text)))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    placed = _placed(df, key, text, seed, buckets, bucket_bytes)
    shape = f"bucket bigint, pos bigint, row {df.schema.simpleString()}"
    row_type = to_arrow_type(df.sparkSession.createDataFrame([], shape).schema["row"].dataType)  # all fields may be null
    placed.groupBy("bucket").applyInArrow(_shuffled(seed, row_type), shape).write.parquet(folder)
    return df.sparkSession.read.schema(shape).parquet(folder)


def numbered(shuffled: DataFrame, shards: int) -> DataFrame:
    """Add shard and slot to what ``write_shuffled`` has written. Counts of shards differ by one at most, slots have no
    gaps."""
    counts = shuffled.groupBy("bucket").count()
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket, no data rows
    offsets = counts.select("bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    if offsets.count() <= OFFSETS_BROADCAST:
        offsets = F.broadcast(offsets)
    place = F.col("_offset") + F.col("pos")
    return shuffled.join(offsets, "bucket").select(
        "row", F.pmod(place, F.lit(shards)).cast("int").alias("shard"), F.expr(f"(_offset + pos) div {shards}").alias("slot")
    )


def sharded(
    df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = 0, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All rows of ``df`` (as a struct column ``row``) with their shard and slot.

    Texts move once and are written once, to the shared folder. Null texts and keys, empty tables and repeated rows need
    nothing special: every input row gets one place.
    """
    folder = session.scratch_folder(df.sparkSession, "shuffled")
    return numbered(write_shuffled(df, folder, key, text, seed, bucket_bytes), shards)
