"""Exact global positions and cuts without sending all rows through one task.

Two needs, two ways:

* A *cut* (the first k rows by some order) needs only the key value at position k. It is found by counting rows per
  cell and narrowing to the cell that holds position k; the rows themselves never move.
* A *position* (or running sum) for every row is an offset per bucket plus a window inside the bucket. Buckets are the
  partitions of a range partitioning of the narrow (key, weight) rows, stored once, so that they stay what they are. Their
  number follows the rows; the plan is the same at every size.

Only per-cell counts reach the driver, at most ``CELLS`` rows per round. Offsets are one row per bucket, that is one per
``ROWS_PER_BUCKET`` rows, or per shuffle partition if those are more: 100,000 of them for 10^11 rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from pactmill import session

CELLS = 4096
HEX_DIGITS = 3  # 16**3 == CELLS
ROWS_PER_BUCKET = 1_000_000


def digest(*parts: Column) -> Column:
    """md5 over the parts joined by ``|``: a repeatable random order."""
    return F.md5(F.concat_ws("|", *[part.cast("string") for part in parts]))


def _cell_holding(cells, wanted: int):
    """The cell (value, n) in which the running count reaches ``wanted``, and the rows still wanted inside it."""
    for value, n in sorted(cells):
        if wanted <= n:
            return value, n, wanted
        wanted -= n
    raise ValueError("fewer rows than the wanted position")


def hex_cut(df: DataFrame, hashed: Column, k: int) -> str | None:
    """Shortest prefix P such that exactly ``k`` rows have ``hashed[:len(P)] <= P``."""
    if k <= 0:
        return None
    rows, prefix = df.select(hashed.alias("h")), ""
    while len(prefix) < 32:
        here = rows.where(F.startswith("h", F.lit(prefix))) if prefix else rows
        cell = F.substring("h", len(prefix) + 1, min(HEX_DIGITS, 32 - len(prefix))).alias("cell")
        cells = [tuple(r) for r in here.groupBy(cell).count().collect()]
        value, n, k = _cell_holding(cells, k)
        prefix += value
        if n == k:
            return prefix
    raise ValueError("the key is not unique, so the split has no exact size")


def key_cut(df: DataFrame, key: str, k: int) -> int | None:
    """Largest key value among the first ``k`` rows by an integer key (or a value with the same effect)."""
    if k <= 0:
        return None
    low, high = map(int, df.agg(F.min(key), F.max(key)).first())
    kind = df.schema[key].dataType
    while True:
        width = (high - low) // CELLS + 1
        # the plain column is compared, so that a scan can skip what lies outside
        inside = F.col(key).between(F.lit(Decimal(low)).cast(kind), F.lit(Decimal(high)).cast(kind))
        cell = F.expr(f"cast(cast(`{key}` as decimal(20,0)) - {low} as decimal(20,0)) div {width}").alias("cell")
        cells = [tuple(r) for r in df.where(inside).groupBy(cell).count().collect()]
        value, n, k = _cell_holding(cells, k)
        low, high = low + value * width, min(high, low + (value + 1) * width - 1)
        if n == k:
            return high
        if width == 1:
            raise ValueError(f"{key} is not unique, so the split has no exact size")


def hex_digits(rows: int) -> int:
    """Hash digits that name about one bucket per ``ROWS_PER_BUCKET`` rows, at least ``HEX_DIGITS``."""
    digits = HEX_DIGITS
    while 16**digits * ROWS_PER_BUCKET < rows:
        digits += 1
    return digits


def bucket_offsets(df: DataFrame, bucket: str, weight: Column, within: list[str] | None = None) -> DataFrame:
    """Sum of ``weight`` before each bucket, one row per bucket (of each ``within`` group)."""
    within = within or []
    totals = df.groupBy(*within, bucket).agg(F.sum(weight).alias("_total"))
    before = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*within, bucket, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))


def running_starts(df: DataFrame, key: str, weight: Column, out: str) -> tuple[DataFrame, int]:
    """For every key the sum of ``weight`` over all rows with a smaller key, exactly; and the number of rows.

    Only (key, weight) moves. A null key is refused at once, a repeated one when the rows are read: equal keys fall into
    the same range, next to each other.
    """
    n, n_key = df.agg(F.count(F.lit(1)), F.count(key)).first()
    if n != n_key:
        raise ValueError(f"{key} must not be null")
    parts = max(-(-n // ROWS_PER_BUCKET), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.select(key, weight.cast("bigint").alias("_weight")).repartitionByRange(parts, key)
    rows = session.stored(ranged.withColumn("_bucket", F.spark_partition_id()), "key-ranges")
    offsets = bucket_offsets(rows, "_bucket", F.col("_weight"))
    inside = Window.partitionBy("_bucket").orderBy(key)
    start = F.coalesce(F.sum("_weight").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    repeated = F.raise_error(F.lit(f"{key} is not unique, so rows have no place")).cast("bigint")
    # offsets: one row per bucket
    starts = rows.join(F.broadcast(offsets), "_bucket").select(
        key, F.when(F.lag(key).over(inside) == F.col(key), repeated).otherwise(F.col("_offset") + start).alias(out)
    )
    return starts, n


def with_running_start(df: DataFrame, key: str, weight: Column, out: str) -> DataFrame:
    """Add the sum of ``weight`` over all rows with a smaller key."""
    return df.join(running_starts(df, key, weight, out)[0], key)


def with_position(df: DataFrame, key: str, out: str, total: str | None = None) -> DataFrame:
    """Add the 1-based global position by a unique key, and the number of rows if ``total`` names a column for it."""
    starts, n = running_starts(df, key, F.lit(1), out)
    placed = df.join(starts.withColumn(out, F.col(out) + 1), key)
    return placed.withColumn(total, F.lit(n).cast("bigint")) if total else placed
