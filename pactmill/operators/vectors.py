"""Quantization of an embedding column, nested quantization of the scales, and size / error reports.

``pack`` stores vectors at the size of their format (scales of 16 bits for the 8- and 4-bit formats, of 32 bits for NF4). ``quantize`` and the
reports compute with scales kept as doubles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pactmill import session
from pactmill.functions import blocks as bl
from pactmill.operators import ordering

GROUP = 256
GROUPS_TOGETHER = 32  # groups of scales that are measured in one call


@dataclass(frozen=True)
class Format:
    name: str
    rule: bl.Rule
    scale_bits: int

    @property
    def bits(self) -> float:
        return self.rule.code_bits + self.scale_bits / self.rule.block


FORMATS = {f.name: f for f in (Format("q8_0", bl.Q8, 16), Format("q4_0", bl.Q4, 16), Format("nf4", bl.NF4, 32))}
# NF4 whose 32-bit scales are stored in 8 bits plus one 32-bit scale and one 32-bit mean per 256 of them
NESTED = "nf4_nested"
NESTED_BITS = 4 + (8 + 64 / GROUP) / 64


def usable(vector: str) -> Column:
    """Whether a vector can be quantized: it is there, and all its elements are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def pack(df: DataFrame, name: str, vector: str = "embedding", into: str = "packed", scale_bits: int | None = None) -> DataFrame:
    """Add the vector as packed bytes, at the size of its format unless ``scale_bits`` names another width of the scales. NULL for a vector with a
    NULL, NaN or infinite element, or with a scale too large for the width."""
    fmt = FORMATS[name]
    return df.withColumn(into, bl.packed(F.col(vector), fmt.rule, scale_bits or fmt.scale_bits))


def unpack(df: DataFrame, name: str, column: str = "packed", into: str = "restored", scale_bits: int | None = None) -> DataFrame:
    """Add the values that packed bytes stand for."""
    fmt = FORMATS[name]
    return df.withColumn(into, bl.restored(F.col(column), fmt.rule, scale_bits or fmt.scale_bits))


def quantize(df: DataFrame, name: str, vector: str = "embedding") -> DataFrame:
    """Add ``quantized`` (array of scale and codes per block) and ``restored``, with scales as doubles. Both are NULL for a vector with a NULL, NaN
    or infinite element."""
    rule, packed = FORMATS[name].rule, "_packed"
    rows = pack(df, name, vector, packed, bl.EXACT)
    return rows.select(
        *df.columns, bl.scales_and_codes(F.col(packed), rule).alias("quantized"), bl.restored(F.col(packed), rule).alias("restored")
    )


def nested_scales(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """8-bit codes for the NF4 scales: groups of 256 consecutive scales by (key, block), centred on the group mean.

    A vector's first scale position is a running sum of block counts over narrow rows. The mean and the largest
    deviation of a group are windows over its 256 rows, so a single shuffle by group serves both. The mean is taken
    from ten-digit decimals and does not depend on row order.
    """
    n_blocks = F.ceil(F.greatest(F.size(vector), F.lit(0)) / 64)
    counted = session.stored(df.where(usable(vector)).select(key, n_blocks.alias("_n_blocks")), "block-counts")
    starts = ordering.with_running_start(counted, key, F.col("_n_blocks"), "_start").drop("_n_blocks")
    scales = (
        df.where(n_blocks > 0)
        .where(usable(vector))
        .select(key, F.transform(bl.blocks(F.col(vector), 64), bl.largest).alias("s"))
        .join(starts, key)
        .select(key, "_start", F.posexplode("s").alias("block", "scale"))
        .withColumn("grp", F.expr(f"(_start + block) div {GROUP}"))
    )
    group = Window.partitionBy("grp")
    centred = scales.withColumn(
        "mean",
        F.sum(F.round("scale", 10).cast("decimal(20,10)")).over(group).cast("double") / F.count(F.lit(1)).over(group),
    ).withColumn("dev", F.col("scale") - F.col("mean"))
    step = F.max(F.abs("dev")).over(group) / F.lit(127.0)
    coded = centred.withColumn("step", step).withColumn(
        "code", F.when(F.col("step") == 0, F.lit(0)).otherwise(F.round(F.col("dev") / F.col("step"))).cast("int")
    )
    return coded.select(
        key, F.col("block").cast("bigint").alias("block"), "grp", "scale", "mean", "step", "code",
        (F.col("mean") + F.col("code") * F.col("step")).alias("restored_scale"),
    )


def _errors(values: np.ndarray, scales: np.ndarray, cuts: bl.Cuts, rule: bl.Rule, stored: np.ndarray | None = None) -> tuple[float, float]:
    """Sum of squares and largest magnitude of what is lost; codes are read with the ``stored`` scales if these are others."""
    codes = bl.codes_of(values, scales, cuts, rule)
    lost = values - bl.restored_from(codes, scales if stored is None else stored, cuts.sizes, rule)
    return float(lost @ lost), float(np.abs(lost).max(initial=0.0))


def _plain_errors(lengths: np.ndarray, values: np.ndarray) -> Iterator[tuple[str, int, float, float]]:
    for fmt in FORMATS.values():
        cuts = bl.Cuts(lengths, fmt.rule.block)
        yield fmt.name, len(values), *_errors(values, bl.block_maxima(values, cuts) / fmt.rule.top, cuts, fmt.rule)


_PARTIAL = "format string, n bigint, sq double, worst double"


def _partial(rows: list[tuple[str, int, float, float]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = (pa.string(), pa.int64(), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["format", "n", "sq", "worst"])


def _lines(partial: DataFrame, bits: dict[str, float]) -> DataFrame:
    """Report lines from partial sums, a line for every format also where there are no vectors."""
    own = lambda name, column: F.when(F.col("format") == name, F.col(column))
    folds = [f(own(name, c)).alias(f"{c}_{name}") for name in bits for f, c in ((F.sum, "n"), (F.sum, "sq"), (F.max, "worst"))]
    lines = [
        F.struct(
            F.lit(name).alias("format"), F.lit(float(b)).alias("bits_per_value"),
            *(F.col(f"{c}_{name}").alias(c) for c in ("n", "sq", "worst")),
        )
        for name, b in bits.items()
    ]
    return partial.agg(*folds).select(F.inline(F.array(*lines))).select(
        "format", "bits_per_value", F.col("n").alias("n_values"), F.ceil(F.col("n") * F.col("bits_per_value") / 8).alias("bytes"),
        F.round(F.sqrt(F.try_divide(F.col("sq"), F.col("n"))), 8).alias("rmse"), F.round("worst", 8).alias("max_abs_err"),
    )


def report(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Bits per value, bytes, RMSE and largest error per format, all formats in one pass over the vectors. Vectors that cannot
    be quantized do not count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = bl.Vectors(batch.column(0))
            yield _partial(list(_plain_errors(own.lengths, own.values)))

    return _lines(df.select(vector).mapInArrow(run, _PARTIAL), {f.name: f.bits for f in FORMATS.values()})


def _nested_restored(scales: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Scales as they come back from their 8-bit codes; ``group`` numbers the groups, each in a row."""
    begins = np.flatnonzero(np.diff(group, prepend=group[0] - 1)) if len(group) else np.zeros(0, np.int64)
    counts = np.diff(begins, append=len(group))
    # means come from ten-digit decimals, summed exactly
    whole = bl.rounded(scales * 1e10).tolist()
    means = [sum(map(int, whole[b:b + n])) / 10**10 / n for b, n in zip(begins.tolist(), counts.tolist())]
    mean = np.repeat(np.array(means), counts)
    apart = scales - mean
    step = np.repeat(np.maximum.reduceat(np.abs(apart), begins) / 127.0, counts) if len(begins) else apart
    with np.errstate(divide="ignore", invalid="ignore"):
        codes = np.where(step == 0, 0.0, bl.rounded(apart / step))
    return mean + codes * step


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = bl.Vectors(batch.column(1))
        n = pa.array(-(-own.lengths // bl.NF4.block))
        yield pa.RecordBatch.from_arrays([batch.column(0), n], ["key", "n"]).filter(pa.array(own.usable))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors cut where a group of scales ends: part, first position, values."""
    for batch in batches:
        own, starts = bl.Vectors(batch.column(1)), batch.column(0).to_numpy()
        kind = batch.column(1).type.value_type
        cuts = bl.Cuts(own.lengths, bl.NF4.block)
        position = starts[cuts.owner] + cuts.number
        first = np.flatnonzero((cuts.number == 0) | (position % GROUP == 0))
        at = cuts.starts[first]
        offsets = pa.array(np.append(at, len(own.values)).astype(np.int32))
        values = pa.ListArray.from_arrays(offsets, pa.array(own.values).cast(kind))
        yield pa.RecordBatch.from_arrays(
            [pa.array(position[first] // (GROUP * GROUPS_TOGETHER)), pa.array(position[first]), values], ["part", "position", "values"]
        )


def _measured(all_formats: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("position").combine_chunks()
        column = table.column("values").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        lengths = column.value_lengths().to_numpy().astype(np.int64)
        values = column.flatten().cast(pa.float64()).to_numpy()
        cuts = bl.Cuts(lengths, bl.NF4.block)
        scales = bl.block_maxima(values, cuts)
        position = table.column("position").to_numpy()[cuts.owner] + cuts.number
        rows = list(_plain_errors(lengths, values)) if all_formats else []
        rows.append((NESTED, len(values), *_errors(values, scales, cuts, bl.NF4, _nested_restored(scales, position // GROUP))))
        return pa.Table.from_batches([_partial(rows)])

    return run


def full_report(df: DataFrame, key: str = "vec_id", vector: str = "embedding", all_formats: bool = True) -> DataFrame:
    """The report lines of all formats and of NF4 with nested scales, from one reading of the values.

    A vector's first scale position is a running sum of block counts over narrow rows. Vectors, cut where a group of 256 scales
    ends, go to the groups; there the codes of all formats, the nested scales and what is lost are computed at once, and only sums leave.
    """
    kind = df.schema[key].dataType.simpleString()
    counted = session.stored(df.select(key, vector).mapInArrow(_counted, f"{key} {kind}, _n_blocks bigint"), "block-counts")
    starts = ordering.running_starts(counted, key, F.col("_n_blocks"), "_start")[0]
    values = df.schema[vector].dataType.simpleString()
    pieces = df.select(key, vector).join(starts, key).select("_start", vector).mapInArrow(_pieces, f"part bigint, position bigint, values {values}")
    bits = {f.name: f.bits for f in FORMATS.values()} if all_formats else {}
    return _lines(pieces.groupBy("part").applyInArrow(_measured(all_formats), _PARTIAL), bits | {NESTED: NESTED_BITS})


def nested_report(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The report line of NF4 with nested scales."""
    return full_report(df, key, vector, all_formats=False)


def within_budget(reports: DataFrame, budget_bytes: Column) -> DataFrame:
    """The format with the most bits per value whose size fits the budget, the smaller RMSE first on ties.

    NULL when none fits.
    """
    precision = F.struct("bits_per_value", -F.col("rmse"), "format")
    return reports.where(F.col("bytes") <= budget_bytes).agg(
        F.max_by("format", precision).alias("format"), F.max("bits_per_value").alias("bits_per_value")
    )
