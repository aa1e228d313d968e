"""Block quantization of a numeric array column into packed bytes: per block a scale and its codes side by side.

Packing and reading work on whole Arrow batches: NumPy sees the flat values of all vectors of a batch and where each vector and
block begins, so nothing is done per element or per vector.

Layout: blocks of a vector follow each other, the last may be shorter. A block is its scale (a little-endian float of ``scale_bits``) and its
codes: a byte each for 8-bit codes, two codes a byte for 4-bit ones, the first in the low half. If the last byte of a
vector holds a single 4-bit code, the sign bit of its last scale is set; scales themselves are never negative.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from pactmill import fixed_values as fv

NF4_MIDPOINTS = tuple((a + b) / 2 for a, b in zip(fv.NF4_LEVELS, fv.NF4_LEVELS[1:]))
EXACT = 64  # bits of a scale that is kept as it was computed

_LEVELS, _MIDPOINTS = np.array(fv.NF4_LEVELS), np.array(NF4_MIDPOINTS)


@dataclass(frozen=True)
class Rule:
    """How a block becomes codes: whole steps from -top to top, or the nearest of the NF4 levels (``top`` 1, codes 0..15)."""

    code_bits: int
    block: int
    top: int
    levels: bool = False


Q8, Q4, NF4 = Rule(8, 32, 127), Rule(4, 32, 7), Rule(4, 64, 1, levels=True)


def rounded(x: np.ndarray) -> np.ndarray:
    """To the nearest whole number, halves away from zero."""
    whole = np.trunc(x)
    return whole + np.sign(x) * (np.abs(x - whole) >= 0.5)


class Vectors:
    """The usable vectors of an Arrow list column, flat: there, and all elements finite numbers."""

    def __init__(self, column: pa.Array) -> None:
        lengths = column.value_lengths().fill_null(0).to_numpy()
        # what lies under a null vector is not part of the flat values
        values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        fine = np.isfinite(values)
        usable = column.is_valid().to_numpy(zero_copy_only=False)
        if not fine.all():
            usable &= np.bincount(np.repeat(np.arange(len(lengths)), lengths)[~fine], minlength=len(lengths)) == 0
            values = values[np.repeat(usable, lengths)]
        self.usable = usable
        self.lengths = np.where(usable, lengths, 0).astype(np.int64)
        self.values = values


class Cuts:
    """Where the blocks of flat vectors begin, how long they are, and to which vector they belong."""

    def __init__(self, lengths: np.ndarray, width: int) -> None:
        self.per_vector = -(-lengths // width)
        self.owner = np.repeat(np.arange(len(lengths)), self.per_vector)
        first = np.cumsum(self.per_vector) - self.per_vector
        self.number = np.arange(len(self.owner)) - first[self.owner]
        begins = np.cumsum(lengths) - lengths
        self.starts = begins[self.owner] + self.number * width
        self.sizes = np.minimum(width, lengths[self.owner] - self.number * width)


def block_maxima(values: np.ndarray, cuts: Cuts) -> np.ndarray:
    return np.maximum.reduceat(np.abs(values), cuts.starts) if len(cuts.starts) else np.zeros(0)


def codes_of(values: np.ndarray, scales: np.ndarray, cuts: Cuts, rule: Rule) -> np.ndarray:
    """The code of every value. A block of zeros has ratios of zero."""
    own = np.repeat(scales, cuts.sizes)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratios = np.where(own == 0, 0.0, values / own)
    if rule.levels:
        return np.searchsorted(_MIDPOINTS, ratios, "left").astype(np.int8)
    return np.clip(rounded(ratios), -rule.top, rule.top).astype(np.int8)


def restored_from(codes: np.ndarray, scales: np.ndarray, sizes: np.ndarray, rule: Rule) -> np.ndarray:
    return (_LEVELS[codes] if rule.levels else codes) * np.repeat(scales, sizes)


def pack_vectors(vectors: Vectors, rule: Rule, scale_bits: int) -> pa.Array:
    """Packed bytes of each vector; null where it is not usable, or where a scale does not fit ``scale_bits``."""
    cuts = Cuts(vectors.lengths, rule.block)
    kind = np.dtype(f"<f{scale_bits // 8}")
    with np.errstate(over="ignore"):
        scales = (block_maxima(vectors.values, cuts) / rule.top).astype(kind)
    codes = codes_of(vectors.values, scales.astype(np.float64), cuts, rule)
    usable = vectors.usable.copy()
    usable[cuts.owner[~np.isfinite(scales)]] = False
    code_bytes = cuts.sizes if rule.code_bits == 8 else (cuts.sizes + 1) >> 1
    block_bytes = kind.itemsize + code_bytes
    at = np.cumsum(block_bytes) - block_bytes
    out = np.zeros(int(block_bytes.sum()), np.uint8)
    if rule.code_bits == 4:
        scales = np.where(cuts.sizes & 1 == 1, -scales, scales)
    out[at[:, None] + np.arange(kind.itemsize)] = np.ascontiguousarray(scales, kind).view(np.uint8).reshape(-1, kind.itemsize)
    place = np.arange(len(codes)) - np.repeat(cuts.starts, cuts.sizes)
    base = np.repeat(at + kind.itemsize, cuts.sizes)
    if rule.code_bits == 8:
        out[base + place] = codes.view(np.uint8)
    else:
        # steps are kept as 1..15, levels as 0..15
        nibbles = (codes if rule.levels else codes + 8).astype(np.uint8)
        low, high = place & 1 == 0, place & 1 == 1
        out[base[low] + (place[low] >> 1)] = nibbles[low]
        out[base[high] + (place[high] >> 1)] |= nibbles[high] << 4
    lengths = np.bincount(cuts.owner, block_bytes, len(vectors.lengths)).astype(np.int64) if len(cuts.owner) else np.zeros(len(vectors.lengths), np.int64)
    offsets = np.append(0, np.cumsum(lengths))
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
    return pc.if_else(pa.array(usable), packed, None).cast(pa.binary())


@dataclass
class Unpacked:
    """Flat codes and scales of packed vectors, values and blocks of each vector, and values of each block."""

    codes: np.ndarray
    scales: np.ndarray
    lengths: np.ndarray
    per_vector: np.ndarray
    sizes: np.ndarray
    valid: np.ndarray


def unpack_vectors(column: pa.Array, rule: Rule, scale_bits: int) -> Unpacked:
    column = column.cast(pa.large_binary())
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    held = np.where(valid, np.diff(offsets), 0)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    kind = np.dtype(f"<f{scale_bits // 8}")
    full = kind.itemsize + rule.block * rule.code_bits // 8
    cuts = Cuts(held, full)
    at = offsets[:-1][cuts.owner] + cuts.number * full
    scales = data[at[:, None] + np.arange(kind.itemsize)].copy().view(kind).ravel().astype(np.float64)
    sizes = cuts.sizes - kind.itemsize
    if rule.code_bits == 4:
        sizes = 2 * sizes - np.signbit(scales)
        scales = np.abs(scales)
    lengths = np.bincount(cuts.owner, sizes, len(held)).astype(np.int64) if len(cuts.owner) else np.zeros(len(held), np.int64)
    begins = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(begins, sizes)
    base = np.repeat(at + kind.itemsize, sizes)
    if rule.code_bits == 8:
        codes = data[base + place].view(np.int8)
    else:
        both = data[base + (place >> 1)]
        codes = np.where(place & 1 == 0, both & 15, both >> 4).astype(np.int8)
        codes = codes if rule.levels else codes - np.int8(8)
    return Unpacked(codes, scales, lengths, cuts.per_vector, sizes, valid)


def _lists(values: pa.Array, lengths: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    mask = None if valid is None or valid.all() else pa.array(~valid)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)


def packed(vector: Column, rule: Rule, scale_bits: int = EXACT) -> Column:
    """A vector column as packed bytes. Null for a null vector, one with a null, NaN or infinite element, or with a scale beyond
    ``scale_bits``; an empty vector has no bytes."""

    @F.arrow_udf("binary")
    def pack(column: pa.Array) -> pa.Array:
        return pack_vectors(Vectors(column), rule, scale_bits)

    return pack(vector)


def restored(column: Column, rule: Rule, scale_bits: int = EXACT) -> Column:
    """Packed bytes as an array of doubles."""

    @F.arrow_udf("array<double>")
    def restore(bytes_: pa.Array) -> pa.Array:
        own = unpack_vectors(bytes_, rule, scale_bits)
        return _lists(pa.array(restored_from(own.codes, own.scales, own.sizes, rule)), own.lengths, own.valid)

    return restore(column)


def codes(column: Column, rule: Rule, scale_bits: int = EXACT) -> Column:
    """All codes of packed bytes in order."""

    @F.arrow_udf("array<tinyint>")
    def read(bytes_: pa.Array) -> pa.Array:
        own = unpack_vectors(bytes_, rule, scale_bits)
        return _lists(pa.array(own.codes), own.lengths, own.valid)

    return read(column)


def scales_and_codes(column: Column, rule: Rule, scale_bits: int = EXACT) -> Column:
    """Packed bytes as an array of blocks: scale and codes."""

    @F.arrow_udf("array<struct<scale: double, codes: array<tinyint>>>")
    def read(bytes_: pa.Array) -> pa.Array:
        own = unpack_vectors(bytes_, rule, scale_bits)
        blocks = pa.StructArray.from_arrays([pa.array(own.scales), _lists(pa.array(own.codes), own.sizes)], ["scale", "codes"])
        return _lists(blocks, own.per_vector, own.valid)

    return read(column)


def largest_error(vector: Column, column: Column, rule: Rule, scale_bits: int = EXACT) -> Column:
    """The largest difference between a vector's values and its packed form; null for an empty vector or one that was not packed."""

    @F.arrow_udf("double")
    def worst(values: pa.Array, bytes_: pa.Array) -> pa.Array:
        given, own = Vectors(pc.if_else(bytes_.is_valid(), values, None)), unpack_vectors(bytes_, rule, scale_bits)
        apart = np.abs(given.values - restored_from(own.codes, own.scales, own.sizes, rule))
        some = own.lengths > 0
        out = np.zeros(len(own.lengths))
        begins = (np.cumsum(own.lengths) - own.lengths)[some]
        if len(begins):
            out[some] = np.maximum.reduceat(apart, begins)
        return pa.array(out, mask=~some)

    return worst(vector, column)


def blocks(vector: Column, width: int) -> Column:
    """The array cut into blocks of ``width`` doubles; the last block may be shorter, an empty array has none."""
    starts = F.sequence(F.lit(0), F.floor((F.size(vector) - 1) / width).cast("int"))
    cut = F.transform(starts, lambda b: F.slice(vector, b * width + 1, width).cast("array<double>"))
    return F.when(F.size(vector) > 0, cut).otherwise(F.array().cast("array<array<double>>"))


def largest(block: Column) -> Column:
    return F.array_max(F.transform(block, F.abs))
