"""Words, word hashes and shingle hashes of whole Arrow text columns, computed with numpy on the column's bytes.

A word is a run of bytes other than blank and the controls 9 to 13; A-Z count as a-z. Both only concern single bytes of
UTF-8, so nothing is decoded. All hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT_BYTES = 1 << 16  # bytes hashed at once, so that the arrays stay in the cache
LONGEST_AT_ONCE = 1 << 20

_PRIME = 0x9E3779B97F4A7C15
_INVERSE = pow(_PRIME, -1, 1 << 64)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits of the input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWERED = np.arange(256)
_LOWERED[65:91] += 32
_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_PRIME))[_LOWERED]


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)


_UP, _DOWN = _powers(_PRIME, SEGMENT_BYTES), _powers(_INVERSE, SEGMENT_BYTES)


def texts_as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each text starts and the last one ends. Null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def _segments(at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SEGMENT_BYTES`` together, at least one text each."""
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + SEGMENT_BYTES, "right")) - 1)
        yield first, last
        first = last


def _word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end. ``at``: the starts of the texts and the end of the last; no word crosses them."""
    inside = ~_SEPARATOR[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = at[:-1] < at[1:]
    first, last = at[:-1][full], at[1:][full] - 1
    begins[first], ends[last] = inside[first], inside[last]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def count_words(column: pa.Array) -> np.ndarray:
    """Words of every text."""
    data, at = texts_as_bytes(column)
    counts = np.zeros(len(at) - 1, np.int64)
    for first, last in _segments(at):
        own = at[first:last + 1] - at[first]
        for begin in range(0, max(1, int(own[-1])), LONGEST_AT_ONCE):  # only a single long text takes several turns
            end = min(begin + LONGEST_AT_ONCE, int(own[-1])) if last == first + 1 else int(own[-1])
            part = data[at[first] + begin:at[first] + end]
            inside = ~_SEPARATOR[part]
            starts = inside.copy()
            starts[1:] &= ~inside[:-1]
            if last > first + 1:
                heads = own[:-1][own[:-1] < own[1:]]
                starts[heads] = inside[heads]
                counts[first:last] = np.diff(np.searchsorted(np.flatnonzero(starts), own))
                break
            if begin and len(starts):
                starts[0] = inside[0] and bool(_SEPARATOR[data[at[first] + begin - 1]])
            counts[first] += int(starts.sum())
    return counts


def _hashed(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and the places of the words.

    Running sums of byte codes times powers of an odd number: a word's sum is divided by the power it started with, so
    that the place of the word does not matter.
    """
    up, down = (_UP, _DOWN) if len(data) <= SEGMENT_BYTES else (_powers(_PRIME, len(data)), _powers(_INVERSE, len(data)))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[:len(data)], out=sums[1:])
    starts, ends = _word_bounds(data, at)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _long_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text of any length, in pieces that end behind a separator, so that no word is cut."""
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT_BYTES)
        while end < len(data):
            cut = np.flatnonzero(_SEPARATOR[data[max(at, end - SEGMENT_BYTES):end]])
            if len(cut):
                end = max(at, end - SEGMENT_BYTES) + int(cut[-1]) + 1
                break
            end = min(len(data), end + SEGMENT_BYTES)
        found.append(_hashed(data[at:end], np.array([0, end - at]))[0])
        at = end
    return np.concatenate(found)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, sorted and distinct. Fewer words than that count as one run."""
    if not len(words):
        return words
    span = min(width, len(words))
    n = len(words) - span + 1
    runs = np.full(n, span, np.uint64)
    for k in range(span):
        runs = runs * np.uint64(_PRIME) + words[k:k + n]
    runs = np.sort(mix(runs))
    keep = np.ones(n, bool)
    keep[1:] = runs[1:] != runs[:-1]
    return runs[keep]


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The shingle set of every text in turn."""
    data, at = texts_as_bytes(column)
    for first, last in _segments(at):
        part = data[at[first]:at[last]]
        if len(part) > SEGMENT_BYTES:
            yield shingles(_long_text(part), width)
            continue
        own = at[first:last + 1] - at[first]
        words, starts = _hashed(part, own)
        bounds = np.searchsorted(starts, own).tolist()
        for begin, end in zip(bounds, bounds[1:]):
            yield shingles(words[begin:end], width)
