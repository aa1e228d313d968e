"""Byte-level BPE with a segment tree over byte positions.

A leaf holds the rank of the pair that its token forms with the next live token; inner nodes hold the smallest rank below.
The leftmost smallest rank sits at the root's path. A merge changes two leaves, that of the merged token and that of its left neighbour, and
clears one, each with a logarithmic walk to the root. Short pieces are merged many at a time: their trees are rows of one
array, and every walk is one numpy step per tree level for all of them.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

LONGEST_TOGETHER = 32  # bytes of a piece that is merged along with others; longer ones have a tree of their own
PIECES_TOGETHER = 4096
CHARACTERS_TOGETHER = 2_000_000
CACHED_RUNS = 200_000  # encoded runs a worker remembers; beyond that, or beyond this many characters, it starts anew
CACHED_CHARACTERS = 4_000_000

# White space and what follows up to the next white space. No piece of the usual patterns reaches from a character that is
# not white space into one that is, so runs can be encoded, and remembered, one by one.
# The controls 28 to 31 are white space for one of the two regular-expression libraries only; here they are not.
RUNS = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
_ACROSS = re.compile(r"[\S\x1c-\x1f][^\S\x1c-\x1f]")

_NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Merger:
    """Merges the bytes of a piece by rank."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # every way to put a token together from two others; ids fit 32 bits
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        bits = max(4, (2 * len(pairs)).bit_length())
        self._shift = np.uint64(64 - bits)
        self._mask = (1 << bits) - 1
        self._keys, self._values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32)
        keys, values = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32)
        at = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):  # all keys probe on together; the first of those at a free slot takes it
            free = left[self._keys[at[left]] < 0]
            taken, first = np.unique(at[free], return_index=True)
            self._keys[taken], self._values[taken] = keys[free[first]], values[free[first]]
            left = left[self._keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token made of two; a rank is also the id of the token."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slot(keys)
        found = self._values[at].copy()
        held = self._keys[at]
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        found[held != keys] = _NONE
        while len(open_):
            at[open_] = (at[open_] + 1) & self._mask
            held = self._keys[at[open_]]
            hit = held == keys[open_]
            found[open_[hit]] = self._values[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return found

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of every piece."""
        out: list[list[int] | None] = [None] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            known = self.ranks.get(piece)
            if known is not None:
                out[i] = [known]
            elif len(piece) > LONGEST_TOGETHER:
                out[i] = self._alone(piece)
            else:
                by_width.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, members in by_width.items():
            for k in range(0, len(members), PIECES_TOGETHER):
                part = members[k:k + PIECES_TOGETHER]
                for i, ids in zip(part, self._together([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def _together(self, pieces: list[bytes], width: int) -> list[list[int]]:
        """Pieces of up to ``width`` bytes, ``width`` a power of two. All arrays are flat: a piece's tokens stand at
        ``width`` times its number, its tree at twice that."""
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        data = np.frombuffer(b"".join([piece.ljust(width, b"\0") for piece in pieces]), np.uint8)
        place = np.tile(np.arange(width), n)
        ends = np.repeat(sizes, width)
        ids = np.where(place < ends, self.single[data], -1)
        following, previous = place + 1, place - 1
        tree = np.full((n, 2 * width), _NONE, np.int32)
        pairs = np.flatnonzero(following < ends)
        leaves = np.full(n * width, _NONE, np.int32)
        leaves[pairs] = self._rank(ids[pairs], ids[pairs + 1])
        tree[:, width:] = leaves.reshape(n, width)
        level = width
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        tree = tree.ravel()
        levels = width.bit_length() - 1
        rows = np.arange(n)
        while True:
            rows = rows[tree[rows * (2 * width) + 1] != _NONE]
            if not len(rows):
                break
            base, tokens = rows * (2 * width), rows * width
            best, node = tree[base + 1], np.ones(len(rows), np.int64)
            for _ in range(levels):  # down to the leftmost leaf of the smallest rank
                node += node
                node += tree[base + node] != best
            here = node - width
            gone = following[tokens + here]
            after = following[tokens + gone]
            ids[tokens + here], ids[tokens + gone] = best, -1
            following[tokens + here] = after
            before = previous[tokens + here]
            more, has = np.flatnonzero(after < sizes[rows]), np.flatnonzero(before >= 0)
            previous[(tokens + after)[more]] = here[more]
            ranks = self._rank(
                np.concatenate([best[more], ids[(tokens + before)[has]]]),
                np.concatenate([ids[(tokens + after)[more]], best[has].astype(np.int64)]),
            )
            # three leaves change: none any more, the merged token's and its left neighbour's
            leaf = base + width
            tree[leaf + gone] = tree[leaf + here] = _NONE
            tree[(leaf + here)[more]], tree[(leaf + before)[has]] = ranks[:len(more)], ranks[len(more):]
            base3, node = np.concatenate([base, base, base[has]]), np.concatenate([gone, here, before[has]]) + width
            for _ in range(levels):
                node >>= 1
                child = base3 + node + node
                tree[base3 + node] = np.minimum(tree[child], tree[child + 1])
        live = ids >= 0
        upto = np.cumsum(live.reshape(n, width).sum(axis=1)).tolist()
        flat = ids[live].tolist()
        return [flat[a:b] for a, b in zip([0, *upto], upto)]

    def _alone(self, piece: bytes) -> list[int]:
        """One piece of any length with a tree of its own."""
        n, none, pair = len(piece), int(_NONE), self.pairs.get
        width = 1 << (n - 1).bit_length()
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * width)
        for i in range(n - 1):
            tree[width + i] = pair(ids[i] << 32 | ids[i + 1], none)
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(leaf: int, rank: int) -> None:
            node = width + leaf
            tree[node] = rank
            while node > 1:
                node >>= 1
                left, right = tree[2 * node], tree[2 * node + 1]
                tree[node] = left if left <= right else right

        while (best := tree[1]) != none:
            node = 1
            while node < width:
                node = 2 * node if tree[2 * node] == best else 2 * node + 1
            here = node - width
            gone = following[here]
            after = following[here] = following[gone]
            ids[here], ids[gone] = best, -1
            put(gone, none)
            put(here, pair(best << 32 | ids[after], none) if after < n else none)
            if after < n:
                previous[after] = here
            if previous[here] >= 0:
                put(previous[here], pair(ids[previous[here]] << 32 | best, none))
        return [i for i in ids if i >= 0]


def keeps_to_runs(pieces: regex.Pattern) -> bool:
    """Whether no piece reaches from a character that is not white space into one that is, tried on characters of every kind. Texts of a pattern
    that fails are encoded whole."""
    solid, blank = "aZ1!\u00e9\u65e5\U0001f600'_-.\u0301$", " \n\r\t\u00a0\u2003\x85"
    probes = (f"{lead}{one}{other}{b}x{c}{b}{one}{b}" for one in solid for other in solid for b in blank for c in blank for lead in ("", " ", "\n"))
    return not any(_ACROSS.search(match[0]) for probe in probes for match in pieces.finditer(probe))


class Codec:
    """Texts to token ids and back."""

    def __init__(self, path: str, pattern: str) -> None:
        self.merger = Merger(read_ranks(path))
        self.pieces = regex.compile(pattern)
        self.by_run = keeps_to_runs(self.pieces)
        self.packed: dict[str, bytes] = {}  # ids of a run, four bytes each, lowest byte first
        self.characters = 0  # of those runs
        tokens = self.merger.tokens
        self.token_bytes = [tokens.get(i, b"") for i in range(max(tokens) + 1)]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of every text, four bytes each, lowest byte first. New runs are encoded together, those of
        about ``CHARACTERS_TOGETHER`` characters of text at a time."""
        begin = 0
        while begin < len(texts):
            end, characters = begin, 0
            while end < len(texts) and (end == begin or characters + len(texts[end]) <= CHARACTERS_TOGETHER):
                characters += len(texts[end])
                end += 1
            split = [RUNS.findall(text) if self.by_run else [text] for text in texts[begin:end]]
            self._learn(set().union(*split))
            for runs in split:
                yield b"".join(map(self.packed.__getitem__, runs))
            begin = end

    def _learn(self, runs: set[str]) -> None:
        missing = [run for run in runs if run not in self.packed]
        characters = sum(map(len, missing))
        if len(self.packed) + len(missing) > CACHED_RUNS or self.characters + characters > CACHED_CHARACTERS:
            self.packed.clear()
            missing = list(runs)
            self.characters, characters = 0, sum(map(len, missing))
        self.characters += characters
        split = [self.pieces.findall(run) for run in missing]
        pieces = list(set().union(*split))
        ids = dict(zip(pieces, self.merger.encode([piece.encode() for piece in pieces])))
        for run, parts in zip(missing, split):
            own = ids[parts[0]] if len(parts) == 1 else [i for part in parts for i in ids[part]]
            self.packed[run] = struct.pack(f"<{len(own)}I", *own)

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(packed, "<u4").tolist()))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of this process, which keeps its pieces from task to task."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def coded(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids again: key, n_tokens, ids, decoded.

    ``path`` names a file of ranks that every executor can read. ``ids`` holds four bytes per token, lowest byte first; ``decoded`` holds
    bytes. Null counts as empty, which has no tokens. Rows are independent: repeated rows, null keys and other columns need nothing
    special, and an empty table gives no rows. Long texts are encoded run by run, a run being white space and what follows up to the next; only with a
    pattern whose pieces reach over that, whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            ids = list(own.encode([one or "" for one in batch.column(1).to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(one) // 4 for one in ids], pa.int64()), pa.array(ids, pa.binary()),
                    pa.array([own.decode(one) for one in ids], pa.binary()),
                ],
                ["key", "n_tokens", "ids", "decoded"],
            )

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    shape = f"key {rows.schema['key'].dataType.simpleString()}, n_tokens bigint, ids binary, decoded binary"
    return rows.mapInArrow(run, shape).withColumnRenamed("key", key)
