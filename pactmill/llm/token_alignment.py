"""Alignment of the tokens that two tokenizers make of the same text.

Both token sequences cut the text's bytes into ranges. The end offsets of one sequence are intersected with those of the other by
galloping: the shorter list drives, each of its ends is searched in the longer one from the place of the end before it, first in steps that
double and then by bisection. Ends found in both lists cut the tokens into groups. The places found also tell the tokens that overlap: between the
ranks of two neighbouring ends of the shorter list lie the tokens of the longer one that share bytes with the token between them.

Ends are searched in lockstep: every 2^k-th end first, then those half way, each from the place of its left neighbour among the ones found
already, so that a search of many documents is one numpy step per level.

Counts over the corpus: id pairs are counted by the documents that hold them. Pairs held by so many documents that only ``FREQUENT_PAIRS``
of them can exist are looked up from a broadcast table; all others meet their counts in a join, which these no longer skew.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from pactmill import session

TOKENS_TOGETHER = 1_000_000  # tokens of both sides that are aligned in one numpy pass
WORDS_TOGETHER = 100_000  # words of a document that are aligned in one part
CACHED_WORDS, CACHED_CHARACTERS = 300_000, 6_000_000
LONG_WORD = 1_000  # characters from which on a word is encoded apart
FREQUENT_PAIRS = 100_000

# Fixed value: the pattern of byte-level pre-tokenizers.
_BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A blank between a character that is no white space and a word. Neither tokenizer has a token that reaches over one, so
# words can be encoded, and remembered, one by one; ``Encoder`` makes sure that the vocabularies allow it.
_CUT = re.compile(r"(?<=\S) (?= *[^ ])")


def _byte_names() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {chr(b): b for b in plain}
    return names | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in names.values())}


class Encoder:
    """Token ids of words by two tokenizers, A byte-level and B by pieces."""

    def __init__(self, a_json: str, b_model: bytes) -> None:
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        names = _byte_names()
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [b""] * size
        for token, k in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[k] = bytes(names[c] for c in token) if all(c in names for c in token) else token.encode()
        self.b_bytes = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode())
        self.a_length = np.array([len(one) for one in self.a_bytes], np.int64)
        self.b_length = np.array([len(one) for one in self.b_bytes], np.int64)
        # A cuts in front of such a blank by its pattern; B has no piece with a blank behind anything else
        cutting = json.loads(a_json)
        before = cutting.get("pre_tokenizer") or {}
        self.by_word = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and cutting.get("normalizer") is None and not any(b" " in one.lstrip(b" ") for one in self.b_bytes)
        )
        self.quick = self._quick(cutting, names) if self.by_word else None
        self.words: dict[str, tuple[bytes, bytes] | None] = {}
        self.characters = 0

    def _quick(self, cutting: dict, names: dict[str, int]) -> tiktoken.Encoding | None:
        """The same encoder in a quicker library, if ids follow the order of the merges: the lowest rank then is the earliest merge."""
        model = cutting["model"]
        pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
        base = len(names)  # the bytes come first
        usual = not any(model.get(name) for name in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not usual or any(model["vocab"][a + b] != base + k for k, (a, b) in enumerate(pairs)):
            return None
        ranks = {bytes(names[c] for c in token): k for token, k in model["vocab"].items() if k < base + len(pairs)}
        return tiktoken.Encoding("a", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def cut(self, text: str) -> list[str]:
        return _CUT.split(text) if self.by_word else [text]

    def _together(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of words that do not end in white space, encoded as one text and cut at their ends. Where its bytes are not given back, the
        halves are encoded apart, down to the words it is due to."""
        content = " " + " ".join(words)
        if self.quick and len(words[0]) < LONG_WORD:
            a = self.quick.encode_ordinary(content)
        else:
            a = self.a.encode_batch_fast([content], add_special_tokens=False)[0].ids
        b = self.b.encode(content[1:])
        whole = content.encode()
        if not b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b)):
            if len(words) == 1:
                return [None]
            return self._together(words[:len(words) // 2]) + self._together(words[len(words) // 2:])
        ends = np.cumsum([len(word.encode()) + 1 for word in words])
        packed = []
        for ids, lengths in ((np.array(a, np.int32), self.a_length), (np.array(b, np.int32), self.b_length)):
            cuts = np.searchsorted(np.cumsum(lengths[ids]), ends, "right") << 2
            own = ids.tobytes()
            packed.append([own[begin:end] for begin, end in zip([0, *cuts.tolist()], cuts.tolist())])
        return list(zip(*packed))

    def _learn(self, words: list[str]) -> None:
        for word in words:
            if not word or word[-1].isspace() or len(word) >= LONG_WORD:
                self.words[word] = self._together([word])[0]
        plain = [word for word in words if word not in self.words]
        for k in range(0, len(plain), 1_024):
            self.words.update(zip(plain[k:k + 1_024], self._together(plain[k:k + 1_024])))

    def encode(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Packed ids by A and by B of a blank and each word; None where the tokens do not give back these bytes."""
        new = list({word for word in words if word not in self.words})
        characters = sum(map(len, new))
        if len(self.words) + len(new) > CACHED_WORDS or self.characters + characters > CACHED_CHARACTERS:
            self.words.clear()
            new = list(set(words))
            self.characters, characters = 0, sum(map(len, new))
        self.characters += characters
        self._learn(new)
        return list(map(self.words.__getitem__, words))


def _search(values: np.ndarray, wanted: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where in ``values``, from ``at`` on, the first one stands that is not below what is wanted: in doubling steps, then by bisection."""
    low, high, step = at, at.copy(), 1
    open_ = np.flatnonzero(values[high] < wanted)
    low = low.copy()
    while len(open_):
        low[open_] = high[open_] + 1
        high[open_] = np.minimum(high[open_] + step, len(values) - 1)
        step *= 2
        open_ = open_[values[high[open_]] < wanted[open_]]
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        below = values[middle] < wanted[open_]
        low[open_] = np.where(below, middle + 1, low[open_])
        high[open_] = np.where(below, high[open_], middle)
        open_ = open_[low[open_] < high[open_]]
    return low


def galloping_ranks(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For every end in ``short`` the rank of the first end in ``long`` that is not below it. Both increase and have the same last end."""
    ranks = np.zeros(len(short), np.int64)
    if not len(short):
        return ranks
    ranks[:1] = _search(long, short[:1], np.zeros(1, np.int64))
    stride = 1 << (len(short) - 1).bit_length()
    while stride > 1:
        half = stride >> 1
        own = np.arange(half, len(short), stride)
        ranks[own] = _search(long, short[own], ranks[own - half])
        stride = half
    return ranks


def overlaps(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks of common ends in ``short``, and for every token of ``short`` the first and last token of ``long`` that shares bytes with it."""
    last = galloping_ranks(short, long)
    common = long[last] == short
    first = np.zeros(len(short), np.int64)
    first[1:] = last[:-1] + common[:-1]
    return np.flatnonzero(common), first, last


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids in decimal as rows of bytes with one byte free behind them, and their lengths."""
    width = len(str(max(1, size - 1)))
    rows = np.zeros((size, width + 1), np.uint8)
    texts = np.array([str(k).encode() for k in range(size)], f"S{width}")
    rows[:, :width] = texts.view(np.uint8).reshape(size, width)
    return rows, (rows > 0).sum(axis=1)


class Aligner:
    """Aligns parts of documents, many at a time."""

    def __init__(self, encoder: Encoder) -> None:
        self.encoder = encoder
        self.digits = _digits(max(len(encoder.a_bytes), len(encoder.b_bytes)))

    def groups_text(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The groups as text, ``a1,a2|b1;a3|b2,b3;``, and the offset behind each of them; ends are ranks of each group's last token."""
        rows, lengths = self.digits
        ids = np.empty(len(a) + len(b), np.int64)
        after = np.full(len(ids), ord(","), np.uint8)
        in_group = lambda ends, n: np.repeat(np.arange(len(ends)), np.diff(ends, prepend=-1))
        a_before, b_before = np.append(0, a_ends[:-1] + 1), np.append(0, b_ends[:-1] + 1)
        a_at = np.arange(len(a)) + b_before[in_group(a_ends, len(a))]
        b_at = np.arange(len(b)) + (a_ends + 1)[in_group(b_ends, len(b))]
        ids[a_at], ids[b_at] = a, b
        after[a_at[a_ends]], after[b_at[b_ends]] = ord("|"), ord(";")
        text = rows[ids]
        text[np.arange(len(ids)), lengths[ids]] = after
        upto = np.cumsum(lengths[ids] + 1)
        flat = text.ravel()
        return flat[flat > 0].tobytes(), upto[b_at[b_ends]]

    def parts(self, a: list[bytes], b: list[bytes]) -> Iterator[tuple[int, int, int, bytes, np.ndarray, np.ndarray]]:
        """For each part, given as packed ids: tokens of A, of B, groups, the groups' text, and every link's pair of ids (A's in the upper
        half of 64 bits) with how often it occurs."""
        n_a = np.array([len(one) >> 2 for one in a])
        n_b = np.array([len(one) >> 2 for one in b])
        a_ids, b_ids = np.frombuffer(b"".join(a), np.int32), np.frombuffer(b"".join(b), np.int32)
        a_ends, b_ends = np.cumsum(self.encoder.a_length[a_ids]), np.cumsum(self.encoder.b_length[b_ids])
        # the shorter list of a part drives; parts of either kind are searched together
        shorter = n_a <= n_b
        a_short, b_short = np.repeat(shorter, n_a), np.repeat(shorter, n_b)
        a_common, b_common = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
        pairs, owner = [], []
        part_a, part_b = np.repeat(np.arange(len(a)), n_a), np.repeat(np.arange(len(a)), n_b)
        for own_a, own_b, a_drives in ((a_short, b_short, True), (~a_short, ~b_short, False)):
            at_a, at_b = np.flatnonzero(own_a), np.flatnonzero(own_b)
            drives, other = (at_a, at_b) if a_drives else (at_b, at_a)
            ends, far = (a_ends[at_a], b_ends[at_b]) if a_drives else (b_ends[at_b], a_ends[at_a])
            common, first, last = overlaps(ends, far)
            mine, its = (a_common, b_common) if a_drives else (b_common, a_common)
            mine[drives[common]] = True
            its[other[last[common]]] = True
            n = last - first + 1
            one = np.repeat(drives, n)
            two = other[np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(int(n.sum()))]
            left, right = (one, two) if a_drives else (two, one)
            pairs.append(a_ids[left].astype(np.int64) << 32 | b_ids[right])
            owner.append((part_a if a_drives else part_b)[one])
        pairs, owner = np.concatenate(pairs), np.concatenate(owner)
        order = np.lexsort((pairs, owner))
        pairs, owner = pairs[order], owner[order]
        new = np.ones(len(pairs), bool)
        new[1:] = (pairs[1:] != pairs[:-1]) | (owner[1:] != owner[:-1])
        begins = np.flatnonzero(new)
        times = np.diff(begins, append=len(pairs))
        pairs, owner = pairs[begins], owner[begins]
        a_last, b_last = np.flatnonzero(a_common), np.flatnonzero(b_common)
        text, behind = self.groups_text(a_ids, b_ids, a_last, b_last)
        groups = np.searchsorted(part_a[a_last], np.arange(len(a) + 1))
        bounds = np.searchsorted(owner, np.arange(len(a) + 1))
        behind = np.append(0, behind)
        for k in range(len(a)):
            low, high = bounds[k], bounds[k + 1]
            own = text[behind[groups[k]]:max(behind[groups[k]], behind[groups[k + 1]] - 1)]
            yield int(n_a[k]), int(n_b[k]), int(groups[k + 1] - groups[k]), own, pairs[low:high], times[low:high]

    def documents(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, bytes, np.ndarray, np.ndarray]]:
        """What ``parts`` gives, for whole documents in turn. Those without tokens have zeros."""
        nothing = (0, 0, 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int64))
        waiting: list[tuple[int, bytes, bytes]] = []  # document, ids by A, ids by B
        held, size, first = {}, 0, 0

        def flush() -> None:
            nonlocal size
            if waiting:
                for (doc, _, _), one in zip(waiting, self.parts([x for _, x, _ in waiting], [x for _, _, x in waiting])):
                    held[doc].append(one)
                waiting.clear()
                size = 0

        for doc, text in enumerate(texts):
            held[doc] = []
            words = self.encoder.cut(text) if text else []
            for k in range(0, len(words), WORDS_TOGETHER):
                codes = self.encoder.encode(words[k:k + WORDS_TOGETHER])
                if None in codes:
                    waiting[:] = [one for one in waiting if one[0] != doc]  # its bytes are not given back: no tokens at all
                    held[doc] = []
                    break
                waiting.append((doc, b"".join(a for a, _ in codes), b"".join(b for _, b in codes)))
                size += len(waiting[-1][1]) + len(waiting[-1][2]) >> 2
                if size > TOKENS_TOGETHER:
                    flush()
            if not waiting:
                yield from (self._joined(held.pop(k), nothing) for k in range(first, doc + 1))
                first = doc + 1
        flush()
        yield from (self._joined(held.pop(k), nothing) for k in range(first, len(texts)))

    @staticmethod
    def _joined(parts: list[tuple], nothing: tuple) -> tuple:
        if len(parts) < 2:
            return parts[0] if parts else nothing
        pairs, at = np.unique(np.concatenate([one[4] for one in parts]), return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, at, np.concatenate([one[5] for one in parts]))
        return (*(sum(one[k] for one in parts) for k in range(3)), b";".join(one[3] for one in parts), pairs, times)


_aligners: dict[str, Aligner] = {}  # of this process, which keeps its words from task to task


def aligned(df: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """Align every whole text: row, n_a, n_b, n_groups, groups, pairs, times. ``row`` is a struct of all input columns.

    A, a byte-level tokenizer, encodes a blank and the text; B, a piece tokenizer that puts the blank there itself, the text. ``groups`` is the
    text ``a1,a2|b1;a3|b2,b3`` of ids in order; ``pairs`` holds each pair of ids linked in the document once, A's id in the upper 32 bits,
    ``times`` the links it stands for. Texts that are null, empty or not given back by the tokens of both have no tokens: zeros, '' and
    empty lists. Long texts are aligned part by part. Repeated rows and columns of any name need nothing special; an empty table gives no rows.
    The two files are read here and sent to the workers.
    """
    with open(a_path, encoding="utf-8") as file:
        a_json = file.read()
    with open(b_path, "rb") as file:
        b_model = file.read()
    files = df.sparkSession.sparkContext.broadcast((a_json, b_model))
    stamp = hashlib.sha256(a_json.encode() + b_model).hexdigest()
    rows = df.select(F.struct(*(df[f"`{c}`"] for c in df.columns)).alias("row"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if stamp not in _aligners:
            _aligners[stamp] = Aligner(Encoder(*files.value))
        own = _aligners[stamp]
        for batch in batches:
            found = list(own.documents(batch.column(1).to_pylist()))
            column = lambda k, kind: pa.array([one[k] for one in found], kind)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), column(0, pa.int64()), column(1, pa.int64()), column(2, pa.int64()),
                    pa.array([one[3].decode() for one in found], pa.string()), column(4, pa.list_(pa.int64())), column(5, pa.list_(pa.int64())),
                ],
                ["row", "n_a", "n_b", "n_groups", "groups", "pairs", "times"],
            )

    return rows.mapInArrow(
        run, f"row {rows.schema['row'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, groups string, pairs array<bigint>, times array<bigint>"
    )


def pair_counts(table: DataFrame) -> DataFrame:
    """Documents that hold each pair of ids, and whether no other pair of its A id is held by more: pair, documents, best.

    ``table`` has one row per document with ``pairs``. Documents are counted in the tasks that read them before anything moves; there are no
    more A ids than the vocabulary has.
    """
    counts = session.stored(
        table.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("documents")), "pair-counts"
    )
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("documents").alias("most"))
    return counts.join(most, F.shiftright("pair", 32) == F.col("a")).select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def with_counts(table: DataFrame) -> DataFrame:
    """Add n_links, n_best and count_sum to a stored table of ``aligned`` documents, in place of pairs and times.

    n_best: links whose pair no other pair of the A id exceeds in documents, ties included; count_sum: documents of the pairs, over all links. Every
    row is a document, repeated or not. ``table`` may hold any columns besides pairs and times that do not begin with an underscore.
    """
    numbered = session.stored(table.withColumn("_row", F.monotonically_increasing_id()), "aligned")
    counts = session.stored(pair_counts(numbered), "pairs")
    held = counts.agg(F.sum("documents")).first()[0] or 0
    often = held // FREQUENT_PAIRS + 1  # no more than FREQUENT_PAIRS pairs can be held by so many documents
    links = numbered.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("_l")).select("_row", F.col("_l.pairs").alias("pair"), F.col("_l.times").alias("times"))
    frequent = links.join(F.broadcast(counts.where(F.col("documents") >= often)), "pair", "left")
    # pairs without a match here are the rare ones; what the frequent ones add is summed in the task, per document
    facts = lambda rows: rows.groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("documents")).alias("count_sum")
    )
    rare = frequent.where(F.col("documents").isNull()).select("_row", "pair", "times").join(counts.where(F.col("documents") < often), "pair")
    sums = facts(frequent.where(F.col("documents").isNotNull())).unionByName(facts(rare))
    sums = sums.groupBy("_row").agg(F.sum("n_best").alias("_best"), F.sum("count_sum").alias("_sum"))
    n_links = F.aggregate("times", F.lit(0).cast("bigint"), lambda total, one: total + one)
    narrow = numbered.withColumn("n_links", n_links).drop("pairs", "times")
    return narrow.join(sums, "_row", "left").select(
        *(c for c in narrow.columns if c != "_row"), F.coalesce("_best", F.lit(0)).alias("n_best"), F.coalesce("_sum", F.lit(0)).alias("count_sum")
    )
