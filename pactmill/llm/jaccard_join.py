"""Set-similarity join on word n-grams by partitioning the universe of tokens.

Two sets of x and y tokens whose intersection is at least ``SHARE`` per cent of their union differ in at most (x + y) * (100 - SHARE) / (100 + SHARE)
tokens. Sets are sorted into bands of sizes, so that similar sets lie in the same band or in neighbouring ones. For each band the universe is
hashed into one segment more than two sets of that band can differ by, so that two similar sets have the same subset in at least
one segment (pigeonhole). A set enters the index of its own band, and that of the next one if a similar set can lie there.

1. Sets: one pass over the texts; equal sets are one from there on.
2. Index: the hash of a set's subset in every segment. Subsets shared by more than ``HOT`` sets are dear: all their sets would be compared.
   A set with dear segments gives them up, as far as they are no more than half, and pays with its other segments, which may then
   differ by one token: it also enters the index with every one-deletion neighbour of these. Sets with more dear segments than that keep
   all of them, and enter with all one-deletion neighbours too. Others have nothing to pay.
3. Candidates that hang together by common entries form a family. In a family sets are compared exactly, token by token, where
   they do not hang together already. Large families are first compared with one of their members; only those that are not linked to it
   are compared with all others, in tiles of bounded size.

No link is lost when dear segments are given up. Take two similar sets without a common entry of whole subsets, in an index of m segments; they
differ by less than m tokens. The e segments in which they are equal are dear, so at least one of the sets, x, gave up h <= m / 2 segments,
these among them, and the other gave up either all of its dear ones, g <= m / 2, these among them again, or none. Let u be the segments that either
gave up: u + e <= h + g <= m, or u + e <= 2 h <= m. If the sets differed by two tokens or more in each of the other m - u segments, they would
differ by 2 (m - u) + (u - e) >= m tokens. So there is a segment that neither gave up in which they differ by one token, and there the
smaller subset is a one-deletion neighbour of the larger. Sets without dear segments always meet similar sets by whole subsets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pactmill import session
from pactmill.llm import families, wordhash
from pactmill.llm.components import components

WIDTH = 3
SHARE = 90  # per cent of the union that two sets must share
HOT = 512  # more sets than this make a subset dear

_SETS = "id bigint, n_shingles bigint, digest_a bigint, digest_b bigint, keys array<bigint>"


def band(size: int, share: int = SHARE) -> tuple[int, int]:
    """The band of a size: its number and its largest size."""
    number, high = 0, 1
    while high < size:
        number, high = number + 1, (high + 1) * 100 // share
    return number, high


def differing(x: int, y: int, share: int = SHARE) -> int:
    """The most tokens by which similar sets of these sizes can differ."""
    return (x + y) * (100 - share) // (100 + share)


def placements(size: int, share: int = SHARE) -> list[tuple[int, int]]:
    """The indexes that a set of this size enters: number of the band and of segments."""
    number, high = band(size, share)
    found = [(number, differing(high, high, share) + 1)]
    if size * 100 // share > high:
        upper = (high + 1) * 100 // share
        found.append((number + 1, differing(upper, upper, share) + 1))
    return found


def _segments(tokens: np.ndarray, number: int, count: int) -> np.ndarray:
    """The segment of every token, each band dividing the universe in its own way."""
    mixed = wordhash.mix(tokens ^ np.uint64(number * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return ((mixed >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)


def _entries(sums: np.ndarray, segments: np.ndarray, number: int) -> np.ndarray:
    """The index entry of a segment's subset, given by the sum of its hashed tokens."""
    place = wordhash.mix(segments.astype(np.uint64) + np.uint64(number << 40) + np.uint64(1))
    return wordhash.mix(sums ^ place).astype(np.int64)


def subset_sums(tokens: np.ndarray, number: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the hashed tokens of every segment, each token's segment and its hash."""
    segments = _segments(tokens, number, count).astype(np.int64)
    hashed = wordhash.mix(tokens + np.uint64(0x632BE59BD9B4E019))
    sums = np.zeros(count, np.uint64)
    np.add.at(sums, segments, hashed)
    return sums, segments, hashed


def subset_entries(tokens: np.ndarray, share: int = SHARE) -> np.ndarray:
    """Entries of all segments in all indexes that the set enters."""
    found = []
    for number, count in placements(len(tokens), share):
        sums, _, _ = subset_sums(tokens, number, count)
        found.append(_entries(sums, np.arange(count), number))
    return np.concatenate(found)


def allocated_entries(tokens: np.ndarray, dear: set[int], share: int = SHARE) -> tuple[np.ndarray, np.ndarray]:
    """What a set with dear segments enters: whole subsets, and one-deletion neighbours."""
    whole, less = [], []
    for number, count in placements(len(tokens), share):
        sums, segments, hashed = subset_sums(tokens, number, count)
        entries = _entries(sums, np.arange(count), number)
        costly = np.array([entry in dear for entry in entries.tolist()])
        if not costly.any():
            whole.append(entries)
            continue
        if 2 * costly.sum() > count:
            costly[:] = False
        whole.append(entries[~costly])
        own = ~costly[segments]
        less.append(_entries(sums[segments[own]] - hashed[own], segments[own], number))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *whole]), np.concatenate([none, *less])


def _sets(width: int, share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, a, b, keys = [], [], [], []
            for tokens in wordhash.shingle_sets(batch.column(1), width):
                sizes.append(len(tokens))
                a.append(int(tokens.sum(dtype=np.uint64).astype(np.int64)))
                b.append(int(wordhash.mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                keys.append(subset_entries(tokens, share) if len(tokens) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, a, b)), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "n_shingles", "digest_a", "digest_b", "keys"],
            )

    return run


def _allocated(width: int, share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, less = [], []
            for tokens, dear in zip(wordhash.shingle_sets(batch.column(1), width), batch.column(2).to_pylist()):
                one, two = allocated_entries(tokens, set(dear), share)
                whole.append(one)
                less.append(two)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(whole, kind), pa.array(less, kind)], ["id", "keys", "less"])

    return run


def candidate_links(texts: DataFrame, reps: DataFrame, width: int, share: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of every set to the first one with a common entry, and for each set how many other sets its entries meet.

    Entries are counted in the tasks that read them before they move. Each set is linked to one other per entry, so that no group of sets
    is ever spelled out as pairs. It is the one that meets the most other sets: near copies mostly agree in it, so that a set
    has few links though it has many entries.
    """
    entries = reps.select("id", F.explode("keys").alias("entry"))
    shared = entries.groupBy("entry").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    common = session.stored(entries.join(shared, "entry"), "common-entries")
    support = session.stored(common.groupBy("id").agg(F.sum(F.col("n") - 1).alias("support")), "support")

    def star(rows: DataFrame) -> DataFrame:
        ranked = rows.join(support, "id", "left").withColumn("support", F.coalesce("support", F.lit(0)))
        return ranked.groupBy("entry").agg(F.max_by("id", F.struct("support", -F.col("id"))).alias("first"))

    dear = session.stored(common.where(F.col("n") > hot).groupBy("id").agg(F.collect_set("entry").alias("dear")), "dear-entries")
    if dear.isEmpty():
        links = common.join(star(common), "entry").select("id", "first")
    else:
        own = session.stored(
            texts.join(families.bounded(dear), "id").select("id", "text", "dear").mapInArrow(
                _allocated(width, share), "id bigint, keys array<bigint>, less array<bigint>"
            ), "allocated"
        )
        paying = own.select("id", F.explode("keys").alias("entry"))
        whole = common.select("id", "entry").join(dear.select("id"), "id", "left_anti").unionByName(paying)
        less = own.select("id", F.explode("less").alias("entry"))
        links = whole.join(star(whole), "entry").select("id", "first").unionByName(less.join(star(paying), "entry").select("id", "first"))
    # a set hangs on one of the sets it was linked to, and these hang together: few pairs, which many sets share
    own = session.stored(links.groupBy("id").agg(F.min("first").alias("a"), F.collect_set("first").alias("hubs")), "set-hubs")
    across = own.where(F.size("hubs") > 1).select("a", F.explode("hubs").alias("b")).distinct()
    return own.select("a", F.col("id").alias("b")).unionByName(across).where("a <> b").distinct(), support


def joined(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, share: int = SHARE, hot: int = HOT, family_bits: int = families.FAMILY_BITS
) -> DataFrame:
    """One row per input row: key, n_shingles, component_id (smallest key reachable by links, itself included).

    Rows are linked when their sets share at least ``share`` per cent of their union; rows with equal sets always are. Null and blank texts have
    no shingles and no links. Of long texts the set is held, the words piece by piece. A row without a key takes no part: its component_id is null. Rows
    that share a key are judged each by its own text; where such rows are the first of their sets, these sets hang together. An empty table
    gives no rows. Other columns are not looked at.
    """
    texts = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    sets = session.stored(texts.mapInArrow(_sets(width, share), _SETS), "gram-sets")
    digest = ["digest_a", "digest_b", "n_shingles"]
    reps = session.stored(
        sets.where("n_shingles > 0 and id is not null").groupBy(*digest).agg(F.min(F.struct("id", "keys")).alias("r")).select(*digest, "r.*"),
        "distinct-grams",
    )
    candidates, support = candidate_links(texts, reps, width, share, hot)
    links = families.confirmed_links(texts, reps, candidates, support, width, share, family_bits)
    linked = session.stored(components(links), "gram-components")
    of_set = reps.join(linked, "id", "left").select(*digest, F.coalesce("component", "id").alias("component"))
    return sets.select("id", *digest).join(of_set, digest, "left").select(
        F.col("id").alias(key), "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")
    )
