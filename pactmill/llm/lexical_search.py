"""Ranked lexical search by accumulator-limited term-at-a-time evaluation, exact.

1. Statistics: one pass over the texts keeps, per document, its number of terms and how often the terms of the items occur. Totals and document frequencies
   follow from that narrow table.
2. Search: documents are taken in blocks of bounded size. In a block every posting's share of a score is computed once, for
   all items. An item's terms are then taken one at a time, rarest first. Documents get accumulators until the bounds of the terms
   left cannot reach the k-th best partial score any more; from there on only the survivors are updated, by looking
   them up in the longer lists. The best k of a block go to a grouped top k.

Items are a stated query set. They are taken in groups of at most ``TERMS_TOGETHER`` terms (one item at least), each group in a
pass of its own, so that neither the driver nor a task holds more of them than that.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pactmill import session

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_ANY_CASE = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
TERMS_TOGETHER = 500_000  # terms of the items that are searched in one pass
BLOCK_DOCUMENTS = 16_384
BLOCK_POSTINGS = 2_000_000
PIECE_BYTES = 1 << 20  # of a long text that is cut into terms at once

_POSTINGS = "key bigint, n bigint, terms array<int>, tfs array<bigint>"


def count_terms(text: bytes) -> Counter:
    """How often each term occurs. A long text is taken in pieces that end where no term is cut."""
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE_BYTES)
        cut = _ANY_CASE.match(text, end)
        end = cut.end() if cut else end
        counts.update(TERM.findall(text[at:end].lower()))  # in bytes only A-Z change
        at = end
    return counts


def _postings(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for text in batch.column(1).cast(pa.large_binary()):
                counts = count_terms(text.as_py() or b"")
                found = counts.keys() & vocabulary.keys()
                sizes.append(counts.total())
                terms.append([vocabulary[term] for term in found])
                tfs.append([counts[term] for term in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                ["key", "n", "terms", "tfs"],
            )

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def damping(sizes: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """A document's m. Sizes so large that 64 bits would not hold the product are taken one by one."""
    if not len(sizes) or int(sizes.max()) * 90 * n_docs < 1 << 63:
        return 10 + (90 * n_docs * sizes) // total
    return np.array([10 + 90 * int(n) * n_docs // total for n in sizes], np.int64)


def search_block(
    docs: np.ndarray, terms: np.ndarray, shares: np.ndarray, items: list[np.ndarray], k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The best ``k`` documents of a block for every item: item, document numbers, scores. Documents equal to the k-th in score
    are all given.

    ``docs``, ``terms`` and ``shares`` hold the block's postings; ``items`` the terms of each item, rarest first.
    """
    if not len(docs):
        return
    order = np.lexsort((docs, terms))
    docs, terms, shares = docs[order], terms[order], shares[order]
    own, starts = np.unique(terms, return_index=True)
    ends = np.append(starts[1:], len(terms))
    bounds = np.maximum.reduceat(shares, starts)
    partial = np.zeros(int(docs.max()) + 1, np.int64)
    for item, wanted in enumerate(items):
        lists = np.searchsorted(own, wanted)
        lists = lists[(lists < len(own)) & (own[np.minimum(lists, len(own) - 1)] == wanted)]
        if not len(lists):
            continue
        left = np.append(np.cumsum(bounds[lists][::-1])[::-1], 0)  # the most that the lists from here on can add
        seen, place = [], 0
        while place < len(lists):  # accumulators are created
            at = slice(starts[lists[place]], ends[lists[place]])
            seen.append(docs[at])
            partial[docs[at]] += shares[at]
            place += 1
            if place < len(lists) and left[place] < left[0] - left[place]:  # otherwise no partial score can be above the rest
                # distinct without sorting: the one that finds its own mark is counted
                found = _distinct(seen, partial)
                seen = [found]
                if len(found) >= k and np.partition(partial[found], -k)[-k] > left[place]:
                    break
        survivors = _distinct(seen, partial)
        for at in (slice(starts[x], ends[x]) for x in lists[place:]):  # no new ones from here on
            held = docs[at]
            if len(survivors) * 16 < len(held):
                there = np.searchsorted(held, survivors)
                hit = held[np.minimum(there, len(held) - 1)] == survivors
                partial[survivors[hit]] += shares[at][there[hit]]
            else:
                hit = partial[held] > 0
                partial[held[hit]] += shares[at][hit]
        scores = partial[survivors]
        partial[survivors] = 0
        good = scores > 0
        if good.any():
            found, scores = survivors[good], scores[good]
            if len(found) > k:
                best = scores >= np.partition(scores, -k)[-k]
                found, scores = found[best], scores[best]
            yield item, found, scores


def _distinct(parts: list[np.ndarray], partial: np.ndarray) -> np.ndarray:
    """Sorted distinct documents of several sorted lists, without those whose partial score is still zero."""
    found = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
    return found[partial[found] > 0]


def _search(items: list[np.ndarray], weights: np.ndarray, n_docs: int, total: int, k: int):
    def block(keys: list, sizes: list, lists: list, tfs: list) -> pa.RecordBatch:
        keys, sizes = pa.concat_arrays(keys), np.concatenate(sizes)
        docs = np.repeat(np.arange(len(keys)), np.concatenate([np.diff(one.offsets.to_numpy()) for one in lists]))
        terms = np.concatenate([one.flatten().to_numpy() for one in lists])
        tf = np.concatenate([one.flatten().to_numpy() for one in tfs])
        m = damping(sizes, n_docs, total)
        shares = weights[terms] * ((1_000_000_000 * tf) // (1_000 * tf + 8 * m[docs]))
        key_of, null = keys.fill_null(0).to_numpy(), keys.is_null().to_numpy(zero_copy_only=False)
        out_items, out_docs, out_scores = [], [], []
        for item, found, scores in search_block(docs, terms, shares, items, k):
            if len(found) > k:  # ties at the end: the smallest keys stay, null keys last
                found_order = np.lexsort((key_of[found], null[found], -scores))[:k]
                found, scores = found[found_order], scores[found_order]
            out_items.append(np.full(len(found), item, np.int32))
            out_docs.append(found)
            out_scores.append(scores)
        at = np.concatenate([np.zeros(0, np.int64), *out_docs])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.zeros(0, np.int32), *out_items]), pa.int32()), keys.take(pa.array(at)),
                pa.array(np.concatenate([np.zeros(0, np.int64), *out_scores]), pa.int64()),
            ],
            ["item", "key", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held, n_postings = ([], [], [], []), 0, 0
        for batch in batches:
            for column, part in zip(held, (batch.column(0), batch.column(1).to_numpy(), batch.column(2), batch.column(3))):
                column.append(part)
            n_held += len(batch)
            n_postings += len(batch.column(2).flatten())
            if n_held >= BLOCK_DOCUMENTS or n_postings >= BLOCK_POSTINGS:
                yield block(*held)
                held, n_held, n_postings = ([], [], [], []), 0, 0
        if n_held:
            yield block(*held)

    return run


def _groups(items: DataFrame) -> Iterator[list[tuple]]:
    """The items in groups of bounded size: (item key, terms)."""
    group, terms = [], 0
    for key, text in items.toLocalIterator():
        wanted = sorted(count_terms((text or "").encode()))
        if group and terms + len(wanted) > TERMS_TOGETHER:
            yield group
            group, terms = [], 0
        group.append((key, wanted))
        terms += len(wanted)
    if group:
        yield group


def ranked(
    documents: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``k`` documents of highest score above zero for each item: item key, rank, key, score.

    Equal scores are ranked by ascending key, rows without a key behind those with one. Every row of ``documents`` is a document of its own and every
    row of ``items`` an item of its own, repeated keys or not; null and empty texts have no terms, and an item without any gets no rows. Long
    texts are cut into terms piece by piece. An empty table on either side gives no rows. Columns other than the four named ones are not looked at.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    asked = items.select(F.col(item_key).alias("item_key"), F.col(item_text).alias("text"))
    kind = asked.schema["item_key"].dataType.simpleString()
    shape = f"item_key {kind}, rank int, key bigint, score bigint"
    found = None
    for number, group in enumerate(_groups(asked)):
        names = sorted(set().union(*(wanted for _, wanted in group)))
        vocabulary = {term: k for k, term in enumerate(names)}
        postings = session.stored(texts.mapInArrow(_postings(vocabulary), _POSTINGS), "postings")
        n_docs, total = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        df = np.zeros(len(names), np.int64)
        for term, count in postings.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            df[term] = count
        weights = np.array([weight(n_docs, int(one)) for one in df], np.int64)
        wanted = []
        for _, terms in group:
            own = np.array([vocabulary[term] for term in terms], np.int64)
            wanted.append(own[np.lexsort((own, df[own]))])
        best = postings.where(F.size("terms") > 0).mapInArrow(_search(wanted, weights, n_docs, total, k), "item int, key bigint, score bigint")
        place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
        best = best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        keys = spark.createDataFrame([(n, one) for n, (one, _) in enumerate(group)], f"item int, item_key {kind}")
        part = best.join(F.broadcast(keys), "item").select("item_key", "rank", "key", "score")
        # one pass is the usual case; the results of several are at most k rows an item and are kept, as each has a table of its own
        found = part if found is None else found.unionByName(session.stored(part, f"ranked-{number}"))
    if found is None:
        found = spark.createDataFrame([], shape)
    return found.toDF(item_key, "rank", key, "score")
