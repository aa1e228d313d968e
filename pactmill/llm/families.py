"""Exact comparison of candidate sets that hang together.

Candidates that hang together by links form a family. In a family every pair is compared by the full sets of shingles unless the two hang
together by confirmed links already, so a family's links span exactly what hangs together by similarity.

A family that fits a task is compared there. A larger one is first compared with one member, its hub, and then with up to ``HUBS`` members that
are still open; sets similar to these and through them to the first need no further comparison among each other. What stays open is compared with
the whole family in tiles of bounded size. Work and copies thus grow with the sets that are not similar to a hub, not with the square of the family.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pactmill import session
from pactmill.llm import wordhash
from pactmill.llm.components import components

FAMILY_BITS = 400_000_000  # sets times tokens of a family, or of a tile, that are compared in one task
HUBS = 2
CANDIDATES_BROADCAST = 1_000_000  # more rows than this are joined by a shuffle instead

_LINK = "a bigint, b bigint"


def bounded(df: DataFrame, rows: int = CANDIDATES_BROADCAST) -> DataFrame:
    """``df`` with a broadcast hint if a count of its rows shows that it is small."""
    return F.broadcast(df) if df.count() <= rows else df


def similar(shared: np.ndarray, x: np.ndarray, y: np.ndarray, share: int) -> np.ndarray:
    """Whether sets of these sizes and intersections are similar."""
    return 100 * shared >= share * (x + y - shared)


def tile_links(ids: np.ndarray, sets: list[np.ndarray], across: np.ndarray, share: int) -> list[tuple[int, int]]:
    """Spanning links among sets, compared as rows of bits, one for each token that several of them have. Pairs with equal
    numbers in ``across`` are not compared, unless the number is -1; nor are sets that hang together already."""
    sizes = np.array([len(one) for one in sets])
    tokens, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    column = np.cumsum(count > 1) - 1
    kept = count[at] > 1
    at, owner = column[at[kept]], owner[kept]
    words = (int(column[-1]) >> 6) + 1 if len(column) and column[-1] >= 0 else 1
    rows = np.zeros((len(sets), words), np.uint64)
    np.bitwise_or.at(rows, (owner, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    group, links = np.arange(len(ids)), []
    for k in range(len(ids) - 1):
        rest = np.arange(k + 1, len(ids))
        rest = rest[(group[rest] != group[k]) & ((across[rest] != across[k]) | (across[rest] == -1))]
        rest = rest[np.minimum(sizes[rest], sizes[k]) * 100 >= share * np.maximum(sizes[rest], sizes[k])]
        for low in range(0, len(rest), 4_096):
            part = rest[low:low + 4_096]
            shared = np.bitwise_count(rows[part] & rows[k]).sum(axis=1, dtype=np.int64)
            for other in part[similar(shared, sizes[part], sizes[k], share)].tolist():
                if group[other] != group[k]:
                    group[group == group[other]] = group[k]
                    links.append((int(ids[k]), int(ids[other])))
    return links


def _tile(share: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        sets = [np.frombuffer(one, np.uint64) for one in table.column("tokens").to_pylist()]
        links = tile_links(ids, sets, table.column("across").to_numpy(), share) if len(ids) > 1 else []
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def _packed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = pa.array([one.tobytes() for one in wordhash.shingle_sets(batch.column(1), width)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), tokens], ["id", "family", "tokens"])

    return run


def _linked_to_hub(share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(bool(similar(shared, len(x), len(y), share)))
            yield pa.RecordBatch.from_arrays(batch.columns[:3], ["family", "id", "hub"]).filter(pa.array(keep, pa.bool_()))

    return run


def confirmed_links(
    texts: DataFrame, reps: DataFrame, candidates: DataFrame, support: DataFrame, width: int, share: int, bits: int = FAMILY_BITS
) -> DataFrame:
    """Links (a, b) between similar sets that span what hangs together by similarity.

    ``texts`` has id and text, ``reps`` id and n_shingles of the distinct sets, ``candidates`` links (a, b), ``support`` a number for each id: hubs
    are chosen by the largest.
    """
    families = components(candidates).withColumnRenamed("component", "family").join(reps.select("id", "n_shingles"), "id")
    families = session.stored(families.join(support, "id", "left"), "families")
    load = session.stored(families.groupBy("family").agg(F.count(F.lit(1)).alias("sets"), F.sum("n_shingles").alias("tokens")), "family-sizes")
    members = bounded(families.select("id", "family").distinct())
    sets = session.stored(
        texts.join(members, "id").select("id", "text", "family").mapInArrow(_packed(width), "id bigint, family bigint, tokens binary"), "family-sets"
    )
    weight = F.col("sets").cast("double") * F.col("tokens")
    small = sets.join(load.where(weight <= bits).select("family"), "family").withColumn("across", F.lit(-1))
    found = small.groupBy("family").applyInArrow(_tile(share), _LINK)
    # a tile of two slices has half the sets and half the tokens of either
    slices = F.ceil(F.sqrt(weight * 4 / F.lit(bits))).cast("int").alias("slices")
    large = load.where(weight > bits).select("family", "sets", slices)
    if large.isEmpty():
        return found
    placed = session.stored(sets.join(large, "family").join(families.select("id", "support").distinct(), "id", "left"), "large-family-sets")
    done = None
    for _ in range(HUBS):
        open_ = placed if done is None else placed.join(done, ["family", "id"], "left_anti")
        hubs = open_.groupBy("family").agg(F.max_by("id", F.struct("support", -F.col("id"))).alias("id"))
        hubs = placed.join(hubs, ["family", "id"]).select("family", F.col("id").alias("hub"), F.col("tokens").alias("hub_tokens"))
        near = session.stored(
            placed.join(hubs, "family").select("family", "id", "hub", "tokens", "hub_tokens").mapInArrow(
                _linked_to_hub(share), "family bigint, id bigint, hub bigint"
            ), "near-hubs"
        )
        found = found.unionByName(near.select(F.col("hub").alias("a"), F.col("id").alias("b")))
        reached = near.select("family", "id").distinct()
        if done is None:
            done = reached
        elif near.isEmpty():  # a hub is like itself, so nothing was open
            break
        else:
            joined = reached.join(done, ["family", "id"], "left_semi").select("family").distinct()
            done = done.unionByName(reached.join(joined, "family")).distinct()
    placed = session.stored(
        placed.join(done.withColumn("done", F.lit(True)), ["family", "id"], "left").na.fill(False, ["done"]), "placed-sets"
    )
    # open sets are compared with all others, a slice of them with each slice of the family
    few = F.greatest(F.lit(1.0), F.ceil(F.count(F.lit(1)) * F.first("slices") / F.first("sets")).cast("double")).cast("int")
    placed = placed.join(placed.where("not done").groupBy("family").agg(few.alias("rounds")), "family")
    spread = lambda column: F.pmod(F.xxhash64("id"), F.col(column)).cast("int")
    every = lambda column: F.explode(F.sequence(F.lit(0), F.col(column) - 1))
    left = placed.where("not done").withColumn("low", spread("rounds")).withColumn("high", every("slices")).withColumn("across", F.lit(0))
    right = placed.withColumn("high", spread("slices")).withColumn("low", every("rounds")).withColumn("across", F.lit(1))
    columns = ["family", "low", "high", "id", "tokens", "across"]
    tiles = left.select(columns).unionByName(right.select(columns)).groupBy("family", "low", "high").applyInArrow(_tile(share), _LINK)
    return found.unionByName(tiles)
