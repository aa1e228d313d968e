"""Near-duplicate documents by a chosen-path set-similarity join.

A document's set is its distinct shingles. Each is represented by a signature of ``ROWS`` minwise tokens (row number and
smallest hash in that row). A tree starts with all documents in one node. A node that is too large branches: it picks rows by the
node's own hash, 1/``CHOICE`` of them on average, and a document goes to the child named by its token in each of them. Two
documents of similarity s above ``CHOICE`` stay together in s/``CHOICE`` children on average, so with some probability down to
any depth, while others part quickly. Small nodes are compared exhaustively by signature. Independent trees are repeated until the
wanted recall is reached.

Candidates that signatures name are confirmed on full sets by ``families``: candidates that hang together form a family, whose documents
are compared where they are not linked yet.

1. Sets: one pass over the texts gives size, a digest of the set, the nodes it reaches from the roots, and a sketch: the lowest byte of each
   token of the signature, which is enough to compare and to branch further. Equal sets are one node from there on.
2. Trees: narrow rows (document, node) are counted by node. Up to ``TASK_ROWS`` documents are branched further inside a
   task. The documents of a larger node are compared with one of them. If no more than ``TASK_ROWS`` are unlike it, the node ends: these are compared
   with all others in tiles, and all that are like it hang together by it. So a node full of near copies, which would not
   shrink by branching, is not branched at all. Other nodes are branched by Spark, level by level, and end in tiles at the deepest level.
3. Families from the spanning links of the nodes, then one confirmation per family.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pactmill import session
from pactmill.llm import families, wordhash
from pactmill.llm.components import components

WIDTH = 5
SHARE = 85  # per cent of the union that two sets must share
ROWS = 128
CHOICE = 0.7
TREES = 6
SMALL_NODE = 256
TASK_ROWS = 2_048
DEEPEST = 24  # levels that Spark branches
DEEPEST_IN_TASK = 8
# Signature rows that must agree: four standard deviations below the mean for a pair right at the threshold
AGREEING = int(ROWS * 0.85 - 4 * (ROWS * 0.85 * 0.15) ** 0.5)

_SETS = "id bigint, text_hash bigint, n_shingles bigint, digest_a bigint, digest_b bigint, nodes array<bigint>, sketch binary"
_rng = np.random.default_rng(20_240_607)
_FACTORS = (_rng.integers(0, 1 << 32, ROWS, np.uint32) | np.uint32(1))[:, None]
_SALTS = _rng.integers(0, 1 << 32, ROWS, np.uint32)[:, None]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest of the hashed shingles in each row."""
    low = np.full(ROWS, 0xFFFFFFFF, np.uint32)
    folded = (shingles >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(folded), 1024):
        np.minimum(low, ((folded[k:k + 1024] ^ _SALTS) * _FACTORS).min(axis=1), out=low)
    return low


def _mixed(*parts: int) -> int:
    """One 64-bit number from several."""
    h = 0
    for part in parts:
        h = int(wordhash.mix(np.array([(h * 0x9E3779B97F4A7C15 + part + 1) & (1 << 64) - 1], np.uint64))[0])
    return h


def _picks(node: int) -> list[int]:
    """The rows a node branches by, 1/``CHOICE`` of them on average."""
    picks = {_mixed(node, 0) % ROWS}
    if _mixed(node, 1) % 1_000 < 1_000 * (1 / CHOICE - 1):
        picks.add(_mixed(node, 2) % ROWS)
    return sorted(picks)


def _sets(trees: int):
    roots = [(tree, row) for tree in range(trees) for row in _picks(tree)]
    rows = np.array([row for _, row in roots])
    salts = np.array([_mixed(*root) for root in roots], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, a, b, nodes, sketches = [], [], [], [], []
            for shingles in wordhash.shingle_sets(batch.column(2), WIDTH):
                sizes.append(len(shingles))
                a.append(int(shingles.sum(dtype=np.uint64).astype(np.int64)))
                b.append(int(wordhash.mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                low = signature(shingles)
                nodes.append(wordhash.mix(salts ^ low[rows].astype(np.uint64)).astype(np.int64))
                sketches.append(low.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (sizes, a, b)),
                    pa.array(nodes, pa.list_(pa.int64())), pa.array(sketches, pa.binary()),
                ],
                ["id", "text_hash", "n_shingles", "digest_a", "digest_b", "nodes", "sketch"],
            )

    return run


def _children(rows: DataFrame) -> DataFrame:
    """Branch every (id, sketch, node) row: one or two rows of the node's choice, the same for all its documents."""
    pick = lambda k: F.pmod(F.xxhash64(F.lit(k), "node"), F.lit(ROWS)).cast("int")
    second = F.when(F.pmod(F.xxhash64(F.lit(2), "node"), F.lit(1_000)) < int(1_000 * (1 / CHOICE - 1)), pick(1))
    chosen = F.array_compact(F.array_distinct(F.array(pick(0), second)))
    return rows.select("id", "sketch", "node", F.explode(chosen).alias("row")).select(
        "id", F.xxhash64("node", "row", F.substring(F.col("sketch"), F.col("row") + 1, F.lit(1))).alias("node")
    )


class _Links:
    """Spanning links found so far among the documents of a node."""

    def __init__(self, rows: np.ndarray, sizes: np.ndarray) -> None:
        self.rows, self.sizes = rows, sizes
        self.group, self.found = np.arange(len(rows)), []

    def compare(self, one: int, rest: np.ndarray) -> None:
        """Link a document to those of ``rest`` that do not hang together with it yet and whose signatures agree enough."""
        rest = rest[self.group[rest] != self.group[one]]
        rest = rest[np.minimum(self.sizes[one], self.sizes[rest]) * 100 >= SHARE * np.maximum(self.sizes[one], self.sizes[rest])]
        if len(rest):
            rest = rest[(self.rows[rest] == self.rows[one]).sum(axis=1) >= AGREEING]
        for other in rest[np.unique(self.group[rest], return_index=True)[1]].tolist():
            self.found.append((int(one), other))
            self.group[self.group == self.group[other]] = self.group[one]


def node_links(rows: np.ndarray, sizes: np.ndarray, node: int) -> list[tuple[int, int]]:
    """Spanning links among the documents of one node, whose signatures agree enough: the node is branched on until its
    parts are small or deep, and those are compared exhaustively, apart from documents that hang together already."""
    links = _Links(rows, sizes)
    open_ = [(np.arange(len(rows)), node, 0)]
    while open_:
        members, key, depth = open_.pop()
        if len(members) <= SMALL_NODE or depth == DEEPEST_IN_TASK:
            for k in range(len(members) - 1):  # a row of comparisons at a time
                links.compare(members[k], members[k + 1:])
            continue
        for row in _picks(key):
            tokens = rows[members, row]
            order = np.argsort(tokens, kind="stable")
            bounds = np.flatnonzero(np.diff(tokens[order])) + 1
            for part in np.split(order, bounds):
                if len(part) > 1 and (links.group[members[part]] != links.group[members[part[0]]]).any():
                    open_.append((members[part], _mixed(key, row, int(tokens[part[0]])), depth + 1))
    return links.found


def tile_links(rows: np.ndarray, sizes: np.ndarray, left: np.ndarray, alike: np.ndarray) -> list[tuple[int, int]]:
    """Spanning links between the documents marked ``left`` and the others; those marked ``alike`` hang together already."""
    links = _Links(rows, sizes)
    if alike.any():
        links.group[alike] = np.flatnonzero(alike)[0]
    right = np.flatnonzero(~left)
    for one in np.flatnonzero(left).tolist():
        links.compare(one, right)
    return links.found


def _candidate_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links in small nodes, given with their members, and in tiles, whose members are marked."""
    for batch in batches:
        a, b = [], []
        for node, members in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = members.values
            ids, sizes = own.field("id").to_numpy(), own.field("n_shingles").to_numpy()
            rows = np.frombuffer(b"".join(own.field("sketch").to_pylist()), np.uint8).reshape(len(ids), ROWS)
            if own.type.get_field_index("left_side") < 0:
                found = node_links(rows, sizes, node)
            else:
                marks = (own.field(name).to_numpy(zero_copy_only=False) for name in ("left_side", "alike"))
                found = tile_links(rows, sizes, *marks)
            for i, j in found:
                a.append(int(ids[i]))
                b.append(int(ids[j]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _like_the_hub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        matrix = lambda k: np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, ROWS)
        x, y = batch.column(2).to_numpy(), batch.column(5).to_numpy()
        alike = (np.minimum(x, y) * 100 >= SHARE * np.maximum(x, y)) & ((matrix(3) == matrix(6)).sum(axis=1) >= AGREEING)
        names = ["node", "id", "n_shingles", "sketch", "hub", "alike"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(alike)], names)


def _tiles(rows: DataFrame, open_: DataFrame) -> DataFrame:
    """Links of the documents of nodes that are unlike their hub to all others of the node, a slice of either at a time."""
    sliced = open_.select(
        "node", F.ceil(F.col("n_open") / TASK_ROWS).cast("int").alias("rounds"), F.ceil(F.col("n") / TASK_ROWS).cast("int").alias("slices")
    )
    rows = rows.join(families.bounded(sliced), "node")
    spread = lambda column: F.pmod(F.xxhash64("id"), F.col(column)).cast("int")
    every = lambda column: F.explode(F.sequence(F.lit(0), F.col(column) - 1))
    left = rows.where("not alike").withColumn("low", spread("rounds")).withColumn("high", every("slices")).withColumn("left_side", F.lit(True))
    right = rows.withColumn("high", spread("slices")).withColumn("low", every("rounds")).withColumn("left_side", F.lit(False))
    columns = ["node", "low", "high", "id", "n_shingles", "sketch", "left_side", F.col("alike")]
    members = F.collect_list(F.struct("id", "n_shingles", "sketch", "left_side", "alike"))
    tiles = left.select(columns).unionByName(right.select(columns)).groupBy("node", "low", "high").agg(members.alias("members"))
    return tiles.select("node", "members").mapInArrow(_candidate_links, "a bigint, b bigint")


def candidates(sets: DataFrame, level_rows: list[int] | None = None) -> DataFrame:
    """Links (a, b) between documents whose signatures agree enough, spanning what each node's comparisons found.

    ``sets`` has id, n_shingles, nodes and sketch, one row per distinct set. No node is dropped at any depth. ``level_rows`` receives the
    number of node rows of each level.
    """
    level, found = sets.select("id", F.explode("nodes").alias("node")), []
    for depth in range(DEEPEST + 1):
        level = session.stored(level, "nodes")
        if level_rows is not None:
            level_rows.append(level.count())
        sizes = session.stored(level.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "node-sizes")
        small = level.join(sizes.where(F.col("n") <= TASK_ROWS), "node").select("id", "node")
        found.append(
            small.join(sets.select("id", "n_shingles", "sketch"), "id").groupBy("node").agg(
                F.collect_list(F.struct("id", "n_shingles", "sketch")).alias("members")
            ).mapInArrow(_candidate_links, "a bigint, b bigint")
        )
        large = sizes.where(F.col("n") > TASK_ROWS)
        if large.isEmpty():
            break
        rows = level.join(families.bounded(large.select("node")), "node").join(sets.select("id", "n_shingles", "sketch"), "id")
        hubs = rows.groupBy("node").agg(F.min(F.struct("id", "n_shingles", "sketch")).alias("h")).select(
            "node", F.col("h.id").alias("hub"), F.col("h.n_shingles").alias("hub_n"), F.col("h.sketch").alias("hub_sketch")
        )
        compared = session.stored(
            rows.join(families.bounded(session.stored(hubs, "node-hubs"), 100_000), "node").select("node", "id", "n_shingles", "sketch", "hub", "hub_n", "hub_sketch").mapInArrow(
                _like_the_hub, "node bigint, id bigint, n_shingles bigint, sketch binary, hub bigint, alike boolean"
            ), "compared-nodes"
        )
        found.append(compared.where("alike and id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")))
        state = session.stored(
            compared.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("alike")).alias("n_open")), "node-states"
        )
        ends = state if depth == DEEPEST else state.where(F.col("n_open") <= TASK_ROWS)
        found.append(_tiles(compared, ends.where("n_open > 0")))
        if depth == DEEPEST:
            break
        on = state.where(F.col("n_open") > TASK_ROWS)
        if on.isEmpty():
            break
        level = _children(compared.join(families.bounded(on.select("node")), "node"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links.distinct()


def links(texts: DataFrame, reps: DataFrame) -> DataFrame:
    """Confirmed spanning links (a, b) between documents of different sets.

    ``texts`` has id and text, ``reps`` one row per distinct set: id, n_shingles, nodes and sketch.
    """
    found = session.stored(candidates(reps), "candidates")
    ends = found.select(F.col("a").alias("id")).unionByName(found.select(F.col("b").alias("id")))
    support = ends.groupBy("id").agg(F.count(F.lit(1)).alias("support"))
    return families.confirmed_links(texts, reps, found, support, WIDTH, SHARE)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", trees: int = TREES) -> DataFrame:
    """One row per input row: key, n_shingles, component_id (smallest key reachable by links, itself included), kept.

    Two documents are linked when their sets share at least ``SHARE`` per cent of their union; equal sets always are. Null and blank texts have
    no shingles and no links. Rows that share a key are judged each by its own text; where such rows are the first of their
    sets, these sets hang together. A row without a key takes no part: component_id is null, kept is false. An empty table gives no rows. Other columns are not looked at.
    """
    placed = _placed(df, key, text, trees)
    return placed.select(F.col("id").alias(key), "n_shingles", "component_id", "kept")


def _placed(df: DataFrame, key: str, text: str, trees: int) -> DataFrame:
    texts = df.select(F.col(key).cast("bigint").alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    sets = session.stored(texts.mapInArrow(_sets(trees), _SETS), "shingle-sets")
    full = sets.where("n_shingles > 0 and id is not null")
    digest = ["digest_a", "digest_b", "n_shingles"]
    reps = session.stored(
        full.groupBy(*digest).agg(F.min(F.struct("id", "nodes", "sketch")).alias("r")).select(*digest, "r.*"), "distinct-sets"
    )
    linked = session.stored(components(links(texts, reps)), "set-components")
    of_set = reps.join(linked, "id", "left").select(*digest, F.coalesce("component", "id").alias("component"))
    placed = sets.select("id", "text_hash", *digest).join(of_set, digest, "left").select(
        "id", "text_hash", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")
    )
    return placed.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", trees: int = TREES) -> DataFrame:
    """The rows of ``df`` that stay, all columns as they are: one document of each group.

    Rows are judged each by its own text, also where they share a key; of rows that agree in key and text one stays. Rows without a key are compared with
    nothing and all stay, as do rows without words.
    """
    same = ["_key", "_hash"]
    kept = _placed(df, key, text, trees).where("kept").select(F.col("id").alias("_key"), F.col("text_hash").alias("_hash")).distinct()
    rows = df.select(F.struct("*").alias("row"), F.col(key).cast("bigint").alias("_key"), F.xxhash64(text).alias("_hash"))
    # the window is over the columns of the join, so that rows move once for both
    one = F.row_number().over(Window.partitionBy(*same).orderBy("_key"))
    stay = rows.join(kept, same, "left_semi").withColumn("_n", one).where("_n = 1").select("row.*")
    return stay.unionByName(rows.where("_key is null").select("row.*"))
