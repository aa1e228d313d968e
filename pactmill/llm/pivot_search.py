"""Exact top-k search by inner product with a pivot-distance index.

Every vector is filed under its nearest pivot and the ring (annulus) of its distance to it. For a query q, a stored x and
a pivot p the triangle inequality gives |d(q,p) - d(x,p)| <= d(q,x), and since 2 q.x = |q|^2 + |x|^2 - d(q,x)^2 this bounds
the score of everything in a ring from above. A query first visits its own ring, which gives it a score that ten vectors reach;
then it visits those rings, in blocks, whose bound is not below that score. Inside a block, rows are sorted by distance, and only the
stretch that the bound allows is looked at. Results are exact for any pivots.

Large rings are cut into blocks, and so are the queries that meet one, so a task holds a bounded number of both. A block is sent
once per ``QUERY_ROWS`` queries that visit it, and not at all if none does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from pactmill import session

PIVOTS = 24
RINGS = 24  # of a pivot; the last one is open-ended
SAMPLE = 4_096  # vectors that pivots and ring widths are chosen from
BLOCK_ROWS = 8_192
QUERY_ROWS = 4_096
BOUNDED_TOGETHER = 64  # queries whose bounds are taken in one task
BLOCKS_BROADCAST = 100_000  # more visited blocks than this are joined by a shuffle instead
SCALE = 1_024
_EXACT = 2.0**52  # sums of products below this are exact in doubles

_INDEX = "id bigint, codes array<bigint>, pivot int, ring int, dist double, norm double"
_HITS = "query_id bigint, vec_id bigint, score bigint"


def quantized(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Id and integer components floor(1024 * x) of the vectors that take part: those with an id, at least one component
    and only finite ones."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(key).isNotNull() & (F.size(vector) > 0) & fine).select(
        F.col(key).cast("bigint").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint")).alias("codes"),
    )


def _matrix(column: pd.Series, width: int = 0) -> np.ndarray:
    """Rows of integers, filled with zeros to a common width."""
    width = max([width, *map(len, column)])
    out = np.zeros((len(column), width), np.int64)
    for i, codes in enumerate(column):
        out[i, :len(codes)] = codes
    return out


def _fill(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1]))) if matrix.shape[1] < width else matrix


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances to every pivot."""
    width = max(rows.shape[1], pivots.shape[1])
    rows, pivots = _fill(rows, width).astype(float), _fill(pivots, width).astype(float)
    return np.stack([np.sqrt(((rows - pivot) ** 2).sum(axis=1)) for pivot in pivots], axis=1)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Far apart: each pivot is the sample vector farthest from those before it."""
    chosen = [0]
    nearest = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _filed(pivots: np.ndarray, width: float):
    """Adds nearest pivot, ring, distance and norm."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = _matrix(frame["codes"], pivots.shape[1])
            far = _distances(rows, pivots)
            pivot = far.argmin(axis=1)
            dist = far[np.arange(len(rows)), pivot]
            norm = np.sqrt((rows.astype(float) ** 2).sum(axis=1))
            ring = np.minimum(dist // width, RINGS - 1).astype(np.int32)
            yield frame.assign(pivot=pivot.astype(np.int32), ring=ring, dist=dist, norm=norm)

    return run


def _upper_bounds(norm: np.ndarray, to_pivot: np.ndarray, low, high, most) -> np.ndarray:
    """Largest possible inner products with anything between ``low`` and ``high`` from the pivot and of norm up to ``most``.
    A little is added for rounding."""
    gap = np.maximum(0.0, np.maximum(low - to_pivot, to_pivot - high))
    bound = (norm**2 + most**2 - gap**2) / 2
    return np.minimum(bound, norm * most) * (1 + 1e-9) + 1.0


def _visits(pivots: np.ndarray, directory: pd.DataFrame):
    """From queries with a score to reach, a row per block to visit."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            rows = _matrix(frame["codes"], pivots.shape[1])
            far = _distances(rows, pivots)
            reach = frame["reach"].to_numpy(float, na_value=-np.inf)
            for d in directory.itertuples():
                bound = _upper_bounds(frame["norm"].to_numpy(), far[:, d.pivot], d.low, d.high, d.most)
                go = bound >= reach
                if go.any():
                    part = frame.loc[go, ["id", "codes", "norm", "reach"]].assign(
                        to_pivot=far[go, d.pivot], pivot=np.int32(d.pivot), ring=np.int32(d.ring)
                    )
                    for block in range(d.blocks):
                        yield part.assign(block=np.int32(block))

    return run


def _block_hits(k: int):
    """The best rows of one block for each query that visits it."""
    def run(_, stored: pd.DataFrame, visiting: pd.DataFrame) -> pd.DataFrame:
        if not len(stored) or not len(visiting):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        stored = stored.sort_values(["dist", "id"], kind="stable")
        x = _matrix(stored["codes"])
        q = _fill(_matrix(visiting["codes"], x.shape[1]), x.shape[1])
        x = _fill(x, q.shape[1])
        ids, dist, most = stored["id"].to_numpy(), stored["dist"].to_numpy(), stored["norm"].to_numpy().max()
        largest = float(np.abs(x).max()) * float(np.abs(q).max()) * x.shape[1]
        if largest < _EXACT:
            x, q = x.astype(float), q.astype(float)
        elif largest >= 2.0**63:  # products may leave 64 bits: Python's integers, as long as the scores themselves fit
            x, q = x.astype(object), q.astype(object)
        norm, reach = visiting["norm"].to_numpy(), visiting["reach"].to_numpy(float, na_value=-np.inf)
        # q.x >= reach needs |dist - to_pivot|^2 <= norm^2 + most^2 - 2 reach
        slack = np.sqrt(np.maximum(0.0, norm**2 + most**2 - 2 * np.where(np.isfinite(reach), reach, 0.0) + 4.0))
        slack = np.where(np.isfinite(reach), slack * (1 + 1e-9) + 1e-6, np.inf)
        to_pivot = visiting["to_pivot"].to_numpy()
        first, last = np.searchsorted(dist, to_pivot - slack), np.searchsorted(dist, to_pivot + slack, "right")
        found: list[list[np.ndarray]] = [[], [], []]
        for i, query_id in enumerate(visiting["id"].to_numpy()):
            a, b = first[i], last[i]
            scores, names = (x[a:b] @ q[i]), ids[a:b]
            scores, names = scores[names != query_id], names[names != query_id]
            if scores.dtype == object:
                if len(scores) and max(map(abs, scores)) >= 1 << 63:
                    raise OverflowError("an inner product does not fit 64 bits")
                scores = scores.astype(np.int64)
            scores, names = scores[scores >= reach[i]], names[scores >= reach[i]]
            if len(scores) > k:  # all that reach the k-th best score, then the smallest ids among ties
                near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
                scores, names = scores[near], names[near]
            order = np.lexsort((names, -scores))[:k]
            found[0].append(np.full(len(order), query_id))
            found[1].append(names[order])
            found[2].append(scores[order].astype(np.int64))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, found))))

    return run


def _searched(index: DataFrame, visits: DataFrame, query_rows: int, k: int) -> DataFrame:
    """Hits of stored visits (id, codes, norm, reach, to_pivot, pivot, ring, block) in their blocks. The visits of a block are dealt
    over groups of about ``query_rows``, to each of which the block is sent."""
    block = ["pivot", "ring", "block"]
    met = visits.groupBy(*block).agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("parts"))
    met = session.stored(met, "visited-blocks")
    met = F.broadcast(met) if met.count() <= BLOCKS_BROADCAST else met
    stored = index.select("id", "codes", "dist", "norm", *block).join(met, block).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ).drop("parts")
    dealt = visits.join(met, block).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
    place = [*block, "part"]
    return stored.groupBy(*place).cogroup(dealt.groupBy(*place)).applyInPandas(_block_hits(k), _HITS)


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    df: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 10, pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """For every row that satisfies ``is_query`` the ``k`` rows with the highest integer inner products: query_id, rank
    (from 1), vec_id, score. Ties go to the smaller id; fewer rows if fewer exist.

    Vectors that are null, empty or hold a null or non-finite component take no part, nor do rows without an id. Vectors
    of different lengths are compared over the components both have. Rows that share an id are all candidates, but not of queries with
    that id; the first of them by components is the query. Components may be as large as scores of 64 bits allow: a score beyond
    them is an error, none is ever wrapped. An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = quantized(df, key, vector)
    sample = rows.orderBy(F.xxhash64("id")).limit(SAMPLE).select("codes").toPandas()  # bounded
    if not len(sample):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    matrix = _matrix(sample["codes"])
    chosen = choose_pivots(matrix, pivots)
    width = float(_distances(matrix, chosen).min(axis=1).max()) / (RINGS - 1) or 1.0
    filed = rows.mapInPandas(_filed(chosen, width), _INDEX)
    stored = session.stored(filed, "pivot-index")
    # at most PIVOTS * RINGS rows
    rings = stored.groupBy("pivot", "ring").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.lit(1)).cast("int").alias("blocks"),
        F.min("dist").alias("low"), F.max("dist").alias("high"), F.max("norm").alias("most"),
    )
    directory = rings.toPandas()
    sizes = F.broadcast(spark.createDataFrame(directory[["pivot", "ring", "blocks"]], "pivot int, ring int, blocks int"))

    def in_blocks(filed: DataFrame) -> DataFrame:
        block = F.pmod(F.xxhash64("id", "dist"), F.col("blocks")).cast("int")
        return filed.join(sizes, ["pivot", "ring"]).withColumn("block", block).drop("blocks")

    index = in_blocks(stored)
    asked = stored.where(is_query(F.col("id"))).groupBy("id").agg(
        F.min(F.struct("codes", "pivot", "ring", "dist", "norm")).alias("q")
    ).select("id", "q.*")
    asked = session.stored(in_blocks(asked), "queries")
    tasks = max(1, math.ceil(asked.count() / BOUNDED_TOGETHER))
    own = asked.withColumn("reach", F.lit(None).cast("double")).withColumnRenamed("dist", "to_pivot")
    # the own block first: its k-th best score is what others have to reach
    near = _best(_searched(index, own, query_rows, k), k).groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) == k, F.min("score").cast("double")).alias("reach")
    )
    ready = session.stored(asked.join(near, asked["id"] == near["query_id"], "left").drop("query_id", "block"), "reached-queries")
    shape = (
        "id bigint, codes array<bigint>, norm double, reach double, to_pivot double, pivot int, ring int, block int"
    )
    visits = session.stored(ready.repartition(tasks).mapInPandas(_visits(chosen, directory), shape), "visits")
    found = _best(_searched(index, visits, query_rows, k), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
