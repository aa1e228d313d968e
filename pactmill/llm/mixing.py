"""Mixing sources to target weights by hash-threshold histograms.

Sizes are summed by source and hash bucket. Running sums over the buckets of a source show in which bucket its budget ends;
only that bucket is looked at again, by the next bits of the hash, until a single row is left at the boundary. Documents
are then taken by comparing their hash with the source's threshold; nothing is sorted. Thresholds are nested: a larger
budget takes all that a smaller one takes.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pactmill import session
from pactmill.llm import wordhash

WEIGHTS = (5, 2, 1)  # by source in code-point order, repeating
MOST_PASSES = 3  # of any document
HASH_BITS = 60
LEVEL_BITS = 12
SOURCES_BROADCAST = 100_000  # more sources than this are joined by a shuffle instead


@F.arrow_udf(T.LongType())
def _words(text: pa.Array) -> pa.Array:
    return pa.array(wordhash.count_words(text), pa.int64())


def key_hash(key: Column, seed: int) -> Column:
    """The first 60 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)))), 1, 15), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """The target of every source from its size (``source``, ``source_size``).

    All sizes together are shared by weight; a source whose share would exceed ``most`` times its size stops there, and
    the excess is shared among the others until none is above. Sources are ordered by that limit per unit of weight:
    those up to some place stop at their limit, the others get the rest by weight. Windows run over one row per source.
    """
    ranked = sizes.withColumn("_i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.get(F.array(*[F.lit(w).cast("bigint") for w in weights]), F.pmod("_i", F.lit(len(weights))).cast("int"))
    limited = ranked.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * most).withColumn(
        "_ratio", F.col("_cap").cast("double") / F.col("_w")
    )
    by_ratio = Window.orderBy("_ratio", "_i")
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    rest = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    level = limited.withColumn("_level", rest.cast("double") / F.sum("_w").over(after))
    # the first place whose level stays below its own limit sets the level for all from there on
    place = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_i", "_level"))
    return level.withColumn("_settled", F.min(place).over(Window.partitionBy())["_level"]).select(
        "source", "source_size",
        F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_settled"), F.lit(0.0)) * F.col("_w")).alias("target"),
    )


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SOURCES_BROADCAST else df


def thresholds(sized: DataFrame, budgets: DataFrame, n_sources: int, levels: list[str]) -> DataFrame:
    """Per source the last hash still taken in full (``cut``), found level by level, as nested cells.

    ``sized`` has source_no, size and the cell columns ``levels``; ``budgets`` has source_no and budget. Each round sums
    sizes by cell within the open sources, keeps the cell in which the budget ends, and looks only into that one.
    Returns source_no, path (array of boundary cells) and extra (whether the boundary row itself is taken: it is when
    that comes nearer to the budget).
    """
    open_ = budgets.select("source_no", F.col("budget").alias("left"), F.array().cast("array<bigint>").alias("path"))
    rows, done = sized, []
    for cell in levels:
        open_ = session.stored(open_, "open-budgets")
        sums = rows.groupBy("source_no", F.col(cell).alias("cell")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")
        )
        upto = Window.partitionBy("source_no").orderBy("cell")
        running = sums.join(_bounded(open_, n_sources), "source_no").withColumn("end", F.sum("size").over(upto))
        boundary = running.where("end > left").groupBy("source_no").agg(
            F.min_by(F.struct("cell", "size", "n", "left", "path", (F.col("end") - F.col("size")).alias("before")), "cell")
            .alias("b")
        ).select(
            "source_no", "b.cell", "b.size", "b.n", (F.col("b.left") - F.col("b.before")).alias("left"),
            F.concat("b.path", F.array("b.cell")).alias("path"),
        )
        boundary = session.stored(boundary, "boundary-cells")
        single = boundary.where("n = 1" if cell != levels[-1] else "true").select(
            "source_no", "path", (F.col("size") - F.col("left") < F.col("left")).alias("extra")
        )
        done.append(single)
        open_ = boundary.where("n > 1").select("source_no", "left", "path", "cell")
        if cell == levels[-1] or open_.isEmpty():
            break
        rows = rows.join(
            _bounded(open_.select("source_no", F.col("cell").alias(cell)), n_sources), ["source_no", cell]
        )
        open_ = open_.drop("cell")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


def mixed(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0,
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES, whole_rows: bool = False,
) -> DataFrame:
    """One row per input row: key (or, with ``whole_rows``, all its columns as a struct ``row``), size, source_size, target
    and taken.

    ``size`` counts the words of the whole text, none for null. A source is taken in whole passes plus, by hash, those
    documents that fill up the rest of its target; the document at the boundary is taken if that comes nearer to the
    target. No document is taken more than ``most`` times. Rows without words take nothing. Rows that share a key, or have none, are
    taken in the order of a hash of their texts, so that reruns agree however the rows are dealt out; rows with the same key and
    text are interchangeable: which of them is taken does not show. An empty table gives no rows.
    """
    spark = df.sparkSession
    own = key_hash(F.col(key), seed)
    narrowed = lambda *parts: F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1 << HASH_BITS))
    rows = session.stored(
        df.select(
            (F.struct("*") if whole_rows else F.col(key)).alias("row"), F.col(source).alias("source"), _words(F.col(text)).alias("size"),
            F.coalesce(own, F.lit(0)).alias("hash"), narrowed(F.col(text)).alias("tie"),
            narrowed(F.monotonically_increasing_id()).alias("place"),  # only tells rows that agree in key and text apart
        ),
        "document-sizes",
    )
    by_source = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    by_source = session.stored(by_source.withColumn("source_no", F.monotonically_increasing_id()), "source-targets")
    n_sources = by_source.count()
    budgets = by_source.where("source_size > 0").select(
        "source_no", F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most)).alias("passes"),
        (F.col("target") - F.col("source_size") * F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most)))
        .alias("budget"),
    )
    joined = rows.join(
        _bounded(by_source.withColumnRenamed("source", "_source"), n_sources), F.col("source").eqNullSafe(F.col("_source"))
    )
    shifts = range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS)
    parts = ("hash", "tie", "place")
    names = [f"c{i}" for i in range(len(parts) * len(shifts))]
    cells = {
        name: F.shiftright(F.col(part), shift).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))
        for name, (part, shift) in zip(names, [(p, s) for p in parts for s in shifts])
    }
    sized = joined.where("size > 0").select("source_no", "size", *[c.alias(n) for n, c in cells.items()])
    cut = thresholds(sized, budgets.select("source_no", "budget"), n_sources, names)
    plan = budgets.join(cut, "source_no", "left")
    place = F.array(*cells.values())
    first = F.slice(place, 1, F.size("path"))
    extra = F.when(first < F.col("path"), 1).when((first == F.col("path")) & F.col("extra"), 1).otherwise(0)
    taken = joined.join(_bounded(plan, n_sources), "source_no", "left")
    return taken.select(
        F.col("row").alias("row" if whole_rows else key), "size", "source_size", "target",
        (F.col("size") * (F.coalesce("passes", F.lit(0)) + F.when(F.col("path").isNull(), 0).otherwise(extra)))
        .cast("bigint").alias("taken"),
    )


def mixture(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """The rows of the mix with all columns of ``df``, a row as often as it is taken."""
    found = mixed(df, key, text, source, seed, whole_rows=True).where("taken > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1), F.expr("taken div size").cast("int")))).select("row.*")
