"""Exact train / eval splits. Rows are labelled in place: finding the cut moves counts, never rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pactmill import fixed_values as fv
from pactmill.operators import ordering

TRAIN, EVAL = "train", "eval"


def _label(in_first: Column, first: str, rest: str) -> Column:
    return F.when(in_first, F.lit(first)).otherwise(F.lit(rest))


def positional(df: DataFrame, key: str, tenths: int = 8, out: str = "split") -> DataFrame:
    """The first ``int(n * tenths / 10)`` rows by a unique integer key are train, the others eval."""
    cut = ordering.key_cut(df, key, df.count() * tenths // 10)
    return df.withColumn(out, _label(F.lit(False) if cut is None else F.col(key) <= cut, TRAIN, EVAL))


def seeded(df: DataFrame, *keys: str, seed: int = fv.SPLIT_SEED, out: str = "split") -> DataFrame:
    """A repeatable random split of exact size: the first ``ceil(n / 10)`` rows by md5 of key and seed are eval.

    The label of a row depends on its key, the seed and one cut-off only, so it survives any repartitioning.
    """
    hashed = ordering.digest(*[F.col(k) for k in keys], F.lit(seed))
    cut = ordering.hex_cut(df, hashed, -(-df.count() // 10))
    inside = F.lit(False) if cut is None else F.substring(hashed, 1, len(cut)) <= cut
    return df.withColumn(out, _label(inside, EVAL, TRAIN))


def sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """Row count per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
