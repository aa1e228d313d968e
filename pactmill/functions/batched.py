"""Lifting a function over column batches to a Spark column, for what no built-in expression covers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def with_batched(
    df: DataFrame, fn: Callable[[dict[str, pd.Series]], pd.Series], inputs: list[str], out: str, out_type: str
) -> DataFrame:
    """Add ``out`` computed by ``fn`` from a dictionary of column batches, in Arrow batches inside the tasks."""
    names = list(inputs)

    @F.pandas_udf(out_type)
    def run(*columns: pd.Series) -> pd.Series:
        return fn(dict(zip(names, columns)))

    applied: Column = run(*[F.col(name) for name in names])
    return df.withColumn(out, applied)
