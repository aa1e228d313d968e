"""Contract checks on one extracted answer, and the verdict on a mean score."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pactmill import fixed_values as fv


def missing_fields(present: dict[str, Column]) -> Column:
    """Required fields that are absent, in contract order. A field holding null is present."""
    return F.array_remove(
        F.array(*[F.when(present[name], F.lit("")).otherwise(F.lit(name)) for name in fv.REQUIRED_FIELDS]), ""
    )


def method_valid(method: Column) -> Column:
    return F.upper(F.coalesce(method, F.lit(""))).isin(*fv.HTTP_METHODS)


def endpoint_valid(endpoint: Column) -> Column:
    return F.startswith(F.coalesce(endpoint, F.lit("")), F.lit(fv.ENDPOINT_PREFIX))


def row_valid(missing: Column, method_ok: Column, endpoint_ok: Column) -> Column:
    return (F.size(missing) == 0) & method_ok & endpoint_ok


def score(missing: Column, method_ok: Column, endpoint_ok: Column) -> Column:
    """Share of fields present, times 0.8 for each failed check, in this order in doubles."""
    total = F.lit(float(len(fv.REQUIRED_FIELDS)))
    share = (total - F.size(missing)) / total
    return (
        share
        * F.when(method_ok, F.lit(1.0)).otherwise(F.lit(fv.PENALTY))
        * F.when(endpoint_ok, F.lit(1.0)).otherwise(F.lit(fv.PENALTY))
    )


def verdict(mean_score: Column) -> Column:
    """Grade of a mean score; NULL when there is no mean."""
    (top, excellent), (middle, good), (_, rest) = fv.VERDICTS
    return (
        F.when(mean_score >= top, F.lit(excellent))
        .when(mean_score >= middle, F.lit(good))
        .when(mean_score.isNotNull(), F.lit(rest))
    )
