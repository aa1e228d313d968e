"""Extract JSON from answers, check the contract, score, and summarise a whole run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pactmill import fixed_values as fv, session
from pactmill.functions import contract, jsontext as jx, text as tx
from pactmill.operators import ordering

_FACTS = (*fv.REQUIRED_FIELDS, "error")


def _status(strategy: Column, is_object: Column) -> Column:
    return F.when(strategy == 0, F.lit("invalid")).when(is_object, F.lit("ok")).otherwise(F.lit("not_object"))


def _with_attempt(df: DataFrame, number: int, text: Column) -> DataFrame:
    """Add the text of an attempt, its VARIANT and whether it parsed; a NULL text is not tried."""
    t, v = F.col(f"_t{number}"), F.col(f"_v{number}")
    tried = t.isNotNull()
    rows = df.withColumn(f"_t{number}", text).withColumn(f"_v{number}", F.when(tried, jx.wrapped(t)))
    return rows.withColumn(f"_ok{number}", F.when(tried, jx.is_strict(v, t)).otherwise(False))


def _extract_native(df: DataFrame, raw: str) -> DataFrame:
    text = F.coalesce(F.col(raw), F.lit(""))
    ok = [F.col(f"_ok{i}") for i in (1, 2, 3)]
    rows = _with_attempt(df, 1, tx.strip(text))
    # the same text is not tried again
    rows = _with_attempt(rows, 2, F.when(~ok[0], F.nullif(jx.braces_slice(text), F.col("_t1"))))
    rows = _with_attempt(rows, 3, F.when(~ok[0] & ~ok[1], jx.fenced_block(text)))

    def first_success(name: str) -> Column:
        return F.when(ok[0], F.col(f"_{name}1")).when(ok[1], F.col(f"_{name}2")).when(ok[2], F.col(f"_{name}3"))

    strategy = F.when(ok[0], 1).when(ok[1], 2).when(ok[2], 3).otherwise(0)
    # one cast reads all fields of an object: one holding JSON null is a non-NULL variant, an absent one is NULL
    fields = ", ".join(f"{name} variant" for name in _FACTS)
    rows = rows.select(
        *df.columns, strategy.alias("_strategy"), first_success("t").alias("_text"),
        F.try_variant_get(first_success("v"), "$[0]", f"struct<{fields}>").alias("_f"),
    )
    found = F.struct(
        *[F.col(f"_f.{name}").isNotNull().alias(f"has_{name}") for name in _FACTS],
        *[F.try_variant_get(F.col(f"_f.{name}"), "$", "string").alias(name) for name in ("method", "endpoint")],
    )
    # Behind a generator of one row: Spark moves filters on other columns below it, down to the scan, and leaves those on
    # its output above, where they do not repeat the parsing. What was parsed ends here; only small facts go through.
    outcome = F.struct(F.col("_strategy").alias("strategy"), F.col("_text").alias("json_text"), found.alias("found"))
    rows = rows.select(*df.columns, F.inline(F.array(outcome)))
    is_object = F.coalesce(jx.is_object_text(F.col("json_text")), F.lit(False))
    return rows.select(*df.columns, _status(F.col("strategy"), is_object).alias("status"), "strategy", "json_text", "found")


def _extract_exact(df: DataFrame, raw: str) -> DataFrame:
    text = F.coalesce(F.col(raw), F.lit(""))
    candidates = F.struct(
        tx.strip(text).alias("t1"), jx.braces_slice(text).alias("t2"), jx.fenced_block(text).alias("t3")
    )
    # exploded, so that the Python function gets plain columns: Spark does not run one whose arguments hold lambdas
    rows = df.select("*", F.explode(F.array(candidates)).alias("_c"))
    rows = rows.withColumn("_x", jx.exact_facts(F.col("_c.t1"), F.col("_c.t2"), F.col("_c.t3")))
    is_object = F.col("_x.keys").isNotNull()
    found = F.struct(
        *[(is_object & F.coalesce(F.array_contains("_x.keys", n), F.lit(False))).alias(f"has_{n}") for n in _FACTS],
        F.col("_x.method").alias("method"),
        F.col("_x.endpoint").alias("endpoint"),
    )
    return rows.select(
        *df.columns, _status(F.col("_x.strategy"), is_object).alias("status"), "_x.strategy",
        F.col("_x.t").alias("json_text"), found.alias("found"),
    )


def extract(df: DataFrame, raw: str = "raw", exact: bool = False) -> DataFrame:
    """Find the JSON in a free-text answer: the whole text, else the braces slice, else the fenced block.

    Adds ``status`` (ok, not_object, invalid), ``strategy`` (1, 2, 3, or 0 when nothing parsed), ``json_text`` and the
    struct ``found`` with the presence of each field and the two checked values. ``exact`` reads through Python, which
    also accepts NaN and infinities.
    """
    rows = session.spread(df)
    return _extract_exact(rows, raw) if exact else _extract_native(rows, raw)


def check(extracted: DataFrame) -> DataFrame:
    """Contract result of every extracted answer. An answer without an object misses all fields and scores 0."""
    present = {name: F.col(f"found.has_{name}") for name in fv.REQUIRED_FIELDS}
    return (
        extracted.withColumn("missing", contract.missing_fields(present))
        .withColumn("method_valid", contract.method_valid(F.col("found.method")))
        .withColumn("endpoint_valid", contract.endpoint_valid(F.col("found.endpoint")))
        .withColumn("valid", contract.row_valid(F.col("missing"), F.col("method_valid"), F.col("endpoint_valid")))
        .withColumn("score", contract.score(F.col("missing"), F.col("method_valid"), F.col("endpoint_valid")))
    )


def evaluate(answers: DataFrame, raw: str = "raw", exact: bool = False) -> DataFrame:
    return check(extract(answers, raw, exact))


def displayed(extracted: DataFrame, raw: str = "raw", width: int | None = None) -> DataFrame:
    """What a reader is shown: the JSON when an object was found and it has no ``error`` field, else the raw text."""
    shown = F.col("json_text") if width is None else jx.indented(F.col("json_text"), width)
    show_json = (F.col("status") == "ok") & ~F.col("found.has_error")
    return extracted.withColumn("shown", F.when(show_json, shown).otherwise(F.col(raw)))


def quarantine(extracted: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ("case_id",)) -> DataFrame:
    """Answers without a usable object, with their raw text."""
    return extracted.where(F.col("status") != "ok").select(*keep, "status", F.col(raw).alias("raw"))


def mean_latency(rows: DataFrame, elapsed_ms: str = "elapsed_ms") -> DataFrame:
    """Mean latency in seconds; needs no evaluation, so pass the answers themselves."""
    mean = F.try_divide(F.sum(elapsed_ms), F.count(F.lit(1)) * 1000)
    return rows.agg(F.round(mean, 6).alias("mean_latency_s"))


def summary(evaluated: DataFrame, by: list[str] | None = None, elapsed_ms: str | None = "elapsed_ms") -> DataFrame:
    """Valid cases, total, ratio, mean score, mean latency and verdict; one small partial-aggregated exchange.

    Scores are summed as decimals of four digits and times as whole milliseconds, so the result does not depend on
    the order of the rows. With no rows the means and the verdict are NULL.
    """
    exact_score = F.round("score", 4).cast("decimal(9,4)")
    folds = [
        F.count_if("valid").alias("n_valid"),
        F.count(F.lit(1)).alias("n"),
        F.sum(exact_score).cast("double").alias("_score"),
    ]
    if elapsed_ms:
        folds.append(F.sum(elapsed_ms).alias("_ms"))
    total = evaluated.groupBy(*(by or [])).agg(*folds)
    mean = F.try_divide(F.col("_score"), F.col("n"))
    out = [
        *(by or []), "n_valid", "n",
        F.round(F.try_divide(F.col("n_valid"), F.col("n")), 6).alias("valid_ratio"),
        F.round(mean, 6).alias("mean_score"),
        contract.verdict(mean).alias("verdict"),
    ]
    if elapsed_ms:
        out.append(F.round(F.try_divide(F.col("_ms"), F.col("n") * 1000), 6).alias("mean_latency_s"))
    return total.select(*out)


def detail(rows: DataFrame, key: str = "case_id") -> DataFrame:
    """Rows with their 1-based place by key, stored as a column (``i``) with the total (``n``).

    Number the answers first and evaluate them after: numbering reads the keys several times.
    """
    return ordering.with_position(rows, key, "i", "n")
