"""Corpus building: layouts to messages, turns to conversations, generated examples, size rules, prompt drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pactmill import fixed_values as fv, session
from pactmill.functions import chat, jsontext as jx, text as tx

PART_ROWS = 65_536


def adapt(df: DataFrame, mapping: dict[str, str], key: list[str]) -> DataFrame:
    """Turn another column layout into ``messages``.

    ``mapping`` names the columns that hold ``instruction`` and ``response``, and optionally ``input`` (appended to
    the instruction after a blank line when it is not empty) and ``system``.
    """
    unknown = set(mapping) - {"instruction", "input", "response", "system"}
    absent = [c for c in mapping.values() if c not in df.columns]
    if unknown or absent or not {"instruction", "response"} <= set(mapping):
        raise ValueError(f"cannot map this layout: mapping {mapping}, columns {df.columns}")
    instruction = F.col(mapping["instruction"])
    if "input" in mapping:
        extra = F.coalesce(F.col(mapping["input"]), F.lit(""))
        instruction = F.when(extra == "", instruction).otherwise(F.concat(instruction, F.lit("\n\n"), extra))
    system = None
    if "system" in mapping:
        system = F.coalesce(F.col(mapping["system"]), F.lit(fv.SYSTEM_PROMPT))
    return df.select(*key, chat.example(instruction, F.col(mapping["response"]), system).alias("messages"))


def conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Turns to ordered messages, one row per conversation.

    Turns are gathered and sorted in parts of ``part_rows``, and the parts of a conversation are then put in a row. Only a conversation
    that does not fit in one value (2 GB) fails, as it must.
    """
    part = F.expr(f"{turn} div {part_rows}").alias("part")
    gathered = F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"),
                                                    F.col(text).alias("content"))))
    return (
        turns.groupBy(conv, part)
        .agg(gathered.alias("turns"))
        .groupBy(conv)
        .agg(F.sort_array(F.collect_list(F.struct("part", "turns"))).alias("parts"))
        .select(conv, F.flatten("parts.turns").alias("turns"))
        .select(conv, F.transform("turns", lambda t: F.struct(t["role"], t["content"])).alias("messages"))
    )


def action_grid(categories: DataFrame, column: str, actions: list[str]) -> DataFrame:
    """Every category with every action. ``actions`` is a parameter list of any length."""
    listed = F.array(*[F.lit(action) for action in actions]).cast("array<string>")
    named = categories.select(F.col(column).alias("category")).distinct()
    return named.select("category", F.explode(listed).alias("action"))


def generated_pairs(df: DataFrame, raw: str) -> DataFrame:
    """Read generated examples ``{instruccion, llamada_api}``; the text must be exactly one JSON object.

    The instruction is the value as a string; the response is the JSON text of the call as it is written. Of repeated keys
    the last counts, for both. Rows without an instruction or a call, or with a null one, keep their raw text and get ``parsed = false``.
    """
    text = F.col("_t")
    rows = session.spread(df).withColumn("_t", tx.strip(F.col(raw))).withColumn("_v", jx.wrapped(text))
    usable = jx.is_strict(F.col("_v"), text) & jx.is_object_text(text)
    rows = rows.withColumn("_i", F.when(usable, F.try_variant_get("_v", "$[0].instruccion", "string")))
    # from the text, which keeps the order of the keys
    call = F.when(F.col("_i").isNotNull(), jx.top_level_value(text, "llamada_api"))
    rows = rows.withColumn("_c", call).withColumn("_r", F.when(F.col("_c") != "null", F.col("_c")))
    parsed = F.col("_r").isNotNull()
    return rows.select(
        *df.columns, parsed.alias("parsed"), F.when(parsed, F.col("_i")).alias("instruction"),
        F.col("_r").alias("response"),
    )


def corpus_sizes(df: DataFrame, corpus: str) -> DataFrame:
    return df.groupBy(F.col(corpus).alias("corpus")).agg(F.count(F.lit(1)).alias("n"))


def minimum_gate(df: DataFrame, corpus: str, minimum: int = fv.MIN_CORPUS) -> DataFrame:
    """Pass or fail per corpus: at least ``minimum`` examples."""
    return corpus_sizes(df, corpus).withColumn("passed", F.col("n") >= minimum)


def bands(spark) -> DataFrame:
    return spark.createDataFrame(
        list(fv.SETTINGS_BANDS), "lo bigint, hi bigint, rank int, alpha int, dropout double, epochs int"
    )


def with_settings(sizes: DataFrame, n: str = "n") -> DataFrame:
    """Attach the training settings of the band each corpus size falls into. The band table has four rows."""
    table = bands(sizes.sparkSession)
    in_band = (F.col(n) >= table["lo"]) & (table["hi"].isNull() | (F.col(n) < table["hi"]))
    return sizes.join(F.broadcast(table), in_band, "left").drop("lo", "hi")


def prompt_drift(examples: DataFrame, system: Column, expected: list[str]) -> DataFrame:
    """Prompts that are not expected, and missing ones (NULL), with the number of examples that use each.

    Examples are counted per prompt before anything else, so a prompt shared by most rows costs one row per task.
    """
    spark = examples.sparkSession
    # a parameter list, held in the plan
    known = spark.createDataFrame([(p,) for p in expected], "prompt string")
    used = examples.groupBy(system.alias("prompt")).agg(F.count(F.lit(1)).alias("n"))
    return used.join(F.broadcast(known), "prompt", "left_anti")
