"""Token caps and sequence packing over the proxy tokens of a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pactmill import fixed_values as fv, session
from pactmill.functions import text as tx
from pactmill.operators import ordering


def cap_tokens(df: DataFrame, text: str = "text", cap: int = fv.MAX_SEQ_LENGTH) -> DataFrame:
    """Add the token count, the capped text and whether anything was cut."""
    return (
        session.spread(df).withColumn("n_tokens", tx.token_count(F.col(text)))
        .withColumn("capped_text", F.when(F.col("n_tokens") > cap, tx.capped(F.col(text), cap)).otherwise(F.col(text)))
        .withColumn("truncated", F.col("n_tokens") > cap)
    )


def _starts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key, token count and global start of every row that has tokens. The texts are read once for it: the counts are
    stored and all numbering runs on that narrow table."""
    counted = session.stored(session.spread(df.select(key, text)).select(key, tx.token_count(F.col(text)).alias("n_tokens")), "token-counts")
    return ordering.with_running_start(counted, key, F.col("n_tokens"), "start").where("n_tokens > 0")


def pack_plan(df: DataFrame, key: str, text: str = "text", cap: int = fv.MAX_SEQ_LENGTH) -> DataFrame:
    """Lay all token sequences end to end in key order and cut them into blocks of ``cap`` tokens.

    One row per (row, block) piece: where the piece starts in its row, where it lands in the block, how long it is.
    Only the key and the token count are shuffled; a row's pieces need nothing but its own start.
    """
    placed = _starts(df, key, text)
    blocks = F.expr(f"sequence(start div {cap}, (start + n_tokens - 1) div {cap})")
    first = F.greatest(F.col("start"), F.col("block") * cap)
    last = F.least(F.col("start") + F.col("n_tokens"), (F.col("block") + 1) * cap)
    return placed.withColumn("block", F.explode(blocks)).select(
        "block",
        key,
        (first - F.col("start")).alias("row_offset"),
        (first - F.col("block") * cap).alias("block_offset"),
        (last - first).alias("length"),
    )


def pack(df: DataFrame, key: str, text: str = "text", cap: int = fv.MAX_SEQ_LENGTH) -> DataFrame:
    """The packed blocks themselves: tokens joined by single spaces, exactly ``cap`` tokens except in the last block.

    Each row is cut into its pieces before the explode, so the moved text stays as long as the input, and a block
    collects at most ``cap`` tokens.
    """
    starts = _starts(df, key, text).drop("n_tokens")
    # the texts are joined, not their tokens, which take several times the room
    rows = df.select(key, F.col(text).alias("text")).join(starts, key).withColumn("tokens", tx.tokens(F.col("text")))
    # piece b of a row: tokens [max(start, b*cap), min(start+n, (b+1)*cap) ) in global positions
    pieces = F.expr(
        f"""transform(sequence(start div {cap}, (start + size(tokens) - 1) div {cap}), b -> struct(
              b as block,
              greatest(start, b * {cap}) - b * {cap} as at,
              array_join(slice(tokens,
                               cast(greatest(start, b * {cap}) - start + 1 as int),
                               cast(least(start + size(tokens), (b + 1) * {cap}) - greatest(start, b * {cap}) as int)),
                         ' ') as piece))"""
    )
    return (
        rows.select(F.explode(pieces).alias("p"))
        .select("p.*")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"))
        .select("block", F.array_join(F.col("pieces.piece"), " ").alias("text"))
    )
