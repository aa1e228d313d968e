"""Reading corpora, chunks and evaluation cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pactmill import fixed_values as fv
from pactmill.functions import chat

CHUNK_SCHEMA = (
    "request_id string, seq bigint, ts timestamp, message struct<content: string>, done boolean, "
    "_corrupt_record string"
)
CASE_SCHEMA = "case_id bigint, description string, instruction string, kind string"


def corpus(
    spark: SparkSession, path: str, fmt: str = "parquet", split: str | None = None, schema: str | None = None,
    split_column: str = "split", **options: str,
) -> DataFrame:
    """An external corpus in parquet, JSON lines, CSV or ORC. ``split`` keeps one named split (a partition filter
    where the corpus was written with :func:`pactmill.sources.sinks.write_corpus`)."""
    reader = spark.read.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    rows = reader.load(path)
    return rows if split is None else rows.where(F.col(split_column) == split)


def in_memory(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """Rows from the program, with an explicit schema."""
    return spark.createDataFrame(rows, schema)


def built_in_pairs(spark: SparkSession) -> DataFrame:
    rows = [(i, *pair) for i, pair in enumerate(fv.DEMO_PAIRS, 1)]
    return in_memory(spark, rows, "ex_id bigint, instruction string, response string")


def choose(spark: SparkSession, built_in: bool = True, path: str | None = None, **how) -> DataFrame:
    """The built-in examples or an external corpus, as rows with ``messages``."""
    if built_in:
        pairs = built_in_pairs(spark)
        return pairs.select("ex_id", chat.example(F.col("instruction"), F.col("response")).alias("messages"))
    if not path:
        raise ValueError("an external corpus needs a path")
    rows = corpus(spark, path, **how)
    if "messages" not in rows.columns:
        raise ValueError("the corpus has no messages column; map it with operators.corpus.adapt first")
    return rows


def cases(spark: SparkSession, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Evaluation cases from a table, or the five built-in ones."""
    if path is None:
        return in_memory(spark, list(fv.DEMO_CASES), CASE_SCHEMA)
    return spark.read.schema(CASE_SCHEMA).format(fmt).load(path)


def _flat_chunks(rows: DataFrame) -> DataFrame:
    return rows.select(
        "request_id", "seq", "ts", F.col("message.content").alias("content"),
        F.coalesce("done", F.lit(False)).alias("done"), "_corrupt_record",
    )


def chunk_lines(spark: SparkSession, path: str) -> DataFrame:
    """Answer chunks from JSON lines. Blank lines are skipped; a line that does not parse keeps its text in
    ``_corrupt_record``."""
    return _flat_chunks(
        spark.read.schema(CHUNK_SCHEMA).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    )


def chunk_line_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same lines as a stream over the files of a folder."""
    reader = spark.readStream.schema(CHUNK_SCHEMA).option("columnNameOfCorruptRecord", "_corrupt_record")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _flat_chunks(reader.json(path))
