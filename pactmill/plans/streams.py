"""Registered queries: streamed answers. Each runs a stream to its end and returns what its sink holds.

The source is the whole orders table as a file stream without a file limit, so one micro-batch takes all of it and no
row can be late; the time-outs fire in the batch without data that follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pactmill import session
from pactmill.plans import derive
from pactmill.plans.derive import CHUNKS_SQL, JUDGED_SQL
from pactmill.plans.registry import query, table
from pactmill.streaming import assembly, scoring

# the watermark trails the latest chunk by this much
WATERMARK_S = 10

# every tenth kind of answer loses its final marker: those requests end by time-out, if the watermark gets that far
_TIMED_SQL = f"""
timed AS (SELECT request_id, seq, content, ts, done AND request_id::BIGINT % 10 <> 7 AS done FROM chunks),
grouped AS (SELECT request_id, bool_or(done) AS done, max(ts) AS last_ts,
                   string_agg(content, '' ORDER BY seq) AS answer FROM timed GROUP BY request_id),
clock AS (SELECT max(ts) - INTERVAL {WATERMARK_S} SECOND AS mark FROM timed),
emitted AS (SELECT request_id, CASE WHEN done THEN answer ELSE '' END AS answer,
                   CASE WHEN done THEN 'done' ELSE 'timeout' END AS how
            FROM grouped, clock WHERE done OR last_ts + INTERVAL 120 SECOND < mark)"""


def _chunk_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "orders").schema
    # a pattern, because a file stream takes a folder or a pattern but not the name of a single file
    orders = spark.readStream.schema(schema).parquet(f"{sf_dir}/order[s].parquet")
    chunks = derive.chunks(derive.answers(orders))
    keeps_marker = F.col("request_id").cast("bigint") % 10 != 7
    return chunks.withColumn("done", F.col("done") & keeps_marker)


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.assembled(_chunk_stream(spark, sf_dir), watermark=f"{WATERMARK_S} seconds")


def _assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.scratch_folder(spark, "assembled")
    stream = (
        _answers(spark, sf_dir).writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    )
    stream.awaitTermination()
    return spark.read.schema(assembly.OUTPUT).parquet(f"{folder}/out")


def _scored(spark: SparkSession, sf_dir: str) -> str:
    folder = session.scratch_folder(spark, "scored")
    scoring.start_scoring(_answers(spark, sf_dir), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return folder


@query("t1_stream_assembly", f"WITH {CHUNKS_SQL}, {_TIMED_SQL} SELECT * FROM emitted WHERE how = 'done'")
def t1_stream_assembly(spark, sf_dir):
    return _assembled(spark, sf_dir).where(F.col("how") == "done")


@query("t2_stream_timeouts", f"WITH {CHUNKS_SQL}, {_TIMED_SQL} SELECT * FROM emitted WHERE how <> 'done'")
def t2_stream_timeouts(spark, sf_dir):
    return _assembled(spark, sf_dir).where(F.col("how") != "done")


# requests without a final marker were answered with the empty text
_SCORED_SQL = f"""WITH {CHUNKS_SQL.replace(derive.ANSWERS_SQL, JUDGED_SQL)}, {_TIMED_SQL},
scored AS (
  SELECT e.request_id, e.how,
         CASE WHEN e.how = 'timeout' THEN 'invalid' ELSE j.status END AS status,
         (CASE WHEN e.how = 'timeout' THEN 0 ELSE j.strategy END)::INT AS strategy,
         CASE WHEN e.how = 'timeout' THEN 'endpoint,method,headers,body' ELSE j.missing END AS missing,
         e.how <> 'timeout' AND j.valid AS valid,
         CASE WHEN e.how = 'timeout' THEN 0 ELSE j.score END::DOUBLE AS score
  FROM emitted e JOIN judged j ON j.case_id = e.request_id::BIGINT)"""


@query("t3_stream_scoring", f"{_SCORED_SQL} SELECT * FROM scored")
def t3_stream_scoring(spark, sf_dir):
    folder = _scored(spark, sf_dir)
    rows = spark.read.schema(scoring.SCORED).parquet(f"{folder}/out")
    return rows.select(
        "request_id", "how", "status", "strategy", "missing", "valid", F.round("score", 4).alias("score")
    )


@query("t4_stream_totals", f"""{_SCORED_SQL}
SELECT count(*) FILTER (WHERE valid) AS n_valid, count(*) AS n,
       round(sum(score::DECIMAL(9,4))::DOUBLE / count(*), 6) AS mean_score FROM scored""")
def t4_stream_totals(spark, sf_dir):
    folder = _scored(spark, sf_dir)
    scoring.start_totals(spark, f"{folder}/out", f"{folder}/totals", f"{folder}/checkpoint-totals").awaitTermination()
    return scoring.latest_totals(spark, f"{folder}/totals")
