"""Inputs derived from the given tables by string rules, in Spark and, as SQL text, for the independent check.

The tables hold no JSON answers, chunk logs or run metrics, so each is made from a whole table, row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pactmill.plans.registry import table

CHUNK_CHARS = 16
ACTIONS = ["consultar", "crear", "actualizar", "cancelar", "devolver"]


def _call(endpoint: Column, method: str, headers: Column, body: Column | None) -> Column:
    tail = F.lit("}") if body is None else F.concat(F.lit(',"body":'), body, F.lit("}"))
    return F.concat(F.lit('{"endpoint":"'), endpoint, F.lit(f'","method":"{method}","headers":'), headers, tail)


def answers(orders: DataFrame) -> DataFrame:
    """One answer text per order, ten shapes by the last digit of the key: good, wrapped, fenced, faulty, broken."""
    k = F.col("o_orderkey")
    url = F.concat(F.lit("/api/v2/orders/"), k.cast("string"))
    headers = F.concat(F.lit('{"p":"'), F.col("o_orderpriority"), F.lit('"}'))
    body = F.concat(F.lit('{"customer_id":'), F.col("o_custkey").cast("string"), F.lit("}"))
    good = _call(url, "POST", headers, body)
    shapes = [
        good,
        F.concat(F.lit("Answer: "), good, F.lit(" Done.")),
        F.concat(F.lit("```json\n"), good, F.lit("\n```\n note }")),
        _call(url, "POST", headers, None),
        _call(url, "FETCH", headers, body),
        _call(F.concat(F.lit("/v2/orders/"), k.cast("string")), "POST", headers, body),
        _call(url, "post", F.lit("null"), body),
        F.substring(good, 1, F.length(good) - 2),
        F.concat(good, F.lit(" x "), good),
        F.lit("[1,2]"),
    ]
    raw = F.lit(None).cast("string")
    for digit, shape in enumerate(shapes):
        raw = F.when(k % 10 == digit, shape).otherwise(raw)
    kind = F.when(k % 3 == 0, "conocido").when(k % 3 == 1, "nuevo").otherwise("complejo")
    return orders.select(
        k.alias("case_id"), raw.alias("raw"), (k % 5000).alias("elapsed_ms"), kind.alias("kind"),
        F.col("o_orderdate").cast("timestamp").alias("asked_at"),
    )


ANSWERS_SQL = """
g AS (
  SELECT o_orderkey AS k, o_orderdate AS asked_at,
         '{"endpoint":"/api/v2/orders/' || o_orderkey || '","method":"POST","headers":{"p":"' || o_orderpriority
           || '"},"body":{"customer_id":' || o_custkey || '}}' AS good,
         '{"p":"' || o_orderpriority || '"}' AS h, '{"customer_id":' || o_custkey || '}' AS b
  FROM orders),
answers AS (
  SELECT k AS case_id, asked_at, k % 5000 AS elapsed_ms,
         CASE k % 3 WHEN 0 THEN 'conocido' WHEN 1 THEN 'nuevo' ELSE 'complejo' END AS kind,
         CASE k % 10
           WHEN 0 THEN good
           WHEN 1 THEN 'Answer: ' || good || ' Done.'
           WHEN 2 THEN '```json' || chr(10) || good || chr(10) || '```' || chr(10) || ' note }'
           WHEN 3 THEN '{"endpoint":"/api/v2/orders/' || k || '","method":"POST","headers":' || h || '}'
           WHEN 4 THEN replace(good, '"POST"', '"FETCH"')
           WHEN 5 THEN replace(good, '/api/v2/', '/v2/')
           WHEN 6 THEN '{"endpoint":"/api/v2/orders/' || k || '","method":"post","headers":null,"body":' || b || '}'
           WHEN 7 THEN substr(good, 1, length(good) - 2)
           WHEN 8 THEN good || ' x ' || good
           ELSE '[1,2]' END AS raw
  FROM g)"""

# the three attempts, then the checks; JSON validity is the other engine's own
JUDGED_SQL = ANSWERS_SQL + r""",
tries AS (
  SELECT *, regexp_replace(regexp_replace(raw, '^[\t-\r\x1c-\x1f \x{85}\p{Z}]+', ''),
                           '[\t-\r\x1c-\x1f \x{85}\p{Z}]+$', '') AS t1,
         CASE WHEN instr(raw, '{') > 0 AND instr(reverse(raw), '}') > 0
                   AND length(raw) - instr(reverse(raw), '}') + 1 > instr(raw, '{')
              THEN substr(raw, instr(raw, '{'),
                          length(raw) - instr(reverse(raw), '}') + 2 - instr(raw, '{')) END AS t2,
         CASE WHEN instr(raw, '```json') > 0 AND instr(substr(raw, instr(raw, '```json') + 7), '```') > 1
              THEN trim(substr(raw, instr(raw, '```json') + 7,
                               instr(substr(raw, instr(raw, '```json') + 7), '```') - 1),
                        ' ' || chr(9) || chr(10) || chr(13)) END AS t3
  FROM answers),
parsed AS (
  SELECT *, CASE WHEN json_valid(t1) THEN 1 WHEN coalesce(json_valid(t2), false) THEN 2
                 WHEN coalesce(json_valid(t3), false) THEN 3 ELSE 0 END AS strategy
  FROM tries),
found AS (
  SELECT *, CASE strategy WHEN 1 THEN t1 WHEN 2 THEN t2 WHEN 3 THEN t3 END AS json_text FROM parsed),
typed AS (
  SELECT *, CASE WHEN strategy = 0 THEN 'invalid' WHEN json_type(json_text) = 'OBJECT' THEN 'ok'
                 ELSE 'not_object' END AS status,
         CASE WHEN strategy > 0 AND json_type(json_text) = 'OBJECT' THEN json_keys(json_text)
              ELSE CAST([] AS VARCHAR[]) END AS ks
  FROM found),
checked AS (
  SELECT *,
         concat_ws(',', CASE WHEN NOT list_contains(ks, 'endpoint') THEN 'endpoint' END,
                        CASE WHEN NOT list_contains(ks, 'method') THEN 'method' END,
                        CASE WHEN NOT list_contains(ks, 'headers') THEN 'headers' END,
                        CASE WHEN NOT list_contains(ks, 'body') THEN 'body' END) AS missing,
         (NOT list_contains(ks, 'endpoint'))::INT + (NOT list_contains(ks, 'method'))::INT
           + (NOT list_contains(ks, 'headers'))::INT + (NOT list_contains(ks, 'body'))::INT AS n_missing,
         status = 'ok' AND upper(coalesce(json_extract_string(json_text, '$.method'), ''))
           IN ('GET', 'POST', 'PUT', 'PATCH', 'DELETE') AS method_valid,
         status = 'ok' AND starts_with(coalesce(json_extract_string(json_text, '$.endpoint'), ''), '/api/')
           AS endpoint_valid
  FROM typed),
judged AS (
  SELECT *, n_missing = 0 AND method_valid AND endpoint_valid AS valid,
         round(((4 - n_missing)::DOUBLE / 4) * (CASE WHEN method_valid THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END)
               * (CASE WHEN endpoint_valid THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END), 4) AS score
  FROM checked)"""


def chunks(answered: DataFrame) -> DataFrame:
    """Answer texts cut into chunks of 16 characters, one second apart, the last one marked as final."""
    last = F.expr(f"(length(raw) - 1) div {CHUNK_CHARS}")
    rows = answered.select(
        F.col("case_id").cast("string").alias("request_id"), "raw", "asked_at", last.alias("last"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("seq"),
    )
    content = F.call_function("substring", F.col("raw"), (F.col("seq") * CHUNK_CHARS + 1).cast("int"),
                              F.lit(CHUNK_CHARS))
    return rows.select(
        "request_id", "seq", F.timestamp_seconds(F.unix_timestamp("asked_at") + F.col("seq")).alias("ts"),
        content.alias("content"), (F.col("seq") == F.col("last")).alias("done"),
    )


CHUNKS_SQL = ANSWERS_SQL + """,
chunks AS (
  SELECT request_id, seq, asked_at + seq * INTERVAL 1 SECOND AS ts, substr(raw, seq * 16 + 1, 16) AS content,
         seq = n - 1 AS done
  FROM (SELECT case_id::VARCHAR AS request_id, raw, asked_at, (length(raw) + 15) // 16 AS n,
               unnest(range((length(raw) + 15) // 16)) AS seq FROM answers))"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows, keyed by (conv_id, turn). Joined on the full key, so a very
    long conversation spreads over all tasks."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("instruction"))
    replied = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return asked.join(replied, ["conv_id", "turn"])


PAIRS_SQL = """
pairs AS (
  SELECT u.conv_id, u.turn, u.text AS instruction, a.text AS response
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metrics from events: the user is the run, the event the step, the event type gives the metric."""
    metric = (
        F.when(F.col("event_type") == "click", "train_loss").when(F.col("event_type") == "purchase", "train_runtime")
        .otherwise("eval_loss")
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("step"), metric.alias("metric"), "value", "ts"
    )


METRICS_SQL = """
metrics AS (
  SELECT user_id AS run_id, event_id AS step,
         CASE event_type WHEN 'click' THEN 'train_loss' WHEN 'purchase' THEN 'train_runtime' ELSE 'eval_loss' END
           AS metric, value, ts
  FROM events)"""
