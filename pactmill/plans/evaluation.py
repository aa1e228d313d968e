"""Registered queries: JSON extraction, contract checks, joins and summaries of evaluation runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pactmill.functions import jsontext as jx, text as tx
from pactmill.operators import answers as an, evaluation as ev
from pactmill.plans import derive
from pactmill.plans.derive import ANSWERS_SQL, CHUNKS_SQL, JUDGED_SQL
from pactmill.plans.registry import query, table
from pactmill.sources import readers
from pactmill import session


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.answers(table(spark, sf_dir, "orders"))


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.evaluate(_answers(spark, sf_dir))


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("missing", F.array_join("missing", ","))


@query("score_answers", f"""WITH {JUDGED_SQL}
SELECT case_id, status, strategy::INT AS strategy, missing, method_valid, endpoint_valid, valid, score FROM judged""")
def score_answers(spark, sf_dir):
    return _joined(_evaluated(spark, sf_dir)).select(
        "case_id", "status", "strategy", "missing", "method_valid", "endpoint_valid", "valid",
        F.round("score", 4).alias("score"),
    )


@query("evaluation_summary", f"""WITH {JUDGED_SQL}
SELECT count(*) FILTER (WHERE valid) AS n_valid, count(*) AS n,
       round(count(*) FILTER (WHERE valid) / count(*), 6) AS valid_ratio,
       round(sum(score::DECIMAL(9,4))::DOUBLE / count(*), 6) AS mean_score,
       CASE WHEN sum(score::DECIMAL(9,4))::DOUBLE / count(*) >= 0.9 THEN 'excellent'
            WHEN sum(score::DECIMAL(9,4))::DOUBLE / count(*) >= 0.7 THEN 'good' ELSE 'improvable' END AS verdict,
       round(sum(elapsed_ms)::DOUBLE / (count(*) * 1000), 6) AS mean_latency_s
FROM judged""")
def evaluation_summary(spark, sf_dir):
    return ev.summary(_evaluated(spark, sf_dir))


@query("j1_strict_parse", f"""WITH {JUDGED_SQL}
SELECT case_id, json_valid(t1) AS strict FROM judged""")
def j1_strict_parse(spark, sf_dir):
    rows = _answers(spark, sf_dir).select("case_id", tx.strip(F.col("raw")).alias("t"))
    return rows.select("case_id", jx.strict_json(F.col("t")).alias("strict"))


@query("j2_braces_slice", f"""WITH {JUDGED_SQL}
SELECT case_id, t2 AS slice, coalesce(json_valid(t2), false) AS strict FROM judged""")
def j2_braces_slice(spark, sf_dir):
    rows = _answers(spark, sf_dir).select("case_id", jx.braces_slice(F.col("raw")).alias("slice"))
    return rows.select("case_id", "slice", jx.strict_json(F.col("slice")).alias("strict"))


@query("j3_fenced_block", f"""WITH {JUDGED_SQL}
SELECT case_id, t3 AS block, coalesce(json_valid(t3), false) AS strict FROM judged""")
def j3_fenced_block(spark, sf_dir):
    rows = _answers(spark, sf_dir).select("case_id", jx.fenced_block(F.col("raw")).alias("block"))
    return rows.select("case_id", "block", jx.strict_json(F.col("block")).alias("strict"))


@query("j4_first_success", f"""WITH {JUDGED_SQL}
SELECT case_id, status, strategy::INT AS strategy, json_text, raw FROM judged""")
def j4_first_success(spark, sf_dir):
    return ev.extract(_answers(spark, sf_dir)).select("case_id", "status", "strategy", "json_text", "raw")


@query("j5_displayed", f"""WITH {JUDGED_SQL}
SELECT case_id, CASE WHEN status = 'ok' AND NOT list_contains(ks, 'error') THEN json_text ELSE raw END AS shown
FROM judged""")
def j5_displayed(spark, sf_dir):
    return ev.displayed(ev.extract(_answers(spark, sf_dir))).select("case_id", "shown")


# the answers are compact calls, so their layout in lines follows from a few replacements
_LAID_OUT = r"""replace(replace(replace(replace(replace(replace(replace(json_text, '{"endpoint":', '{' || chr(10) || '    "endpoint": '),
    ',"method":', ',' || chr(10) || '    "method": '), ',"headers":', ',' || chr(10) || '    "headers": '),
    ',"body":', ',' || chr(10) || '    "body": '), '{"p":', '{' || chr(10) || '        "p": '),
    '{"customer_id":', '{' || chr(10) || '        "customer_id": '), '}', chr(10) || '}')"""


@query("j5_displayed_layout", rf"""WITH {JUDGED_SQL},
t AS (SELECT case_id, raw, status = 'ok' AND NOT list_contains(ks, 'error') AS laid, {_LAID_OUT} AS text FROM judged)
SELECT case_id, CASE WHEN laid THEN regexp_replace(regexp_replace(text, chr(10) || '}}([,' || chr(10) || '])', chr(10) || '    }}\1', 'g'),
                                                   chr(10) || '    }}$', chr(10) || '}}') ELSE raw END AS shown FROM t""")
def j5_displayed_layout(spark, sf_dir):
    return ev.displayed(ev.extract(_answers(spark, sf_dir)), width=4).select("case_id", "shown")


@query("c1_missing_fields", f"""WITH {JUDGED_SQL}
SELECT case_id, missing, n_missing::BIGINT AS n_missing FROM judged""")
def c1_missing_fields(spark, sf_dir):
    rows = _evaluated(spark, sf_dir).select("case_id", "missing")
    return _joined(rows.withColumn("n_missing", F.size("missing").cast("bigint")))


@query("c2_method_valid", f"""WITH {JUDGED_SQL} SELECT case_id, method_valid FROM judged""")
def c2_method_valid(spark, sf_dir):
    return _evaluated(spark, sf_dir).select("case_id", "method_valid")


@query("c3_endpoint_valid", f"""WITH {JUDGED_SQL} SELECT case_id, endpoint_valid FROM judged""")
def c3_endpoint_valid(spark, sf_dir):
    return _evaluated(spark, sf_dir).select("case_id", "endpoint_valid")


@query("c4_row_valid", f"""WITH {JUDGED_SQL} SELECT case_id, valid FROM judged""")
def c4_row_valid(spark, sf_dir):
    return _evaluated(spark, sf_dir).select("case_id", "valid")


@query("c5_score", f"""WITH {JUDGED_SQL} SELECT case_id, score FROM judged""")
def c5_score(spark, sf_dir):
    return _evaluated(spark, sf_dir).select("case_id", F.round("score", 4).alias("score"))


@query("e3_quarantine", f"""WITH {JUDGED_SQL} SELECT case_id, status, raw FROM judged WHERE status <> 'ok'""")
def e3_quarantine(spark, sf_dir):
    return ev.quarantine(ev.extract(_answers(spark, sf_dir)))


@query("a2_valid_cases", f"""WITH {JUDGED_SQL}
SELECT kind, count(*) FILTER (WHERE valid) AS n_valid, count(*) AS n,
       round(count(*) FILTER (WHERE valid) / count(*), 6) AS valid_ratio FROM judged GROUP BY kind""")
def a2_valid_cases(spark, sf_dir):
    return ev.summary(_evaluated(spark, sf_dir), by=["kind"]).select("kind", "n_valid", "n", "valid_ratio")


@query("a3_mean_score", f"""WITH {JUDGED_SQL}
SELECT round(sum(score::DECIMAL(9,4))::DOUBLE / count(*), 6) AS mean_score FROM judged""")
def a3_mean_score(spark, sf_dir):
    return ev.summary(_evaluated(spark, sf_dir)).select("mean_score")


@query("a4_mean_latency", f"""WITH {ANSWERS_SQL}
SELECT round(sum(elapsed_ms)::DOUBLE / (count(*) * 1000), 6) AS mean_latency_s FROM answers""")
def a4_mean_latency(spark, sf_dir):
    return ev.mean_latency(_answers(spark, sf_dir))


@query("a5_verdict", f"""WITH {JUDGED_SQL},
m AS (SELECT status, sum(score::DECIMAL(9,4))::DOUBLE / count(*) AS x FROM judged GROUP BY status)
SELECT status, CASE WHEN x >= 0.9 THEN 'excellent' WHEN x >= 0.7 THEN 'good' ELSE 'improvable' END AS verdict
FROM m""")
def a5_verdict(spark, sf_dir):
    return ev.summary(_evaluated(spark, sf_dir), by=["status"]).select("status", "verdict")


@query("w3_case_detail", f"""WITH {JUDGED_SQL}
SELECT row_number() OVER (ORDER BY case_id) AS i, count(*) OVER () AS n, case_id, kind, valid, score FROM judged""")
def w3_case_detail(spark, sf_dir):
    numbered = ev.detail(_answers(spark, sf_dir))
    return ev.evaluate(numbered).select("i", "n", "case_id", "kind", "valid", F.round("score", 4).alias("score"))


@query("n1_pair_cases", f"""WITH {ANSWERS_SQL},
given AS (SELECT case_id, raw, elapsed_ms FROM answers WHERE case_id % 11 <> 0)
SELECT c.case_id, c.kind, coalesce(g.raw, '') AS raw, g.elapsed_ms
FROM answers c LEFT JOIN given g ON g.case_id = c.case_id""")
def n1_pair_cases(spark, sf_dir):
    every = _answers(spark, sf_dir)
    cases = every.select("case_id", "kind")
    given = every.where(F.col("case_id") % 11 != 0).select("case_id", "raw", "elapsed_ms")
    return an.pair_with_cases(cases, given).select("case_id", "kind", "raw", "elapsed_ms")


@query("a7_assemble_chunks", f"""WITH {CHUNKS_SQL}
SELECT request_id, string_agg(content, '' ORDER BY seq) AS answer
FROM chunks GROUP BY request_id""")
def a7_assemble_chunks(spark, sf_dir):
    return an.assemble(derive.chunks(_answers(spark, sf_dir)))


@query("s4_chunk_lines", f"""WITH {CHUNKS_SQL}
SELECT request_id, seq, content, done, false AS corrupt FROM chunks
UNION ALL
SELECT NULL, NULL, NULL, false, true FROM answers WHERE case_id % 10 = 8""")
def s4_chunk_lines(spark, sf_dir):
    """Chunk lines written as text, with blank lines and lines cut short among them, and read back."""
    rows = _answers(spark, sf_dir)
    lines = derive.chunks(rows).select(
        F.to_json(F.struct("request_id", "seq", "ts", F.struct("content").alias("message"), "done")).alias("value")
    )
    noise = rows.where(F.col("case_id") % 10 >= 8).select(
        F.when(F.col("case_id") % 10 == 8, '{"request_id":"7","se').otherwise("").alias("value")
    )
    folder = session.scratch_folder(spark, "chunk-lines")
    lines.unionByName(noise).write.text(folder)
    return readers.chunk_lines(spark, folder).select(
        "request_id", "seq", "content", "done", F.col("_corrupt_record").isNotNull().alias("corrupt")
    )


@query("s5_case_table", """
SELECT o_orderkey AS case_id, o_orderpriority AS description,
       'Pedido ' || o_orderkey || ' del cliente ' || o_custkey AS instruction,
       CASE o_orderkey % 3 WHEN 0 THEN 'conocido' WHEN 1 THEN 'nuevo' ELSE 'complejo' END AS kind
FROM orders""")
def s5_case_table(spark, sf_dir):
    folder = session.scratch_folder(spark, "cases")
    _cases(spark, sf_dir).write.parquet(folder)
    return readers.cases(spark, folder)


def _cases(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("case_id"), F.col("o_orderpriority").alias("description"),
        F.concat(F.lit("Pedido "), k, F.lit(" del cliente "), F.col("o_custkey")).alias("instruction"),
        F.when(k % 3 == 0, "conocido").when(k % 3 == 1, "nuevo").otherwise("complejo").alias("kind"),
    )


def _stub():
    """A stand-in for a model: a fixed answer per instruction, and a failure for every instruction ending in 7."""
    def answer(instruction: str) -> str:
        if instruction.endswith("7"):
            raise TimeoutError("no answer")
        return '{"endpoint":"/api/v2/orders","method":"GET","headers":{},"body":{"q":"' + instruction + '"}}'

    return answer


_GENERATED_SQL = """
cases AS (SELECT o_orderkey AS case_id, 'Pedido ' || o_orderkey || ' del cliente ' || o_custkey AS instruction
          FROM orders),
generated AS (
  SELECT case_id, instruction,
         CASE WHEN instruction LIKE '%7' THEN ''
              ELSE '{"endpoint":"/api/v2/orders","method":"GET","headers":{},"body":{"q":"' || instruction || '"}}'
         END AS raw,
         CASE WHEN instruction LIKE '%7' THEN 'TimeoutError: no answer' END AS error
  FROM cases)"""


@query("u2_generate", f"WITH {_GENERATED_SQL} SELECT case_id, instruction, raw, error FROM generated")
def u2_generate(spark, sf_dir):
    return an.generate(_cases(spark, sf_dir), "instruction", _stub, ["case_id"]).select(
        "case_id", "instruction", "raw", "error"
    )


@query("e2_failed_calls", f"""WITH {_GENERATED_SQL}
SELECT error, count(*) AS n, count(*) FILTER (WHERE error IS NULL) AS n_valid,
       round(avg(CASE WHEN error IS NULL THEN 1.0 ELSE 0.0 END), 6) AS mean_score
FROM generated GROUP BY error""")
def e2_failed_calls(spark, sf_dir):
    generated = an.generate(_cases(spark, sf_dir), "instruction", _stub, ["case_id"])
    return ev.summary(ev.evaluate(generated), by=["error"], elapsed_ms=None).select(
        "error", "n", "n_valid", "mean_score"
    )
