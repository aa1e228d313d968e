"""Registered queries: corpora, rendering, splits, packing and batch plans."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pactmill import fixed_values as fv, session
from pactmill.functions import batched, chat, jsontext as jx, text as tx
from pactmill.operators import corpus, packing, schedule, splits
from pactmill.plans import derive
from pactmill.plans.derive import ACTIONS, ANSWERS_SQL, PAIRS_SQL
from pactmill.plans.registry import query, table
from pactmill.sources import readers, sinks


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PROMPT = _lit(fv.SYSTEM_PROMPT)
# one ChatML message
_MSG = "'<|im_start|>' || {role} || chr(10) || {content} || '<|im_end|>' || chr(10)"


def _msg(role: str, content: str) -> str:
    return _MSG.format(role=role, content=content)


_SEEDED_DOCS = """
ranked AS (SELECT *, row_number() OVER (ORDER BY md5(doc_id || '|42')) AS r, count(*) OVER () AS n FROM documents),
halves AS (SELECT *, CASE WHEN r <= (n + 9) // 10 THEN 'eval' ELSE 'train' END AS split FROM ranked)"""


@query("s1_read_named_split", f"WITH {_SEEDED_DOCS} SELECT doc_id, lang, text FROM halves WHERE split = 'train'")
def s1_read_named_split(spark, sf_dir):
    """Write the documents with a seeded split and read one named split back: only its folder is scanned."""
    folder = session.scratch_folder(spark, "corpus")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    sinks.write_corpus(splits.seeded(docs, "doc_id"), folder)
    return readers.corpus(spark, folder, split=splits.TRAIN).select("doc_id", "lang", "text")


@query("s3_external_source", f"""WITH {PAIRS_SQL}
SELECT conv_id, turn, {_msg("'system'", PROMPT)} || {_msg("'user'", "instruction")}
       || {_msg("'assistant'", "response")} AS text FROM pairs""")
def s3_external_source(spark, sf_dir):
    """Pairs stored as a JSON-lines corpus, then chosen as the external source."""
    folder = session.scratch_folder(spark, "external")
    pairs = derive.pairs(spark, sf_dir)
    corpus.adapt(pairs, {"instruction": "instruction", "response": "response"}, ["conv_id", "turn"]).write.json(folder)
    rows = readers.choose(
        spark, built_in=False, path=folder, fmt="json",
        schema="conv_id bigint, turn bigint, messages array<struct<role: string, content: string>>",
    )
    return rows.select("conv_id", "turn", chat.render(F.col("messages")).alias("text"))


@query("s6_corpus_sink", f"WITH {_SEEDED_DOCS} SELECT split, lang, count(*) AS n FROM halves GROUP BY split, lang")
def s6_corpus_sink(spark, sf_dir):
    folder = session.scratch_folder(spark, "corpus")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    sinks.write_corpus(splits.seeded(docs, "doc_id"), folder)
    return readers.corpus(spark, folder).groupBy("split", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("p1_build_examples", f"""WITH {PAIRS_SQL}
SELECT conv_id, turn, 'system=' || {PROMPT} || '|user=' || instruction || '|assistant=' || response AS example
FROM pairs""")
def p1_build_examples(spark, sf_dir):
    built = derive.pairs(spark, sf_dir).select(
        "conv_id", "turn", chat.example(F.col("instruction"), F.col("response")).alias("m")
    )
    joined = F.array_join(F.transform("m", lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|")
    return built.select("conv_id", "turn", joined.alias("example"))


def _created_order() -> Column:
    k = F.col("o_orderkey")
    body = F.struct(
        F.col("o_custkey").alias("customer_id"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.when(F.col("o_orderstatus") != "O", F.concat(F.lit("año "), F.col("o_orderstatus"))).alias("note"),
        F.array(F.struct(F.concat(F.lit("SKU-"), k).alias("sku"), (k % 7).alias("quantity"))).alias("items"),
        F.lit(None).cast("string").alias("valid_until"),
    )
    return F.struct(
        F.lit("/api/v2/orders/create").alias("endpoint"), F.lit("POST").alias("method"),
        F.struct(F.col("o_orderpriority").alias("X-Priority")).alias("headers"), body.alias("body"),
    )


@query("p2_encode_call", """
SELECT o_orderkey,
       '{"endpoint":"/api/v2/orders/create","method":"POST","headers":{"X-Priority":"' || o_orderpriority
       || '"},"body":{"customer_id":' || o_custkey || ',"urgent":'
       || CASE WHEN o_orderpriority = '1-URGENT' THEN 'true' ELSE 'false' END
       || ',"note":' || CASE WHEN o_orderstatus = 'O' THEN 'null' ELSE '"año ' || o_orderstatus || '"' END
       || ',"items":[{"sku":"SKU-' || o_orderkey || '","quantity":' || (o_orderkey % 7) || '}],"valid_until":null}}'
       AS call FROM orders""")
def p2_encode_call(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", jx.encode_call(_created_order()).alias("call"))


@query("p2_indented_call", """
SELECT o_orderkey, concat_ws(chr(10), '{', '  "endpoint": "/api/v2/orders/create",', '  "method": "POST",', '  "headers": {',
       '    "X-Priority": "' || o_orderpriority || '"', '  },', '  "body": {', '    "customer_id": ' || o_custkey || ',',
       '    "urgent": ' || CASE WHEN o_orderpriority = '1-URGENT' THEN 'true' ELSE 'false' END || ',',
       '    "note": ' || CASE WHEN o_orderstatus = 'O' THEN 'null' ELSE '"año ' || o_orderstatus || '"' END || ',',
       '    "items": [', '      {', '        "sku": "SKU-' || o_orderkey || '",', '        "quantity": ' || (o_orderkey % 7), '      }',
       '    ],', '    "valid_until": null', '  }', '}') AS call FROM orders""")
def p2_indented_call(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", _created_order().alias("call"))
    return rows.select("o_orderkey", jx.encode_indented(F.col("call"), rows.schema["call"].dataType).alias("call"))


@query("p3_adapt_layout", f"""WITH {PAIRS_SQL}
SELECT conv_id, turn, {_msg("'system'", PROMPT)}
       || {_msg("'user'", "instruction || CASE WHEN turn > 0 THEN chr(10) || chr(10) || 'turn ' || turn ELSE '' END")}
       || {_msg("'assistant'", "response")} AS text FROM pairs""")
def p3_adapt_layout(spark, sf_dir):
    context = F.when(F.col("turn") > 0, F.concat(F.lit("turn "), F.col("turn"))).otherwise("")
    laid = derive.pairs(spark, sf_dir).select(
        "conv_id", "turn", F.col("instruction").alias("prompt"), context.alias("context"), F.col("response").alias("output")
    )
    mapping = {"instruction": "prompt", "input": "context", "response": "output"}
    return corpus.adapt(laid, mapping, ["conv_id", "turn"]).select(
        "conv_id", "turn", chat.render(F.col("messages")).alias("text")
    )


_CONVERSATIONS_SQL = f"""SELECT conv_id, string_agg({_msg("role", "text")}, '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id"""


@query("p4_render_chat", _CONVERSATIONS_SQL)
def p4_render_chat(spark, sf_dir):
    rows = corpus.conversations(table(spark, sf_dir, "conversations"))
    return rows.select("conv_id", chat.render(F.col("messages")).alias("text"))


@query("a6_conversations", """
SELECT conv_id, count(*) AS n_messages, string_agg(role || ': ' || text, ' / ' ORDER BY turn) AS messages
FROM conversations GROUP BY conv_id""")
def a6_conversations(spark, sf_dir):
    rows = corpus.conversations(table(spark, sf_dir, "conversations"))
    line = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return rows.select(
        "conv_id", F.size("messages").cast("bigint").alias("n_messages"), F.array_join(line, " / ").alias("messages")
    )


@query("p5_render_prompt", f"""
SELECT conv_id, turn, {_msg("'system'", PROMPT)} || {_msg("'user'", "text")} || '<|im_start|>assistant' || chr(10) AS prompt
FROM conversations WHERE role = 'user'""")
def p5_render_prompt(spark, sf_dir):
    asked = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return asked.select(
        "conv_id", "turn", chat.render_prompt(chat.inference_messages(F.col("text"))).alias("prompt")
    )


@query("p6_request_payload", f"""
SELECT conv_id, turn, '{{"model":"api-specialist","messages":[{{"role":"system","content":'
  || CAST(to_json({PROMPT}) AS VARCHAR) || '}},{{"role":"user","content":' || CAST(to_json(text) AS VARCHAR)
  || '}}],"stream":false,"options":{{"temperature":0.1,"num_predict":512,"top_p":0.9,"top_k":40,"repeat_penalty":1.1}}}}'
  AS payload
FROM conversations WHERE role = 'user'""")
def p6_request_payload(spark, sf_dir):
    asked = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return asked.select("conv_id", "turn", chat.request(F.col("text")).alias("payload"))


@query("p7_preview", "SELECT doc_id, substr(text, 1, 300) || '...' AS preview FROM documents")
def p7_preview(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.preview(F.col("text")).alias("preview"))


@query("p8_short_preview", """
SELECT conv_id, turn, CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '...' ELSE text END AS preview
FROM conversations""")
def p8_short_preview(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", tx.short_preview(F.col("text")).alias("preview")
    )


@query("p9_fixed_width", """
SELECT conv_id, turn, '[' || CASE WHEN length(role) < 8 THEN rpad(role, 8, ' ') ELSE role END || '] '
       || rpad(substr(text, 1, 45), 45, ' ') || '|' AS line FROM conversations""")
def p9_fixed_width(spark, sf_dir):
    line = F.concat(F.lit("["), tx.padded(F.col("role")), F.lit("] "), tx.cell(F.col("text")), F.lit("|"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", line.alias("line"))


@query("p10_cap_tokens", r"""
WITH t AS (SELECT doc_id, text, regexp_extract_all(text, '[^ \t\r\n]+') AS ts FROM documents)
SELECT doc_id, len(ts)::BIGINT AS n_tokens, len(ts) > 2048 AS truncated,
       CASE WHEN len(ts) > 2048 THEN array_to_string(regexp_extract_all(text, '[ \t\r\n]*[^ \t\r\n]+')[1:2048], '')
            ELSE text END AS capped_text FROM t""")
def p10_cap_tokens(spark, sf_dir):
    return packing.cap_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query("p11_minutes", "SELECT event_id, round(value / 60.0::DOUBLE, 1) AS minutes FROM events")
def p11_minutes(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.minutes(F.col("value")).alias("minutes"))


_ACTIONS_SQL = "unnest([" + ", ".join(_lit(a) for a in ACTIONS) + "])"
_GRID_SQL = f"SELECT category, {_ACTIONS_SQL} AS action FROM (SELECT DISTINCT p_brand || ' ' || p_type AS category FROM part)"


def _grid(spark, sf_dir):
    brands = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_brand", "p_type").alias("category"))
    return corpus.action_grid(brands, "category", ACTIONS)


@query("p13_action_grid", _GRID_SQL)
def p13_action_grid(spark, sf_dir):
    return _grid(spark, sf_dir)


@query("p12_example_request", f"""
SELECT category, action, 'Genera un ejemplo de entrenamiento para un asistente de API REST.' || chr(10)
  || '    Categoría: ' || category || chr(10) || '    Acción: ' || action || chr(10) || '    ' || chr(10)
  || '    Responde SOLO con JSON en este formato:' || chr(10)
  || '    {{"instruccion": "...", "llamada_api": {{...}}}}' AS request
FROM ({_GRID_SQL})""")
def p12_example_request(spark, sf_dir):
    return _grid(spark, sf_dir).select(
        "category", "action", chat.example_request(F.col("category"), F.col("action")).alias("request")
    )


@query("p14_generated_pairs", f"""WITH {ANSWERS_SQL},
texts AS (SELECT k AS case_id, '{{"instruccion":"Pedido ' || k || '","llamada_api":' || good || '}}' AS whole, good FROM g)
SELECT case_id, case_id % 10 <> 7 AS parsed, CASE WHEN case_id % 10 <> 7 THEN 'Pedido ' || case_id END AS instruction,
       CASE WHEN case_id % 10 <> 7 THEN good END AS response,
       CASE WHEN case_id % 10 = 7 THEN substr(whole, 1, length(whole) - 2) ELSE whole END AS raw
FROM texts""")
def p14_generated_pairs(spark, sf_dir):
    k = F.col("o_orderkey")
    whole = F.concat(
        F.lit('{"instruccion":"Pedido '), k, F.lit('","llamada_api":{"endpoint":"/api/v2/orders/'), k,
        F.lit('","method":"POST","headers":{"p":"'), F.col("o_orderpriority"), F.lit('"},"body":{"customer_id":'),
        F.col("o_custkey"), F.lit("}}}"),
    )
    raw = F.when(k % 10 == 7, F.substring(whole, 1, F.length(whole) - 2)).otherwise(whole)
    texts = table(spark, sf_dir, "orders").select(k.alias("case_id"), raw.alias("raw"))
    return corpus.generated_pairs(texts, "raw").select("case_id", "parsed", "instruction", "response", "raw")


# calls of every JSON type behind an earlier instruction and call; spaces and digits of a call are kept as they are written
@query("p14_repeated_keys", """
WITH c AS (SELECT o_orderkey AS case_id, CASE o_orderkey % 5
    WHEN 0 THEN '{"id": ' || o_orderkey || ', "total": 1.50, "id": "}"}'
    WHEN 1 THEN '"orden ' || o_orderkey || '"' WHEN 2 THEN o_orderkey || '.250' WHEN 3 THEN '[ ' || o_custkey || ', {"llamada_api": 0} ]'
    ELSE 'null' END AS call FROM orders)
SELECT case_id, case_id % 5 <> 4 AS parsed, CASE WHEN case_id % 5 <> 4 THEN 'Pedido ' || case_id END AS instruction,
       CASE WHEN case_id % 5 <> 4 THEN call END AS response FROM c""")
def p14_repeated_keys(spark, sf_dir):
    k = F.col("o_orderkey")
    call = (
        F.when(k % 5 == 0, F.concat(F.lit('{"id": '), k, F.lit(', "total": 1.50, "id": "}"}')))
        .when(k % 5 == 1, F.concat(F.lit('"orden '), k, F.lit('"')))
        .when(k % 5 == 2, F.concat(k.cast("string"), F.lit(".250")))
        .when(k % 5 == 3, F.concat(F.lit("[ "), F.col("o_custkey"), F.lit(', {"llamada_api": 0} ]')))
        .otherwise("null")
    )
    raw = F.concat(
        F.lit('{"instruccion": "antes", "llamada_api": {"a": [1]}, "instruccion": "Pedido '), k, F.lit('" , "llamada_api" : '), call, F.lit(" }")
    )
    texts = table(spark, sf_dir, "orders").select(k.alias("case_id"), raw.alias("raw"))
    return corpus.generated_pairs(texts, "raw").select("case_id", "parsed", "instruction", "response")


@query("n2_settings_by_size", """
WITH s AS (SELECT lang AS corpus, count(*) AS n FROM documents GROUP BY lang
           UNION ALL SELECT source, count(*) FROM documents GROUP BY source
           UNION ALL SELECT event_type, count(*) FROM events GROUP BY event_type
           UNION ALL SELECT o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus
           UNION ALL SELECT l_returnflag, count(*) FROM lineitem GROUP BY l_returnflag)
SELECT corpus, n, (CASE WHEN n < 500 THEN 8 WHEN n < 5000 THEN 16 WHEN n < 50001 THEN 32 ELSE 64 END)::INT AS rank,
       (CASE WHEN n < 500 THEN 16 WHEN n < 5000 THEN 32 WHEN n < 50001 THEN 64 ELSE 128 END)::INT AS alpha,
       (CASE WHEN n < 5000 THEN 0.05 ELSE 0.1 END)::DOUBLE AS dropout,
       (CASE WHEN n < 500 THEN 5 WHEN n < 5000 THEN 3 WHEN n < 50001 THEN 2 ELSE 1 END)::INT AS epochs
FROM s""")
def n2_settings_by_size(spark, sf_dir):
    grouped = [("documents", "lang"), ("documents", "source"), ("events", "event_type"), ("orders", "o_orderstatus"),
               ("lineitem", "l_returnflag")]
    sizes = None
    for name, column in grouped:
        one = corpus.corpus_sizes(table(spark, sf_dir, name), column)
        sizes = one if sizes is None else sizes.unionByName(one)
    return corpus.with_settings(sizes)


@query("n3_prompt_drift", """
WITH c AS (SELECT conv_id, max(text) FILTER (WHERE role = 'system') AS prompt FROM conversations GROUP BY conv_id),
expected AS (SELECT 'This is the expected prompt.' AS prompt)
SELECT prompt, count(*) AS n FROM c WHERE prompt IS NULL OR prompt NOT IN (SELECT prompt FROM expected) GROUP BY prompt""")
def n3_prompt_drift(spark, sf_dir):
    per_conversation = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.max(F.when(F.col("role") == "system", F.col("text"))).alias("system")
    )
    return corpus.prompt_drift(per_conversation, F.col("system"), ["This is the expected prompt."])


@query("a1_split_sizes", """
WITH r AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS r, count(*) OVER () AS n FROM orders)
SELECT CASE WHEN r <= n * 8 // 10 THEN 'train' ELSE 'eval' END AS split, count(*) AS n FROM r GROUP BY 1""")
def a1_split_sizes(spark, sf_dir):
    return splits.sizes(splits.positional(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey"))


@query("a8_minimum_gate", """
SELECT source AS corpus, count(*) AS n, count(*) >= 200 AS passed FROM documents GROUP BY source
UNION ALL SELECT lang, count(*), count(*) >= 200 FROM documents GROUP BY lang""")
def a8_minimum_gate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return corpus.minimum_gate(docs, "source").unionByName(corpus.minimum_gate(docs, "lang"))


@query("w1_positional_split", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN r <= n * 8 // 10 THEN 'train' ELSE 'eval' END AS split FROM r""")
def w1_positional_split(spark, sf_dir):
    return splits.positional(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query("w2_seeded_split", """
WITH r AS (SELECT event_id, row_number() OVER (ORDER BY md5(event_id || '|42')) AS r, count(*) OVER () AS n FROM events)
SELECT event_id, CASE WHEN r <= (n + 9) // 10 THEN 'eval' ELSE 'train' END AS split FROM r""")
def w2_seeded_split(spark, sf_dir):
    return splits.seeded(table(spark, sf_dir, "events").select("event_id"), "event_id")


_TOKENS_SQL = r"""
t AS (SELECT doc_id, regexp_extract_all(text, '[^ \t\r\n]+') AS ts FROM documents),
s AS (SELECT doc_id, ts, len(ts)::BIGINT AS n,
             (sum(len(ts)) OVER (ORDER BY doc_id) - len(ts))::BIGINT AS start FROM t WHERE len(ts) > 0),
b AS (SELECT *, unnest(range(start // 2048, (start + n - 1) // 2048 + 1)) AS block FROM s),
p AS (SELECT block, doc_id, ts, greatest(start, block * 2048) - start AS row_offset,
             greatest(start, block * 2048) - block * 2048 AS block_offset,
             least(start + n, (block + 1) * 2048) - greatest(start, block * 2048) AS length FROM b)"""


@query("w4_pack_plan", f"WITH {_TOKENS_SQL} SELECT block, doc_id, row_offset, block_offset, length FROM p")
def w4_pack_plan(spark, sf_dir):
    return packing.pack_plan(table(spark, sf_dir, "documents"), "doc_id")


@query("w4_packed_blocks", f"""WITH {_TOKENS_SQL}
SELECT block, string_agg(array_to_string(ts[row_offset + 1 : row_offset + length], ' '), ' ' ORDER BY block_offset) AS text
FROM p GROUP BY block""")
def w4_packed_blocks(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), "doc_id")


@query("w5_batch_plan", """
WITH e AS (SELECT doc_id, unnest([1, 2, 3])::BIGINT AS epoch FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY md5(doc_id || '|' || epoch || '|42'), doc_id) - 1 AS pos
      FROM e)
SELECT doc_id, epoch, pos, pos // 16 AS step, (pos // 2) % 8 AS micro FROM r""")
def w5_batch_plan(spark, sf_dir):
    return schedule.batch_plan(table(spark, sf_dir, "documents"), "doc_id")


@query("u1_batched_column", f"""WITH {PAIRS_SQL}
SELECT conv_id, turn, {_msg("'user'", "instruction")} || {_msg("'assistant'", "response")} AS text FROM pairs""")
def u1_batched_column(spark, sf_dir):
    """A caller's batch function: a template of its own over two columns."""
    def template(batch):
        return ("<|im_start|>user\n" + batch["instruction"] + "<|im_end|>\n<|im_start|>assistant\n" + batch["response"]
                + "<|im_end|>\n")

    rows = derive.pairs(spark, sf_dir)
    return batched.with_batched(rows, template, ["instruction", "response"], "text", "string").select(
        "conv_id", "turn", "text"
    )
