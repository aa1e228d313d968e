"""Registered queries of the operators and the SQL some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pactmill import session
from pactmill.llm import (
    byte_bpe, exact_dedup, jaccard_join, language_id, lexical_search, main_text, mixing, near_dedup, pivot_search, sharding,
    token_alignment, toxicity, wildcard_urls as urls,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SHARDS = 24
SEED = 7
URL_RULES = [
    urls.Rule("block", "net/"), urls.Rule("allow", "example.net/en/"), urls.Rule("block", "example.com/de/"),
    urls.Rule("allow", "org/fr/"),
]
# rows and bytes per Arrow batch: long texts and large nodes must not add up in a worker
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def prepare(spark: SparkSession) -> SparkSession:
    session.prepare(spark)
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def links_sql(width: int, share: int, kept: bool) -> str:
    """SQL for documents linked by their word shingles: shared shingles counted by pair, classes by reachability."""
    return rf"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - {width} + 2), lambda i: array_to_string(w[i:i + {width} - 1], ' ')) END) AS g
        FROM d),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= {share} * (x.n + y.n - i)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
    c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id{", d.doc_id = component_id AS kept" if kept else ""}
    FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""


def held_out(divisor: int, remainder: int):
    return language_id.remainder("doc_id", divisor) == remainder


@query("op1_near_dedup", links_sql(5, 85, kept=True))
def near(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_main_text")
def page_text(spark, sf_dir):
    texts = main_text.extracted(table(spark, sf_dir, "pages"), also=("url",))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))


@query("op3_toxicity")
def toxic(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(documents, labels.where(~held_out(5, 0)))
    return toxicity.scored(documents, model).select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op4_exact_dedup", f"""
    WITH t AS (SELECT doc_id, {LOWERED} AS low FROM documents),
    g AS (SELECT low, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY low)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.low) AS text_sha256 FROM t JOIN g ON t.low = g.low""")
def exact(spark, sf_dir):
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


@query("op5_language")
def language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    net = language_id.fit(documents.where(~held_out(4, 2)))
    found = language_id.predicted(documents.select("doc_id", "text"), net).select("row.doc_id", "lang_pred", "score")
    return found.withColumn("held_out", held_out(4, 2))


@query("op6_shards")
def shards(spark, sf_dir):
    placed = sharding.sharded(table(spark, sf_dir, "documents"), SHARDS, seed=SEED)
    return placed.select(
        "row.doc_id", sharding.size(F.col("row.text")).alias("size"), sharding.crc(F.col("row.text")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_url_verdicts", r"""
    WITH u AS (
        SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages),
    r AS (
        SELECT *, CASE
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
        FROM u)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
    FROM r""")
def url_verdicts(spark, sf_dir):
    judged = urls.judged(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


@query("op8_source_mix", rf"""
    WITH d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
               ('0x' || substr(md5(doc_id::VARCHAR || '|{SEED}'), 1, 15))::BIGINT AS h
        FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (
        SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w,
               3 * source_size AS cap
        FROM s),
    l AS (
        SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST) AS place, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT::DOUBLE
               / (sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS lev
        FROM w),
    t AS (
        SELECT source, source_size,
               least(cap::DOUBLE, w * (SELECT arg_min(lev, place) FROM l WHERE lev <= cap::DOUBLE / w)) AS target
        FROM l),
    p AS (
        SELECT d.*, source_size, target, least(floor(target / source_size), 3)::BIGINT AS passes,
               target - source_size * least(floor(target / source_size), 3) AS budget,
               sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           (size * (passes + CASE WHEN upto <= budget THEN 1
                                  WHEN upto - size <= budget AND upto - budget < budget - (upto - size) THEN 1
                                  ELSE 0 END))::BIGINT AS taken
    FROM p""")
def source_mix(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents"), seed=SEED)


@query("op9_vector_topk", """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS c FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT q.vec_id AS query_id, x.vec_id,
               list_sum(list_transform(list_zip(q.c, x.c), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM v q JOIN v x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10""")
def vector_topk(spark, sf_dir):
    return pivot_search.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


@query("op10_byte_bpe")
def bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.coded(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op11_gram_join", links_sql(3, 90, kept=False))
def gram_join(spark, sf_dir):
    return jaccard_join.joined(table(spark, sf_dir, "documents"))


@query("op12_token_alignment")
def token_links(spark, sf_dir):
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = token_alignment.aligned(table(spark, sf_dir, "documents").select("doc_id", "text"), a, b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return token_alignment.with_counts(
        aligned.select("row.doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "pairs", "times")
    )


@query("op13_lexical_search", r"""
    WITH t AS (
        SELECT row_number() OVER () AS d, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents),
    a AS (SELECT (count(*) FILTER (len(terms) > 0))::BIGINT AS docs, coalesce(sum(len(terms)), 0)::BIGINT AS total FROM t),
    p AS (SELECT d, doc_id, n, term, count(*)::BIGINT AS tf
          FROM (SELECT d, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM t) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, a GROUP BY term, docs),
    q AS (
        SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
    s AS (
        SELECT i, item_id, d, doc_id,
               sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
        FROM q JOIN p USING (term) JOIN w USING (term), a GROUP BY i, item_id, d, doc_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
    SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 10""")
def lexical(spark, sf_dir):
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
