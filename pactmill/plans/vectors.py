"""Registered queries: block quantization of embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from pactmill import fixed_values as fv
from pactmill.functions import blocks as bl
from pactmill.operators import vectors
from pactmill.plans.registry import query, table

_VALUES_SQL = """
v AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings)"""
_LEVELS = "[" + ", ".join(repr(v) for v in fv.NF4_LEVELS) + "]::DOUBLE[]"
_MIDS = "[" + ", ".join(repr(v) for v in bl.NF4_MIDPOINTS) + "]::DOUBLE[]"


def _symmetric_sql(tag: str, top: int) -> str:
    return f"""
{tag}_s AS (SELECT *, max(abs(x)) OVER (PARTITION BY vec_id, (i - 1) // 32) / {top}::DOUBLE AS s FROM v),
{tag}_c AS (SELECT *, CASE WHEN s = 0 THEN 0 ELSE round(x / s)::INT END AS c FROM {tag}_s),
{tag} AS (SELECT vec_id, i, x, c, c * s AS y FROM {tag}_c)"""


# the nearest level is found by comparing with every level, lower index first on ties
_NF4_SQL = f"""
nf4_s AS (SELECT *, max(abs(x)) OVER (PARTITION BY vec_id, (i - 1) // 64) AS s FROM v),
mids AS (SELECT unnest({_MIDS}) AS m),
nf4_c AS (SELECT vec_id, i, x, s, (CASE WHEN s = 0 THEN 7 ELSE (SELECT count(*) FROM mids WHERE m < x / s) END)::INT AS c
          FROM nf4_s),
nf4 AS (SELECT vec_id, i, x, s, c, ({_LEVELS})[c + 1] * s AS y FROM nf4_c)"""


def _per_vector_sql(tag: str, ctes: str) -> str:
    return f"""WITH {_VALUES_SQL}, {ctes}
SELECT vec_id, string_agg(c::VARCHAR, ',' ORDER BY i) AS codes, round(max(abs(x - y)), 8) AS max_err
FROM {tag} GROUP BY vec_id"""


def _per_vector(spark, sf_dir, name):
    rule = vectors.FORMATS[name].rule
    rows = vectors.pack(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), name, scale_bits=bl.EXACT)
    codes = bl.codes(F.col("packed"), rule).cast("array<string>")
    error = bl.largest_error(F.col("embedding"), F.col("packed"), rule)
    return rows.select("vec_id", F.array_join(codes, ",").alias("codes"), F.round(error, 8).alias("max_err"))


@query("v1_eight_bit", _per_vector_sql("q8", _symmetric_sql("q8", 127)))
def v1_eight_bit(spark, sf_dir):
    return _per_vector(spark, sf_dir, "q8_0")


@query("v2_four_bit", _per_vector_sql("q4", _symmetric_sql("q4", 7)))
def v2_four_bit(spark, sf_dir):
    return _per_vector(spark, sf_dir, "q4_0")


@query("v3_nf4", _per_vector_sql("nf4", _NF4_SQL))
def v3_nf4(spark, sf_dir):
    return _per_vector(spark, sf_dir, "nf4")


_NESTED_SQL = f"""
blk AS (SELECT vec_id, (i - 1) // 64 AS block, max(abs(x)) AS scale FROM v GROUP BY ALL),
num AS (SELECT *, (row_number() OVER (ORDER BY vec_id, block) - 1) // 256 AS grp FROM blk),
mean AS (SELECT *, sum(round(scale, 10)::DECIMAL(20,10)) OVER (PARTITION BY grp)::DOUBLE
                   / count(*) OVER (PARTITION BY grp) AS mean FROM num),
dev AS (SELECT *, max(abs(scale - mean)) OVER (PARTITION BY grp) / 127::DOUBLE AS step FROM mean),
nested AS (SELECT *, (CASE WHEN step = 0 THEN 0 ELSE round((scale - mean) / step) END)::INT AS code FROM dev)"""


@query("v4_nested_scales", f"""WITH {_VALUES_SQL}, {_NESTED_SQL}
SELECT vec_id, block, grp, code, round(mean + code * step, 8) AS restored FROM nested""")
def v4_nested_scales(spark, sf_dir):
    rows = vectors.nested_scales(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return rows.select("vec_id", "block", "grp", "code", F.round("restored_scale", 8).alias("restored"))


_REPORT_SQL = f"""
q4q8 AS (SELECT 'q8_0' AS format, 8.5::DOUBLE AS bits_per_value, x, y FROM q8
         UNION ALL SELECT 'q4_0', 4.5::DOUBLE, x, y FROM q4
         UNION ALL SELECT 'nf4', 4.5::DOUBLE, x, y FROM nf4
         UNION ALL SELECT 'nf4_nested', 4 + (8 + 64::DOUBLE / 256) / 64, f.x,
                          ({_LEVELS})[f.c + 1] * (n.mean + n.code * n.step)
                   FROM nf4 f JOIN nested n ON n.vec_id = f.vec_id AND n.block = (f.i - 1) // 64),
report AS (SELECT format, bits_per_value, count(*) AS n_values,
                  ceil(count(*) * bits_per_value / 8)::BIGINT AS bytes,
                  round(sqrt(sum((x - y) * (x - y)) / count(*)), 8) AS rmse, round(max(abs(x - y)), 8) AS max_abs_err
           FROM q4q8 GROUP BY format, bits_per_value)"""
_ALL_SQL = (f"WITH {_VALUES_SQL}, {_symmetric_sql('q8', 127)}, {_symmetric_sql('q4', 7)}, {_NF4_SQL}, {_NESTED_SQL}, "
            f"{_REPORT_SQL}")


def _reports(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vectors.full_report(rows)


@query("v5_format_report", f"{_ALL_SQL} SELECT * FROM report")
def v5_format_report(spark, sf_dir):
    return _reports(spark, sf_dir)


@query("v6_within_budget", f"""{_ALL_SQL}
SELECT arg_max(format, {{'b': bits_per_value, 'r': -rmse, 'f': format}}) AS format, max(bits_per_value) AS bits_per_value
FROM report WHERE bytes <= n_values * 5 / 8""")
def v6_within_budget(spark, sf_dir):
    """Budget: five bits per stored value."""
    return vectors.within_budget(_reports(spark, sf_dir), F.col("n_values") * 5 / 8)
