"""Registered queries: run metrics and checkpoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from pactmill import session
from pactmill.operators import runs
from pactmill.plans import derive
from pactmill.plans.derive import METRICS_SQL
from pactmill.plans.registry import query
from pactmill.sources import sinks


@query("s7_metrics_sink", f"""WITH {METRICS_SQL}
SELECT run_id, metric, count(*) AS n, max(step) AS last_step FROM metrics GROUP BY run_id, metric""")
def s7_metrics_sink(spark, sf_dir):
    folder = session.scratch_folder(spark, "metrics")
    sinks.append_metrics(derive.metrics(spark, sf_dir), folder)
    stored = spark.read.schema("step bigint, metric string, value double, ts timestamp_ntz, run_id bigint").parquet(folder)
    return stored.groupBy("run_id", "metric").agg(F.count(F.lit(1)).alias("n"), F.max("step").alias("last_step"))


@query("a9_best_checkpoint", f"""WITH {METRICS_SQL},
r AS (SELECT run_id, step, value, row_number() OVER (PARTITION BY run_id ORDER BY value, step) AS p
      FROM metrics WHERE metric = 'eval_loss')
SELECT run_id, step AS best_step, value AS best_loss FROM r WHERE p = 1""")
def a9_best_checkpoint(spark, sf_dir):
    return runs.best_checkpoint(derive.metrics(spark, sf_dir))


@query("a10_latest_checkpoint", f"""WITH {METRICS_SQL}
SELECT run_id, max(step) AS latest_step FROM metrics WHERE step % 50 = 0 AND step > 0 GROUP BY run_id""")
def a10_latest_checkpoint(spark, sf_dir):
    return runs.latest_checkpoint(derive.metrics(spark, sf_dir))


@query("a11_final_figures", f"""WITH {METRICS_SQL}
SELECT run_id, arg_max(value, step) FILTER (WHERE metric = 'train_loss') AS final_loss,
       arg_max(value, step) FILTER (WHERE metric = 'train_runtime') AS runtime_s,
       round(arg_max(value, step) FILTER (WHERE metric = 'train_runtime') / 60.0::DOUBLE, 1) AS runtime_min
FROM metrics GROUP BY run_id""")
def a11_final_figures(spark, sf_dir):
    return runs.final_figures(derive.metrics(spark, sf_dir))


@query("w6_kept_checkpoints", f"""WITH {METRICS_SQL},
r AS (SELECT run_id, step, value AS loss, row_number() OVER (PARTITION BY run_id ORDER BY value, step) AS place
      FROM metrics WHERE metric = 'eval_loss')
SELECT run_id, step, loss, place::INT AS place FROM r WHERE place <= 3""")
def w6_kept_checkpoints(spark, sf_dir):
    return runs.kept_checkpoints(derive.metrics(spark, sf_dir))


@query("w7_cadence", f"""WITH {METRICS_SQL}
SELECT run_id, step, metric, value, 'log' AS cadence FROM metrics WHERE step % 10 = 0
UNION ALL SELECT run_id, step, metric, value, 'save' FROM metrics WHERE step % 50 = 0""")
def w7_cadence(spark, sf_dir):
    rows = derive.metrics(spark, sf_dir).drop("ts")
    logged = runs.at_cadence(rows, 10).withColumn("cadence", F.lit("log"))
    return logged.unionByName(runs.at_cadence(rows, 50).withColumn("cadence", F.lit("save")))
