"""Shapes of physical plans: what is read, what moves, and what must not appear."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pactmill import plans
from pactmill.operators import answers as an, evaluation as ev, runs, splits
from pactmill.sources import readers, sinks

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("name", sorted(n for n in plans.QUERIES if not n.startswith(("t1", "t2", "t3", "t4"))))
def test_no_cross_joins_and_no_row_at_a_time_python(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BatchEvalPython" not in text
    # the four settings bands are the only range join
    assert ("BroadcastNestedLoopJoin" in text) == (name == "n2_settings_by_size")


@needs_tables
def test_only_needed_columns_are_read(spark):
    text = plan(entry.queries()["a4_mean_latency"](spark, SF_DIR))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text and "parseJson" not in text
    text = plan(entry.queries()["w5_batch_plan"](spark, SF_DIR))
    assert "text" not in text.split("ReadSchema")[1]
    text = plan(entry.queries()["w2_seeded_split"](spark, SF_DIR))
    assert "Exchange" not in text


def test_named_split_reads_its_own_folder(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.write_corpus(splits.positional(spark.range(50).withColumnRenamed("id", "k"), "k"), path)
    text = plan(readers.corpus(spark, path, split="train"))
    assert "PartitionFilters: [isnotnull(split" in text


def test_filters_reach_the_scan_and_texts_are_parsed_once(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.range(20).select(F.col("id").alias("case_id"), F.lit("{}").alias("raw"), (F.col("id") % 3).alias("day")).write.partitionBy(
        "day"
    ).parquet(path)
    table = spark.read.parquet(path)
    text = plan(ev.evaluate(table).where("status = 'ok' and valid and case_id > 3 and day = 1").select("case_id", "status", "score"))
    assert text.count("parseJson") == 3  # one for each attempt
    assert "GreaterThan(case_id,3)" in text.split("PushedFilters")[1].split("]")[0]
    assert "= 1)" in text.split("PartitionFilters")[1].split("PushedFilters")[0]


@needs_tables
@pytest.mark.parametrize("name", ["w3_case_detail", "w4_pack_plan", "w4_packed_blocks", "v4_nested_scales"])
def test_numbering_never_brings_rows_into_one_task(spark, name):
    """The only single partition is that of the bucket totals."""
    text = plan(entry.queries()[name](spark, SF_DIR))
    for part in text.split("Exchange SinglePartition")[1:]:
        assert "functions=[sum(" in part.split("Exchange")[0] and "_bucket" in part.split("Exchange")[0]


def test_kept_checkpoints_are_limited_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.range(100).select(
        (F.col("id") % 3).alias("run_id"), F.col("id").alias("step"), F.lit("eval_loss").alias("metric"),
        F.rand(1).alias("value"),
    ).write.parquet(path)
    text = plan(runs.kept_checkpoints(spark.read.parquet(path)))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_pairing_reduces_the_unmatched_side_first(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        cases = spark.range(10).withColumnRenamed("id", "case_id")
        given = spark.range(10).select(F.lit(5).cast("bigint").alias("case_id"), F.col("id").cast("string").alias("raw"))
        text = plan(an.pair_with_cases(cases, given))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftOuter" not in text and "LeftAnti" in text
