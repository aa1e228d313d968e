"""Cuts, positions, packing and batch plans against plain Python, on awkward keys."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pactmill.functions import text as tx
from pactmill.operators import ordering, packing, schedule, splits

random.seed(5)
CLUSTERED = sorted({0, 10**18, -(10**17), *random.sample(range(10**6, 10**6 + 4000), 3000)})


def keyed(spark, keys, parts=7):
    shuffled = random.sample(keys, len(keys))
    return spark.createDataFrame([(k,) for k in shuffled], "k bigint").repartition(parts)


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9, 10, 11, 3003])
def test_positional_split_has_exact_size(spark, n):
    keys = CLUSTERED[:n]
    for parts in (1, 5):
        got = {r.k: r.split for r in splits.positional(keyed(spark, keys, parts), "k").collect()}
        cut = n * 8 // 10
        assert got == {k: "train" if i < cut else "eval" for i, k in enumerate(keys)}


@pytest.mark.parametrize("n", [1, 9, 10, 11, 3003])
def test_seeded_split_has_exact_size_and_is_stable(spark, n):
    keys = CLUSTERED[:n]
    order = sorted(keys, key=lambda k: hashlib.md5(f"{k}|42".encode()).hexdigest())
    chosen = set(order[: -(-n // 10)])
    for parts in (1, 5):
        got = {r.k: r.split for r in splits.seeded(keyed(spark, keys, parts), "k").collect()}
        assert got == {k: "eval" if k in chosen else "train" for k in keys}


def test_split_of_nothing(spark):
    empty = spark.createDataFrame([], "k bigint")
    assert splits.positional(empty, "k").count() == 0
    assert splits.seeded(empty, "k").count() == 0


def test_repeated_key_at_the_cut_is_refused(spark):
    rows = spark.createDataFrame([(1,)] * 10, "k bigint")
    with pytest.raises(ValueError):
        splits.positional(rows, "k")
    with pytest.raises(ValueError):
        splits.seeded(rows, "k")


def test_positions_on_clustered_keys(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 100)
    got = {r.k: r.pos for r in ordering.with_position(keyed(spark, CLUSTERED), "k", "pos").collect()}
    assert got == {k: i for i, k in enumerate(CLUSTERED, 1)}


def test_repeated_key_is_refused_anywhere(spark):
    rows = spark.createDataFrame([(k,) for k in [1, 2, 3, 900, 900, 5000]], "k bigint")
    with pytest.raises(Exception, match="not unique"):
        ordering.with_position(rows, "k", "p").collect()


def test_hash_digits_follow_the_rows():
    assert ordering.hex_digits(10) == 3 and ordering.hex_digits(16**3 * ordering.ROWS_PER_BUCKET + 1) == 4


def test_running_start_with_weights(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 50)
    keys = list(range(0, 5000, 7))
    rows = keyed(spark, keys).withColumn("w", F.when(F.col("k") == 700, 100_000).otherwise(F.col("k") % 5))
    got = {r.k: r.s for r in ordering.with_running_start(rows, "k", F.col("w"), "s").collect()}
    total, want = 0, {}
    for k in keys:
        want[k] = total
        total += 100_000 if k == 700 else k % 5
    assert got == want


def test_null_key_is_refused(spark):
    with pytest.raises(ValueError):
        ordering.with_position(spark.createDataFrame([(None,), (1,)], "k bigint"), "k", "p")


@pytest.fixture(scope="module")
def texts():
    out = []
    for k in range(300):
        n = 5000 if k == 100 else random.choice([0, 1, 3, 16, 40])
        out.append((k * 3, "  ".join(f"w{k}_{i}" for i in range(n))))
    return out


def test_packing_equals_plain_concatenation(spark, texts, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 20)
    cap = 64
    rows = spark.createDataFrame(texts, "k bigint, text string").repartition(5)
    stream = [t for _, text in texts for t in text.split()]
    want = {i: " ".join(stream[i * cap:(i + 1) * cap]) for i in range(-(-len(stream) // cap))}
    assert {r.block: r.text for r in packing.pack(rows, "k", cap=cap).collect()} == want
    plan = packing.pack_plan(rows, "k", cap=cap)
    assert plan.agg(F.sum("length")).first()[0] == len(stream)
    assert plan.groupBy("block").agg(F.sum("length").alias("n")).where(f"n > {cap}").count() == 0
    assert rows.agg(F.sum(tx.token_count(F.col("text")))).first()[0] == len(stream)


def test_batch_plan(spark):
    keys = list(range(0, 1000, 3))
    got = schedule.batch_plan(keyed(spark, keys), "k").collect()
    assert len(got) == 3 * len(keys)
    for epoch in (1, 2, 3):
        order = sorted(keys, key=lambda k: hashlib.md5(f"{k}|{epoch}|42".encode()).hexdigest())
        mine = {r.k: (r.pos, r.step, r.micro) for r in got if r.epoch == epoch}
        assert mine == {k: (i, i // 16, i // 2 % 8) for i, k in enumerate(order)}


def test_no_stage_over_rows_runs_in_a_single_task(spark, monkeypatch):
    """The only unpartitioned window is over bucket totals."""
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 100)
    rows = keyed(spark, CLUSTERED)
    plan = ordering.with_position(rows, "k", "p")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1
    assert "Window" in plan.split("SinglePartition")[0] and "_total" in plan
    plan = splits.seeded(rows, "k")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
