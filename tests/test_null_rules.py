"""NULL, NaN and infinity: the rules of every operator they reach."""

import pytest
from pyspark.sql import functions as F

from pactmill import session
from pactmill.functions import chat, jsontext as jx, text as tx
from pactmill.operators import evaluation as ev, runs, vectors


def metrics(spark):
    rows = [(1, 50, None), (1, 100, float("nan")), (1, 150, 0.5), (1, 160, 0.4), (1, 110, 0.4), (2, 10, None), (3, 50, 0.1)]
    return spark.createDataFrame(rows, "run_id bigint, step bigint, value double").withColumn("metric", F.lit("eval_loss"))


def test_missing_losses_never_win(spark):
    assert {tuple(r) for r in runs.best_checkpoint(metrics(spark)).collect()} == {(1, 110, 0.4), (3, 50, 0.1)}
    kept = runs.kept_checkpoints(metrics(spark)).where("run_id = 1").orderBy("place").collect()
    assert [(r.step, r.loss) for r in kept] == [(110, 0.4), (160, 0.4), (150, 0.5)]


def test_latest_checkpoint_is_a_saved_step(spark):
    assert {tuple(r) for r in runs.latest_checkpoint(metrics(spark)).collect()} == {(1, 150), (3, 50)}


def test_message_without_a_role_is_kept(spark):
    rows = spark.range(1).select(F.array(chat.message("user", F.lit("a")), F.struct(F.lit(None).cast("string").alias("role"), F.lit("b").alias("content"))).alias("m"))
    assert rows.select(chat.render(F.col("m"))).first()[0] == "<|im_start|>user\na<|im_end|>\n<|im_start|>\nb<|im_end|>\n"


def test_exact_reading_survives_depth_and_half_surrogates(spark):
    deep = "[" * 200_000 + "]" * 200_000
    half = '{"method": "\\ud800", "\\udfff": 1}'
    rows = spark.createDataFrame([(1, deep), (2, half), (3, '{"a": NaN}')], "k int, raw string")
    got = {r.k: r.status for r in ev.extract(rows, exact=True).collect()}
    assert got == {1: "invalid", 2: "ok", 3: "ok"}
    assert rows.where("k < 3").select(jx.indented(F.col("raw"), 2).alias("t")).where("t is null").count() == 0


@pytest.mark.parametrize("name", sorted(vectors.FORMATS))
def test_vectors_that_cannot_be_quantized(spark, name):
    bad = [None, [1.0, None], [float("nan")] * 3, [float("inf"), 1.0]]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate([*bad, [0.5, -1.0]])], "vec_id bigint, embedding array<float>")
    got = {r.vec_id: r.restored for r in vectors.quantize(rows, name).collect()}
    assert all(got[k] is None for k in range(4)) and len(got[4]) == 2
    assert {r.n_values for r in vectors.report(rows).collect()} == {2}
    assert vectors.nested_report(rows).first().n_values == 2


def test_capped_text_keeps_its_white_space(spark):
    texts = ["a  b\n\nc d", " \ta\n b   c  d ", "a b c", "", "a b c "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(tx.capped(F.col("t"), 3)).collect()] == ["a  b\n\nc", " \ta\n b   c", "a b c", "", "a b c"]


def test_scratch_folder_needs_a_shared_place_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default=None: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_folder(Session(), "x")
    Context.getCheckpointDir = lambda self: "/shared"
    assert session.scratch_folder(Session(), "x").startswith("/shared/x-")
