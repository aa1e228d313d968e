"""Messages, rendering, layouts, sources and sinks."""

import json

import pytest
from pyspark.sql import functions as F

from pactmill import fixed_values as fv
from pactmill.functions import batched, chat, jsontext as jx, text as tx
from pactmill.operators import corpus, packing, runs, splits
from pactmill.sources import readers, sinks


def one(spark, column, text="x"):
    return spark.createDataFrame([(text,)], "t string").select(column).first()[0]


def test_built_in_examples_split_six_and_two(spark):
    rows = readers.choose(spark)
    assert rows.count() == 8
    labelled = splits.positional(rows, "ex_id").orderBy("ex_id").collect()
    assert [r.split for r in labelled] == ["train"] * 6 + ["eval"] * 2
    assert {r.split: r.n for r in splits.sizes(splits.positional(rows, "ex_id")).collect()} == {"train": 6, "eval": 2}


def test_built_in_example_renders_as_chatml(spark):
    text = readers.choose(spark).where("ex_id = 4").select(chat.render(F.col("messages"))).first()[0]
    instruction, call = fv.DEMO_PAIRS[3]
    assert text == (
        f"<|im_start|>system\n{fv.SYSTEM_PROMPT}<|im_end|>\n<|im_start|>user\n{instruction}<|im_end|>\n"
        f"<|im_start|>assistant\n{call}<|im_end|>\n"
    )


def test_built_in_calls_keep_nulls_and_can_be_indented(spark):
    pairs = readers.built_in_pairs(spark).orderBy("ex_id")
    got = [r[0] for r in pairs.select(jx.indented(F.col("response"), 2)).collect()]
    assert got == [json.dumps(json.loads(c), ensure_ascii=False, indent=2) for _, c in fv.DEMO_PAIRS]
    assert '"valid_from": null' in got[2]


def test_external_source_needs_a_path_and_messages(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.choose(spark, built_in=False)
    path = str(tmp_path / "plain")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError):
        readers.choose(spark, built_in=False, path=path)


@pytest.mark.parametrize("fmt,options", [("parquet", {}), ("json", {}), ("csv", {"header": "true"}), ("orc", {})])
def test_corpus_formats_and_named_split(spark, tmp_path, fmt, options):
    rows = spark.createDataFrame([(i, f"t{i}", "train" if i < 7 else "eval") for i in range(10)],
                                 "ex_id bigint, text string, split string")
    path = str(tmp_path / fmt)
    rows.write.format(fmt).options(**options).save(path)
    got = readers.corpus(spark, path, fmt, split="train", schema="ex_id bigint, text string, split string", **options)
    assert sorted(r.ex_id for r in got.collect()) == list(range(7))


def test_sink_is_partitioned_by_split(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.write_corpus(splits.positional(spark.range(100).withColumnRenamed("id", "ex_id"), "ex_id"), path)
    assert {p.name for p in (tmp_path / "c").iterdir() if p.is_dir()} == {"split=train", "split=eval"}
    assert readers.corpus(spark, path, split="eval").count() == 20


def test_metrics_are_appended_per_run(spark, tmp_path):
    path = str(tmp_path / "m")
    schema = "run_id bigint, step bigint, metric string, value double, ts timestamp"
    sinks.append_metrics(spark.createDataFrame([(1, 10, "train_loss", 0.5, None)], schema), path)
    sinks.append_metrics(spark.createDataFrame([(1, 20, "train_loss", 0.4, None), (2, 5, "eval_loss", 1.0, None)], schema), path)
    assert spark.read.parquet(path).count() == 3
    got = runs.final_figures(spark.read.parquet(path)).orderBy("run_id").collect()
    assert [(r.final_loss, r.runtime_s, r.runtime_min) for r in got] == [(0.4, None, None), (None, None, None)]


def test_metrics_folders_do_not_grow_with_runs(spark, tmp_path):
    rows = spark.range(1000).select(F.when(F.col("id") != 7, F.col("id")).alias("run_id"), F.col("id").alias("step"),
                                    F.lit("train_loss").alias("metric"), F.lit(0.5).alias("value"), F.lit(None).cast("timestamp").alias("ts"))
    for _ in range(2):
        sinks.append_metrics(rows, str(tmp_path / "m"))
    assert len([p for p in (tmp_path / "m").iterdir() if p.is_dir()]) <= sinks.RUN_GROUPS
    got = spark.read.parquet(str(tmp_path / "m"))
    assert got.count() == 2000 and got.select("run_id").distinct().count() == 1000 and got.where("run_id is null").count() == 2


def test_adapt_layouts(spark):
    rows = spark.createDataFrame(
        [(1, "do", "with", "done", "be brief"), (2, "do", "", "done", None), (3, "do", None, "done", "s")],
        "id int, q string, ctx string, a string, sys string")
    got = corpus.adapt(rows, {"instruction": "q", "input": "ctx", "response": "a", "system": "sys"}, ["id"])
    contents = [[m.content for m in r.messages] for r in got.orderBy("id").collect()]
    assert contents == [["be brief", "do\n\nwith", "done"], [fv.SYSTEM_PROMPT, "do", "done"], ["s", "do", "done"]]
    for wrong in ({"instruction": "q"}, {"instruction": "q", "response": "nope"}, {"instruction": "q", "response": "a", "x": "q"}):
        with pytest.raises(ValueError):
            corpus.adapt(rows, wrong, ["id"])


def test_conversation_in_parts_is_whole(spark):
    turns = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("conv_id"),
                                       F.col("id").alias("turn"), F.lit("user").alias("role"),
                                       F.col("id").cast("string").alias("text"))
    rows = corpus.conversations(turns, part_rows=1000)
    hot = rows.where("conv_id = 7").collect()
    # turn 7 is a conversation of its own key in the other branch and belongs to it
    assert len(hot) == 1
    said = [m.content for m in hot[0].messages]
    assert said == [str(i) for i in range(10_000) if i % 3 == 0 or i == 7]


def test_render_null_content_and_prompt(spark):
    messages = F.array(chat.message("user", F.lit(None).cast("string")))
    assert one(spark, chat.render(messages)) == "<|im_start|>user\n<|im_end|>\n"
    assert one(spark, chat.render_prompt(chat.inference_messages(F.col("t"), F.lit("s")))) == (
        "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nx<|im_end|>\n<|im_start|>assistant\n")


def test_request_payload(spark):
    got = json.loads(one(spark, chat.request(F.col("t"), stream=True), 'say "é"\n'))
    assert got == {
        "model": "api-specialist", "stream": True,
        "messages": [{"role": "system", "content": fv.SYSTEM_PROMPT}, {"role": "user", "content": 'say "é"\n'}],
        "options": {"temperature": 0.1, "num_predict": 512, "top_p": 0.9, "top_k": 40, "repeat_penalty": 1.1},
    }


def test_demo_cases(spark):
    rows = readers.cases(spark).orderBy("case_id").collect()
    assert [r.kind for r in rows] == ["conocido", "conocido", "nuevo", "nuevo", "complejo"]


def test_previews_and_cells(spark):
    assert one(spark, tx.preview(F.col("t"), 3), "é") == "é..."
    assert one(spark, tx.short_preview(F.col("t"), 3), "abc") == "abc"
    assert one(spark, tx.short_preview(F.col("t"), 3), "abcd") == "abc..."
    assert one(spark, tx.cell(F.col("t"), 3), "abcd") == "abc"
    assert one(spark, tx.cell(F.col("t"), 3), "a") == "a  "
    assert one(spark, tx.padded(F.col("t"), 3), "abcd") == "abcd"
    assert one(spark, tx.padded(F.col("t"), 3), "a") == "a  "


def test_cap_tokens(spark):
    rows = spark.createDataFrame([(1, " a  b\tc "), (2, "a b"), (3, "")], "id int, text string")
    got = packing.cap_tokens(rows, cap=2).orderBy("id").collect()
    assert [(r.n_tokens, r.truncated, r.capped_text) for r in got] == [(3, True, " a  b"), (2, False, "a b"), (0, False, "")]


def test_generated_pairs(spark):
    good = ' {"llamada_api":{"z":1,"a":{"k":null}},"instruccion":"haz"}\n'
    bad = ['{"instruccion":"x"}', "[1]", good + "x", '{"instruccion":null,"llamada_api":1}', None, ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([good, *bad])], "id int, raw string")
    got = corpus.generated_pairs(rows, "raw").orderBy("id").collect()
    assert (got[0].parsed, got[0].instruction, got[0].response) == (True, "haz", '{"z":1,"a":{"k":null}}')
    assert [(r.parsed, r.instruction, r.response) for r in got[1:]] == [(False, None, None)] * 6
    assert [r.raw for r in got] == [good, *bad]


def test_size_bands_and_gate(spark):
    sizes = spark.createDataFrame([(n,) for n in (0, 499, 500, 4999, 5000, 50_000, 50_001, 10**9)], "n bigint")
    got = corpus.with_settings(sizes).orderBy("n").collect()
    assert [r["rank"] for r in got] == [8, 8, 16, 16, 32, 32, 64, 64]
    assert [r["epochs"] for r in got] == [5, 5, 3, 3, 2, 2, 1, 1]
    rows = spark.range(399).select(F.when(F.col("id") < 200, "a").otherwise("b").alias("c"))
    assert {r.corpus: r.passed for r in corpus.minimum_gate(rows, "c").collect()} == {"a": True, "b": False}


def test_prompt_drift(spark):
    rows = spark.createDataFrame([("ok",)] * 50 + [("other",)] * 2 + [(None,)], "s string")
    got = {r.prompt: r.n for r in corpus.prompt_drift(rows, F.col("s"), ["ok"]).collect()}
    assert got == {"other": 2, None: 1}


def test_action_grid_and_request(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b%s",)], "c string")
    grid = corpus.action_grid(rows, "c", ["x", "y"])
    assert sorted(map(tuple, grid.collect())) == [("a", "x"), ("a", "y"), ("b%s", "x"), ("b%s", "y")]
    text = grid.where("category = 'b%s' and action = 'x'").select(chat.example_request(F.col("category"), F.col("action"))).first()[0]
    assert "    Categoría: b%s\n    Acción: x\n" in text and text.endswith('{"instruccion": "...", "llamada_api": {...}}')
    assert corpus.action_grid(rows, "c", [str(k) for k in range(3000)]).count() == 6000


def test_batched_column(spark):
    rows = spark.createDataFrame([("a", "b")], "x string, y string")
    got = batched.with_batched(rows, lambda c: c["x"] + c["y"], ["x", "y"], "z", "string").first()
    assert got.z == "ab"


def test_run_operators(spark):
    rows = spark.createDataFrame(
        [(1, 50, "eval_loss", 0.5), (1, 100, "eval_loss", 0.5), (1, 9, "eval_loss", 0.7), (1, 150, "eval_loss", 0.6),
         (1, 150, "train_runtime", 90.0), (2, 10, "train_loss", 0.1)],
        "run_id bigint, step bigint, metric string, value double")
    assert [tuple(r) for r in runs.best_checkpoint(rows).collect()] == [(1, 50, 0.5)]
    assert sorted(map(tuple, runs.latest_checkpoint(rows).collect())) == [(1, 150)]
    assert [(r.step, r.place) for r in runs.kept_checkpoints(rows).orderBy("place").collect()] == [(50, 1), (100, 2), (150, 3)]
    assert sorted(r.step for r in runs.at_cadence(rows, 50).collect()) == [50, 100, 150, 150]
    assert runs.final_figures(rows).where("run_id = 1").first().runtime_min == 1.5


def test_generated_pairs_take_the_last_of_repeated_keys_as_written(spark):
    rows = [
        ('{"instruccion":"a","llamada_api":{"x":1.50,"x":[1,  2]},"instruccion":"b\\u00e9\\"q","llamada_api":{"z": "k,}"}}', 'bé"q', '{"z": "k,}"}'),
        ('{"llamada_api":"text, \\"q\\" }","instruccion":5}', "5", '"text, \\"q\\" }"'),
        ('{"instruccion":"llamada_api","llamada_api" : [1, 2.0, {"llamada_api": 3}] }', "llamada_api", '[1, 2.0, {"llamada_api": 3}]'),
        ('{"instruccion":"s","llamada\\u005fapi": 1.20e5 }', "s", "1.20e5"),
        ('{"instruccion":"s","llamada_api":{}, "o": "llamada_api", "p": {"llamada_api": 1}}', "s", "{}"),
        ('{"instruccion":"s","llamada_api":"' + "z" * 100_000 + '"}', "s", '"' + "z" * 100_000 + '"'),
        ('{"instruccion":null,"llamada_api":12.30}', None, None), ('{"instruccion":"a","llamada_api":null}', None, None),
        ('{"instruccion":"x"}', None, None), ("{}", None, None), ("[1]", None, None), (None, None, None),
    ]
    df = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(rows)], "id int, raw string")
    got = corpus.generated_pairs(df, "raw").orderBy("id").collect()
    assert [(r.raw, r.instruction, r.response) for r in got] == rows
    assert [r.parsed for r in got] == [r[2] is not None for r in rows]
