"""Chunk assembly in batch and stream, pairing, and the caller's generation function."""

import datetime
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from pactmill.operators import answers as an, evaluation as ev
from pactmill.sources import readers
from pactmill.streaming import assembly, scoring

T0 = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


def line(request, seq, content, done=False, at=None):
    ts = T0 + datetime.timedelta(seconds=seq if at is None else at)
    message = {} if content is None else {"content": content}
    return json.dumps({"request_id": request, "seq": seq, "ts": ts.isoformat(), "message": message, "done": done})


def feed(folder, batches):
    folder.mkdir()
    for i, lines in enumerate(batches):
        (folder / f"{i:03}.json").write_text("\n".join(lines) + "\n")
        # file streams take files in order of their time of change
        stamp = 1_700_000_000 + i
        os.utime(folder / f"{i:03}.json", (stamp, stamp))


def streamed(spark, tmp_path, batches, **how):
    feed(tmp_path / "in", batches)
    chunks = readers.chunk_line_stream(spark, str(tmp_path / "in"), files_per_trigger=1).where("request_id is not null")
    query = (
        assembly.assembled(chunks, **how).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.read.schema(assembly.OUTPUT).parquet(str(tmp_path / "out")).collect()
    return sorted((r.request_id, r.answer, r.how) for r in rows)


def test_stream_emits_once_and_absorbs_late_chunks(spark, tmp_path):
    got = streamed(spark, tmp_path, [
        [line("a", 0, "he"), line("b", 1, "B"), ""],
        [line("a", 2, "o", True), line("a", 1, "ll")],
        [line("a", 3, "late"), line("b", 0, "A"), line("b", 2, None, True)],
    ])
    assert got == [("a", "hello", "done"), ("b", "AB", "done")]


def test_stream_waits_for_missing_chunks(spark, tmp_path):
    got = streamed(spark, tmp_path, [
        [line("a", 0, "x"), line("a", 2, "z", True)],
        [line("a", 1, "y")],
    ])
    assert got == [("a", "xyz", "done")]


def test_stream_time_out_and_gap(spark, tmp_path):
    got = streamed(spark, tmp_path, [
        [line("slow", 0, "never"), line("gap", 0, "x"), line("gap", 2, "z", True)],
        [line("clock", 0, "t", True, at=130)],
        [line("clock2", 0, "t", True, at=400)],
        [line("clock3", 0, "t", True, at=800)],
    ])
    assert ("slow", "", "timeout") in got and ("gap", "xz", "gap") in got
    assert len(got) == 5


def test_a_batch_leaves_the_state_of_other_requests_alone(spark, tmp_path):
    """10,000 requests are open; a batch with one chunk of one of them writes that one's state and nothing else."""
    feed(tmp_path / "in", [
        [line(f"r{k}", 0, "x" * 50, at=1) for k in range(10_000)],
        [line("r7", 1, "y", True, at=2)],
    ])
    chunks = readers.chunk_line_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    query = (
        assembly.assembled(chunks).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    first, second = [p.stateOperators[0] for p in query.recentProgress if p.numInputRows][:2]
    assert first.numRowsUpdated >= 10_000 and second.numRowsTotal >= 19_990
    assert second.numRowsUpdated + second.numRowsRemoved <= 5
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("r7", "x" * 50 + "y", "done")]


def test_stream_takes_repeated_chunks_and_moves_its_timer(spark, tmp_path):
    got = streamed(spark, tmp_path, [
        [line("twice", 0, "old"), line("slow", 0, "a", at=0), line("quiet", 0, "q", at=0)],
        [line("twice", 0, "new"), line("slow", 1, "b", at=100), line("quiet", 1, "q", at=100)],
        [line("clock", 0, "t", True, at=150)],  # past the first time-out of the slow ones, not past that of their last chunks
        [line("slow", 2, "c", True, at=160), line("twice", 1, "!", True, at=160)],
        [line("clock2", 0, "t", True, at=900)],
    ])
    assert got == [
        ("clock", "t", "done"), ("clock2", "t", "done"), ("quiet", "", "timeout"), ("slow", "abc", "done"), ("twice", "new!", "done"),
    ]


def test_requests_that_are_done_at_once_share_state_rows(spark, tmp_path):
    """A batch of 40,000 whole answers leaves a state row a group, not one or more a request."""
    feed(tmp_path / "in", [[line(f"r{k}", 0, "x", True, at=k % 50) for k in range(40_000)], [line("r7", 1, "late", at=40), line("z", 0, "z", True, at=900)]])
    chunks = readers.chunk_line_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    query = (
        assembly.assembled(chunks).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    first = next(p.stateOperators[0] for p in query.recentProgress if p.numInputRows)
    assert 0 < first.numRowsUpdated <= 20_000
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == 40_001 and rows.where("how <> 'done'").count() == 0


def test_times_that_pandas_cannot_hold(spark, tmp_path):
    """Neither late years nor rows without a time end the stream or move its clock."""
    none = json.dumps({"request_id": "n", "seq": 0, "message": {"content": "n"}})
    feed(tmp_path / "in", [[line("a", 0, "a"), none], [line("a", 1, "!", True), line("far", 0, "x", True).replace("2024-", "9999-")]])
    chunks = readers.chunk_line_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    query = (
        assembly.assembled(chunks, keep_unusable=True).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = [tuple(r) for r in spark.read.schema(assembly.OUTPUT).parquet(str(tmp_path / "out")).collect()]
    assert sorted(g for g in got if g[0]) == [("a", "a!", "done"), ("far", "x", "done")]
    assert [(json.loads(g[1])["request_id"], g[2]) for g in got if not g[0]] == [("n", "unusable")]


def test_requests_of_one_group_keep_apart(spark, tmp_path):
    """All requests in one group: more batches than packs, late chunks, a time-out set anew, gaps and time-outs in between."""
    batches = [[line(f"d{k}", 0, "d", True, at=k), line(f"d{k - 1}", 1, "late", at=k)] for k in range(1, 21)]
    batches[0] += [line("slow", 0, "a", at=0), line("quiet", 0, "q", at=0), line("gap", 0, "g", at=1), line("d0", 0, "d", True, at=0)]
    batches[5] += [line("gap", 2, "p", True, at=6)]
    batches += [
        [line("slow", 1, "b", at=100)],
        [line("clock", 0, "t", True, at=160)],
        [line("slow", 2, "c", True, at=170), line("d20", 2, "late", at=160)],
        [line("clock2", 0, "t", True, at=900)],
        [line("clock3", 0, "t", True, at=1800)],
    ]
    got = streamed(spark, tmp_path, batches, groups=1)
    done = [("clock", "t", "done"), ("clock2", "t", "done"), ("clock3", "t", "done"), ("slow", "abc", "done"), ("quiet", "", "timeout"), ("gap", "gp", "gap")]
    done += [("d0", "dlate", "done")]  # it came in the same batch
    assert got == sorted([(f"d{k}", "d", "done") for k in range(1, 21)] + done)


def test_stream_equals_batch_with_a_hot_request_in_parts(spark, tmp_path):
    hot = [line("hot", i, f"{i},", i == 99, at=1) for i in range(100)]
    cold = [line(f"r{i}", s, f"{i}-{s}", s == 2, at=2) for i in range(20) for s in range(3)]
    lines = hot[::2] + cold + hot[1::2]
    got = streamed(spark, tmp_path, [lines[:80], lines[80:120], lines[120:]])
    batch = an.assemble(
        readers.chunk_lines(spark, str(tmp_path / "in")).where("request_id is not null"), part_rows=16
    ).collect()
    assert [g[:2] for g in got] == sorted((r.request_id, r.answer) for r in batch)
    assert [g[1:] for g in got if g[0] == "hot"] == [("".join(f"{i}," for i in range(100)), "done")]


def test_batch_assembly_appends_after_the_final_chunk(spark):
    rows = spark.createDataFrame(
        [("a", 2, "!", False), ("a", 0, "x", False), ("a", 1, None, True)], "request_id string, seq bigint, content string, done boolean")
    assert [tuple(r) for r in an.assemble(rows).collect()] == [("a", "x!")]


def test_chunk_lines_skip_blanks_and_keep_bad_lines(spark, tmp_path):
    feed(tmp_path / "in", [[line("a", 0, "x"), "", '{"request_id": "b', line("a", 1, None, True)]])
    rows = readers.chunk_lines(spark, str(tmp_path / "in")).collect()
    assert len(rows) == 3
    assert [r._corrupt_record for r in rows if r.request_id is None] == ['{"request_id": "b']
    assert {(r.seq, r.content, r.done) for r in rows if r.request_id} == {(0, "x", False), (1, None, True)}


def test_streamed_scoring_and_totals(spark, tmp_path):
    good = '{"endpoint":"/api/x","method":"GET","headers":{},"body":{}}'
    feed(tmp_path / "in", [
        [line("a", 0, good[:20]), "{broken", '{"request_id": "a", "content": "no place"}', line("b", 0, "no json", True)],
        [line("a", 1, good[20:], True)],
    ])
    chunks = readers.chunk_line_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    out, totals = str(tmp_path / "scored"), str(tmp_path / "totals")
    scoring.start_scoring(assembly.assembled(chunks), out, str(tmp_path / "c1")).awaitTermination()
    rows = spark.read.schema(scoring.SCORED).parquet(out).orderBy("request_id").collect()
    assert [(r.request_id, r.valid, r.score) for r in rows] == [("a", True, 1.0), ("b", False, 0.0)]
    scoring.start_totals(spark, out, totals, str(tmp_path / "c2")).awaitTermination()
    got = scoring.latest_totals(spark, totals).first()
    assert (got.n_valid, got.n, got.mean_score) == (1, 2, 0.5)
    # a batch is scored again: its folder is replaced and its files are new to the totals
    folder = next(str(p) for p in (tmp_path / "scored").iterdir() if p.name.startswith("batch_id="))
    again = spark.createDataFrame(spark.read.parquet(folder).collect(), spark.read.parquet(folder).schema)
    again.write.mode("overwrite").parquet(folder)
    scoring.start_totals(spark, out, totals, str(tmp_path / "c2")).awaitTermination()
    assert scoring.latest_totals(spark, totals).first() == got
    batch = ev.summary(ev.evaluate(spark.createDataFrame([("a", good), ("b", "no json")], "id string, raw string")),
                       elapsed_ms=None).first()
    assert (batch.n_valid, batch.n, batch.mean_score) == (got.n_valid, got.n, got.mean_score)


def test_pairing_keeps_every_case_and_every_answer(spark):
    cases = spark.range(100).withColumnRenamed("id", "case_id")
    # one case holds most answers
    given = spark.range(1000).select(F.when(F.col("id") < 900, 5).otherwise(F.col("id") % 50).alias("case_id"),
                                     F.col("id").cast("string").alias("raw"))
    got = an.pair_with_cases(cases, given)
    plain = cases.join(given, "case_id", "left").fillna({"raw": ""})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.select(*got.columns).collect()))
    assert got.where("raw = ''").count() == 50


def test_pairing_of_larger_tables_starts_from_more_partitions(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.conf.unset(name)
    cases = spark.range(4_000_000).withColumnRenamed("id", "case_id")  # planned at 32 MB
    try:
        got = an.pair_with_cases(cases, cases.where("case_id % 2 = 0").withColumn("raw", F.lit("x")))
        assert int(spark.conf.get(name)) >= 16
        assert got.groupBy("raw").count().orderBy("raw").collect() == [("", 2_000_000), ("x", 2_000_000)]
    finally:
        spark.conf.unset(name)


def test_the_model_goes_on_while_answers_are_read(tmp_path):
    calls = tmp_path / "calls"

    def load():
        def answer(text):
            with open(calls, "a") as file:
                file.write(text)
            return text
        return answer

    caller = an._Caller(load, None, 5.0)
    try:
        answers = caller.call([["a"], ["b"], ["c"]])
        assert next(answers)[:2] == (["a"], None)
        until = time.time() + 5
        while calls.read_text() != "abc" and time.time() < until:
            time.sleep(0.01)
        assert calls.read_text() == "abc"  # two calls were made that nobody has asked for yet
        assert [said for said, _, _ in answers] == [["b"], ["c"]]
    finally:
        caller.end()


def test_generation_goes_on_after_failures(spark):
    def load():
        def answer(text):
            if text == "bad":
                raise RuntimeError("down")
            return text.upper()
        return answer

    rows = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, "fine")], "case_id bigint, q string")
    got = an.generate(rows, "q", load, ["case_id"]).orderBy("case_id").collect()
    assert [(r.raw, r.error) for r in got] == [("OK", None), ("", "RuntimeError: down"), ("FINE", None)]
    assert all(r.elapsed_ms >= 0 for r in got)
    assert ev.evaluate(an.generate(rows, "q", load, ["case_id"])).where("score > 0").count() == 0


def test_bad_chunks_go_to_the_quarantine(spark, tmp_path):
    feed(tmp_path / "in", [["{broken", '{"request_id": "a", "content": "no place"}', line("a", 0, "x", True)]])
    rows = readers.chunk_lines(spark, str(tmp_path / "in"))
    assert assembly.unusable(rows).count() == 2


def test_a_hanging_call_ends_and_models_are_called_once_per_case(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def load():
        def answer(text):
            import time as clock
            with open(calls, "a") as file:
                file.write("x")
            if text == "hang":
                clock.sleep(60)
            return text
        return answer

    rows = spark.createDataFrame([(k, "hang" if k == 3 else "ok") for k in range(6)], "case_id bigint, q string")
    given = an.generate(rows, "q", load, ["case_id"], limit_s=1.0)
    numbered = ev.evaluate(ev.detail(given)).collect()
    assert [(r.raw, r.error) for r in numbered if r.case_id == 3] == [("", "TimeoutError: no answer within 1 s")]
    assert len(numbered) == 6 and len(open(calls).read()) == 6


def test_a_call_that_hangs_leaves_no_process(spark, tmp_path):
    folder = tmp_path / "pids"
    folder.mkdir()

    def load():
        import os as system
        import time as clock

        (folder / str(system.getpid())).write_text("")

        def answer(text):
            if text == "hang":
                clock.sleep(600)
            if text == "die":
                system._exit(1)
            return text.upper()
        return answer

    rows = spark.createDataFrame([(k, q) for k, q in enumerate(["a", "hang", "b", "die", "c"])], "case_id bigint, q string").coalesce(1)
    got = an.generate(rows, "q", load, ["case_id"], limit_s=1.0).orderBy("case_id").collect()
    assert [r.raw for r in got] == ["A", "", "B", "", "C"]
    assert [r.error for r in got] == [None, "TimeoutError: no answer within 1 s", None, "ChildProcessError: the model's process ended", None]
    pids = [int(p.name) for p in folder.iterdir()]
    assert len(pids) == 3  # loaded again after each of the two
    assert not [pid for pid in pids if os.path.exists(f"/proc/{pid}") and "Z" not in open(f"/proc/{pid}/stat").read().split()[2]]


def test_batches_are_full_but_for_the_last(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def load():
        def answer(texts):
            with open(calls, "a") as file:
                file.write(f"{len(texts)}\n")
            return [t.upper() for t in texts] if "short" not in texts else ["one"]
        return answer

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = spark.createDataFrame([(k, "short" if k == 30 else f"t{k}") for k in range(50)], "case_id bigint, q string").coalesce(1)
        got = an.generate(rows, "q", load, ["case_id"], batch=16).orderBy("case_id").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert open(calls).read().split() == ["16", "16", "16", "2"]
    assert [r.raw for r in got] == ["" if 16 <= k < 32 else f"T{k}" for k in range(50)]
    assert {r.error for r in got if 16 <= r.case_id < 32} == {"ValueError: 1 answers to 16 texts"}


def test_a_model_that_cannot_be_loaded_fails_the_job(spark):
    def load():
        raise OSError("no such model")

    rows = spark.createDataFrame([(1, "a")], "case_id bigint, q string")
    with pytest.raises(Exception, match="could not be loaded: OSError: no such model"):
        an.generate(rows, "q", load, ["case_id"])


def test_one_query_writes_scores_and_unusable_lines(spark, tmp_path):
    good = '{"endpoint":"/api/x","method":"GET","headers":{},"body":{}}'
    feed(tmp_path / "in", [
        [line("a", 0, good[:20]), "{broken", '{"request_id": "a", "content": "no place"}'],
        [line("a", 1, good[20:], True), "[1"],
    ])
    chunks = readers.chunk_line_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    out, bad = str(tmp_path / "scored"), str(tmp_path / "bad")
    answers = assembly.assembled(chunks, keep_unusable=True)
    query = scoring.start_scoring(answers, out, str(tmp_path / "ck"), unusable=bad)
    query.awaitTermination()
    assert [(r.request_id, r.score) for r in spark.read.schema(scoring.SCORED).parquet(out).collect()] == [("a", 1.0)]
    lines = [json.loads(r.line) for r in spark.read.parquet(bad).collect()]
    assert sorted(one.get("_corrupt_record") or one["request_id"] for one in lines) == ["[1", "a", "{broken"]
    assert len(query.lastProgress.sources) == 1


def test_a_replayed_batch_leaves_one_copy_in_both_sinks(spark, tmp_path):
    out, bad = str(tmp_path / "scored"), str(tmp_path / "bad")
    batch = spark.createDataFrame([("a", "{}", "done"), (None, "line", assembly.UNUSABLE)], assembly.OUTPUT)
    for _ in range(2):
        scoring.batch_writer(out, bad)(batch, 7)
    assert spark.read.schema(scoring.SCORED).parquet(out).count() == 1 and [r.line for r in spark.read.parquet(bad).collect()] == ["line"]
