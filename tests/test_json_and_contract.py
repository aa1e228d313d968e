"""Strictness of the JSON reading, the three attempts, and the contract rules, with values worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from pactmill import fixed_values as fv
from pactmill.functions import contract, jsontext as jx, text as tx
from pactmill.operators import evaluation as ev

GOOD = '{"endpoint":"/api/v2/x","method":"GET","headers":{},"body":null}'
NBSP = " "

STRICT = [
    ('{"a":1}', True),
    ('{"a":1} tail', False),
    ('{"a":1},{"b":2}', False),
    ('{"a":1}],[{"b":2}', False),
    ('1,"~E~"] x', False),
    ('1,2', False),
    ("{'a':1}", False),
    ('{"a":"x\ny"}', False),
    ('{"a":NaN}', False),
    ('{"a":-Infinity}', False),
    ('{"a":1,"a":2}', True),
    ('{"a":1e400}', True),
    ('{"a":null}', True),
    ("null", True),
    ("12", True),
    ('"text"', True),
    ("true", True),
    ("[1,2]", True),
    (" [1] ", True),
    ("{a:1}", False),
    ('{"a":1,}', False),
    ("01", False),
    ("", False),
    ("}{", False),
    ("/* c */ 1", False),
    ("[1] // c", False),
    (None, False),
]


def answers(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "case_id bigint, raw string")


def judged(spark, texts, exact=False):
    rows = ev.evaluate(answers(spark, texts), exact=exact).orderBy("case_id").collect()
    return [(r.status, r.strategy, list(r.missing), r.method_valid, r.endpoint_valid, r.valid, round(r.score, 4))
            for r in rows]


def test_strict_json_matrix(spark):
    rows = answers(spark, [t for t, _ in STRICT])
    got = [r.ok for r in rows.select("case_id", jx.strict_json(F.col("raw")).alias("ok")).orderBy("case_id").collect()]
    assert got == [ok for _, ok in STRICT]


def test_strict_json_agrees_with_python_reader(spark):
    texts = [t for t, _ in STRICT if t is not None and "NaN" not in t and "Infinity" not in t]
    def python_ok(text):
        try:
            json.loads(text)
            return True
        except ValueError:
            return False
    rows = answers(spark, texts)
    got = [r.ok for r in rows.select("case_id", jx.strict_json(F.col("raw")).alias("ok")).orderBy("case_id").collect()]
    assert got == [python_ok(t) for t in texts]


def test_exact_reading_accepts_nan(spark):
    text = '{"endpoint":"/api/x","method":"PUT","headers":NaN,"body":-Infinity}'
    assert judged(spark, [text])[0][0] == "invalid"
    assert judged(spark, [text], exact=True) == [("ok", 1, [], True, True, True, 1.0)]


ALL = list(fv.REQUIRED_FIELDS)
CASES = [
    (GOOD, ("ok", 1, [], True, True, True, 1.0)),
    (f" {NBSP} {GOOD}　\n", ("ok", 1, [], True, True, True, 1.0)),
    (f"Answer: {GOOD} Done.", ("ok", 2, [], True, True, True, 1.0)),
    (f"```json\n{GOOD}\n```", ("ok", 2, [], True, True, True, 1.0)),
    (f"```json\n{NBSP}{GOOD}\n``` note }}", ("ok", 3, [], True, True, True, 1.0)),
    ("see ```json [1,2] ``` ok", ("not_object", 3, ALL, False, False, False, 0.0)),
    ("see ```json``` ok", ("invalid", 0, ALL, False, False, False, 0.0)),
    ("see ```json {} and no end", ("ok", 2, ALL, False, False, False, 0.0)),
    ("```json x ``` ```json {\"a\":1} ``` }", ("invalid", 0, ALL, False, False, False, 0.0)),
    (f"{GOOD} x {GOOD}", ("invalid", 0, ALL, False, False, False, 0.0)),
    ("}{", ("invalid", 0, ALL, False, False, False, 0.0)),
    ("", ("invalid", 0, ALL, False, False, False, 0.0)),
    (None, ("invalid", 0, ALL, False, False, False, 0.0)),
    ("null", ("not_object", 1, ALL, False, False, False, 0.0)),
    ('"text"', ("not_object", 1, ALL, False, False, False, 0.0)),
    ('{"method":null,"endpoint":null,"headers":null,"body":null}', ("ok", 1, [], False, False, False, 0.64)),
    ('{"method":["GET"],"endpoint":5,"headers":1,"body":2}', ("ok", 1, [], False, False, False, 0.64)),
    ('{"endpoint":"/api/x","method":" get","body":{}}', ("ok", 1, ["headers"], False, True, False, 0.6)),
    ('{"endpoint":"/api/x","method":"patch","body":{},"headers":{}}', ("ok", 1, [], True, True, True, 1.0)),
    ('{"endpoint":"api/x","method":"DELETE"}', ("ok", 1, ["headers", "body"], True, False, False, 0.4)),
    ('{"endpoint":"/v1","endpoint":"/api/x","method":"PUT","headers":1,"body":1}',
     ("ok", 1, [], True, True, True, 1.0)),
    ('{"inner":{"endpoint":"/api/x","method":"GET"}}', ("ok", 1, ALL, False, False, False, 0.0)),
]


@pytest.mark.parametrize("exact", [False, True])
def test_extraction_and_contract(spark, exact):
    assert judged(spark, [t for t, _ in CASES], exact) == [want for _, want in CASES]


def test_score_stays_between_zero_and_one(spark):
    rows = ev.evaluate(answers(spark, [t for t, _ in CASES])).agg(F.min("score"), F.max("score")).first()
    assert 0 <= rows[0] and rows[1] <= 1


def test_own_error_key_is_shown_raw_but_still_evaluated(spark):
    text = 'x {"error":1,"endpoint":"/api/x","method":"GET","headers":1,"body":1}'
    rows = ev.displayed(ev.check(ev.extract(answers(spark, [text, f"x {GOOD}", "bad"])))).orderBy("case_id").collect()
    assert [r.shown for r in rows] == [text, GOOD, "bad"]
    assert rows[0].status == "ok" and rows[0].valid


def test_displayed_with_indentation_matches_python(spark):
    row = ev.displayed(ev.extract(answers(spark, ['{"z":[1,{"ñ":null}],"a":1.50}'])), width=4).first()
    assert row.shown == json.dumps({"z": [1, {"ñ": None}], "a": 1.5}, ensure_ascii=False, indent=4)


def test_long_text_is_read_whole(spark):
    long = '{"endpoint":"/api/x","method":"GET","headers":{},"body":"' + "a" * 3_000_000 + '"}'
    assert judged(spark, [long, long[:-1]]) == [
        ("ok", 1, [], True, True, True, 1.0), ("invalid", 0, ALL, False, False, False, 0.0)
    ]


def test_quarantine_keeps_raw_text(spark):
    rows = ev.quarantine(ev.extract(answers(spark, [GOOD, "bad", "[1]"]))).orderBy("case_id").collect()
    assert [tuple(r) for r in rows] == [(1, "invalid", "bad"), (2, "not_object", "[1]")]


def test_summary_of_no_rows_has_no_mean(spark):
    rows = answers(spark, ["x"]).withColumn("elapsed_ms", F.lit(5)).where("case_id > 5")
    got = ev.summary(ev.evaluate(rows)).first()
    assert (got.n, got.n_valid, got.mean_score, got.verdict, got.mean_latency_s) == (0, 0, None, None, None)


def test_summary_and_detail(spark):
    rows = answers(spark, [GOOD, "bad", '{"endpoint":"/api/x","method":"GET","headers":1}']).withColumn(
        "elapsed_ms", F.lit(1500))
    got = ev.summary(ev.evaluate(rows)).first()
    assert (got.n, got.n_valid, got.mean_score, got.mean_latency_s) == (3, 1, 0.583333, 1.5)
    assert got.verdict == "improvable"
    listed = ev.detail(ev.evaluate(rows)).orderBy("case_id").collect()
    assert [(r.i, r.n) for r in listed] == [(1, 3), (2, 3), (3, 3)]


def test_verdict_limits(spark):
    means = spark.createDataFrame([(0.9,), (0.8999,), (0.7,), (0.6999,), (None,)], "m double")
    assert [r[0] for r in means.select(contract.verdict(F.col("m"))).collect()] == [
        "excellent", "good", "good", "improvable", None]


def test_strip_equals_python_strip(spark):
    spaces = [chr(c) for c in range(0x10000) if chr(c).isspace()]
    texts = [s + "a" + s + "b" + s for s in spaces] + ["﻿a", "a​", " "]
    got = [r.s for r in answers(spark, texts).select("case_id", tx.strip(F.col("raw")).alias("s")).orderBy("case_id").collect()]
    assert got == [t.strip() for t in texts]


@pytest.mark.parametrize("width", [2, 4])
def test_indented_layout_of_structs(spark, width):
    shape = "a string, b struct<n: bigint, l: array<struct<x: string, y: array<int>>>, e: struct<z: boolean>>, m: map<string, array<string>>, d: double, ñ: string"
    rows = [
        ("q\"uote\\ \n", (1, [("x", [1, 2]), (None, []), None], (True,)), {"k ñ": ["v", None], "empty": []}, 1.5, "año"),
        (None, None, {}, None, ""),
        ("", (None, [], None), None, -0.25, "\U0001f600"),
    ]
    df = spark.createDataFrame([(r,) for r in rows], f"v struct<{shape.replace('a string', 'a: string').replace(', m:', ', m:').replace('b struct', 'b: struct').replace('ñ: string', '`ñ`: string')}>")

    def plain(value):
        if hasattr(value, "asDict"):
            return {k: plain(v) for k, v in zip(value.__fields__, value)}
        if isinstance(value, dict):
            return {k: plain(v) for k, v in value.items()}
        return [plain(v) for v in value] if isinstance(value, list) else value

    got = df.select("v", jx.encode_indented(F.col("v"), df.schema["v"].dataType, width).alias("t")).collect()
    for row in got:
        assert row.t == json.dumps(plain(row.v), ensure_ascii=False, indent=width)
