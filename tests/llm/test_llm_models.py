"""Trained operators by held-out accuracy, extraction by hand-made pages, all registered queries, and the pipeline."""

import glob
import hashlib
import os
import sys
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as entry
import check_queries
import corpus_pipeline
from pactmill import session
from pactmill.llm import byte_bpe, language_id, main_text, queries, toxicity
from test_llm_tables import lowered, near_brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
SPECIAL = [(9_001, None), (9_002, ""), (9_003, "123 !?"), (9_004, " \n"), (9_005, "the " * 60_000), (9_006, "É"), (None, "the and of")]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# language


@needs_tables
def test_language_held_out_accuracy(documents):
    net = language_id.fit(documents.where(language_id.remainder("doc_id", 4) != 2))
    found = language_id.predicted(documents, net).where(language_id.remainder("row.doc_id", 4) == 2).collect()
    right = [r.lang_pred == r.row.lang for r in found]
    assert len(right) > 200 and np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_language_special_texts(docs):
    df = docs(SPECIAL + SPECIAL[:1])
    net = language_id.train(["the cat and the dog of it"] * 20 + ["el gato y la casa de los"] * 20, ["en"] * 20 + ["es"] * 20, steps=60)
    got = language_id.predicted(df, net).collect()
    assert len(got) == len(SPECIAL) + 1 and got[0].row.asDict().keys() == set(df.columns)
    by_key = {r.row.doc_id: r for r in got}
    assert all(by_key[k].lang_pred == "und" and by_key[k].score == 0 for k in (9_001, 9_002, 9_003, 9_004))
    assert by_key[9_005].lang_pred == "en" and by_key[9_006].lang_pred in ("en", "es")
    assert {r.lang_pred for r in language_id.predicted(df, None).collect()} == {"und"}
    assert language_id.fit(df) is None and language_id.predicted(df.limit(0), net).count() == 0
    kept = language_id.recognised(df, net)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} <= {9_005, 9_006, None}


def test_windows_cover_whole_texts():
    data, at = language_id.texts_as_bytes(__import__("pyarrow").array(["a" * 1000, None, "", "b", "c" * 256]))
    covered = Counter()
    for codes, text, size in language_id.windows(data, at):
        assert ((codes > 0).sum(axis=1) == size).all()
        for t, n in zip(text, size):
            covered[int(t)] += int(n)
    assert covered == {0: 1000, 3: 1, 4: 256}


def test_network_gradients():
    rng = np.random.default_rng(0)
    net = language_id.train(["ab cd ef gh"] * 3 + ["xy zw uv"] * 3, ["p"] * 3 + ["q"] * 3, steps=1)
    codes, target = rng.integers(1, 40, (4, 20)).astype(np.uint8), np.array([0, 1, 1, 0])

    def loss():
        return -net.log_probabilities(codes, net.pair_tables())[np.arange(4), target].mean()

    grads = language_id._gradients(net, codes, target)
    for weight, grad in zip([*net.filters, net.bias, net.dense, net.offset], grads):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        before = weight[at]
        weight[at] = before + 1e-2
        up = loss()
        weight[at] = before - 1e-2
        down = loss()
        weight[at] = before
        assert abs((up - down) / 2e-2 - grad[at]) < 0.05 * abs(grad[at]) + 1e-3


# toxicity


@needs_tables
def test_toxicity_held_out(documents, spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    held = language_id.remainder("doc_id", 5) == 0
    model = toxicity.fit(documents, labels.where(~held))
    rows = toxicity.scored(documents, model).join(labels, "doc_id").where(held).select("score", "toxic").collect()
    toxic, clean = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    ahead = np.mean([t > c for t in toxic for c in clean])
    assert len(toxic) >= 5 and ahead > 0.9


def test_toxicity_locates_sentences(docs):
    clean = [f"This is number {k} of the texts. Nothing to see here today. All of it is fine." for k in range(120)]
    toxic = [c.replace("today", "you idiot") for c in clean[:40]]
    model = toxicity.train(clean[40:] + toxic, [0] * 80 + [1] * 40)
    df = docs(SPECIAL + [(1, toxic[3]), (2, clean[50]), (2, clean[50])])
    got = toxicity.scored(df, model).collect()
    assert len(got) == len(SPECIAL) + 3
    by_key = {r.doc_id: r for r in got}
    assert by_key[1].score > 0.5 > by_key[2].score
    assert [toxic[3][s.begin:s.end].strip() for s in by_key[1].offending] == ["Nothing to see here you idiot"]
    assert all(by_key[k].score == 0 and by_key[k].offending == [] for k in (9_001, 9_002, 9_004))
    assert {r.score for r in toxicity.scored(df, None).collect()} == {0.0}
    assert toxicity.fit(df, df.selectExpr("doc_id", "1 as toxic")) is None
    assert toxicity.scored(df.limit(0), model).count() == 0


# main text

LONG, MORE = "Some words of the article that run on. " * 8, "And further words of the same kind, a few. " * 6
PAGES = [
    (None, ""), ("", ""), ("<p>", ""), ("just text", "just text"), ("<html><head><title>t</title></head><body></body></html>", ""),
    (f"<nav><a>Home</a></nav><article><h1>Title</h1><p>{LONG}<p>short<p>{MORE}</article><footer>f</footer>", f"Title\n{LONG.strip()}\nshort\n{MORE.strip()}"),
    (f"<div id='sidebar'><p>{MORE}</p></div><div class='post'><h2>T</h2><p>{LONG}</p><p>x</p><p>{MORE}</p></div><div class='cookie-notice'>{MORE}</div>",
     f"T\n{LONG.strip()}\nx\n{MORE.strip()}"),
    (f"<article><p>{LONG}</p><div class='comments'><p>{MORE}</p></div><form><p>{MORE}</p></form><aside>{MORE}</aside></article>", LONG.strip()),
    (f"<article><p>a &amp; b &lt;c&gt; &#233; &quot;d&quot;\n\t e <b>bold</b><i>er</i></p><script>x='</p>'</script><style>p{{}}</style><!-- {MORE} --><p>{LONG}</p>",
     f"a & b <c> é \"d\" e bolder\n{LONG.strip()}"),
    (f"<header><p>{MORE}</p></header><main><header><h1>H</h1></header><p>{LONG}</p></main>", f"H\n{LONG.strip()}"),
    (f"<nav><ul><li>a<li>b<article><p>{LONG}</p>", LONG.strip()),
    ("<article><p>" + "<b>" * 5_000 + "deep" + "</b>" * 5_000, "deep"),
]


PROSE = "Long prose goes on and on here, line by line. " * 4
MENU = "".join(f"<li><a href='/{k}'>entry {k}</a></li>" for k in range(12))
# content that only the clusters tell from the rest: no article, or menus without a name inside of one
CLUSTERED = [
    (f"<body><div><ul>{MENU}</ul></div><div><h1>Head</h1><p>{PROSE}</p><p>short</p><p>{PROSE}</p></div><div><a>a</a> <a>b</a></div><div>Imprint</div></body>",
     f"Head\n{PROSE.strip()}\nshort\n{PROSE.strip()}"),
    (f"<article><p>{PROSE}</p><p>{PROSE}</p><ul>{MENU}</ul></article>", f"{PROSE.strip()}\n{PROSE.strip()}"),
    (f"<article><p>teaser</p></article><article><p>{PROSE}</p><p>end</p></article>", f"{PROSE.strip()}\nend"),
    (f"<body><div>Login</div><div>Basket</div><div><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div><div>Terms</div><div>Imprint</div></body>",
     "\n".join([PROSE.strip()] * 3)),
]
# names that only contain a listed word, or that stand around the content itself
NAMED = [
    (f"<nav><a>x</a></nav><div class='{name}'><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div>", "\n".join([PROSE.strip()] * 3))
    for name in ("widget-area", "post-navigation-free", "notice", "comments")
] + [
    (f"<div id='social-history'><p>{PROSE}</p><p>{PROSE}</p></div>", "\n".join([PROSE.strip()] * 2)),
    (f"<article><p>{PROSE}</p><div class='notice-board'>{PROSE}</div><div class='notice'>{PROSE}</div></article>", "\n".join([PROSE.strip()] * 2)),
]


@pytest.mark.parametrize("html,text", CLUSTERED + NAMED)
def test_main_text_through_the_clusters(html, text):
    assert main_text.main_text(html) == text


def test_smoothing_and_clustering_decide(monkeypatch):
    wrong = lambda: [k for k, (html, text) in enumerate(CLUSTERED) if main_text.main_text(html) != text]
    with monkeypatch.context() as patch:
        patch.setattr(main_text, "threshold", lambda values: 0.0)  # one cluster
        assert wrong() == [0, 1]
    page = f"<body><div>Login</div><p>{PROSE}</p><div>x</div><div>y</div><div>z</div><p>{LONG}</p><p>in between</p><p>{LONG}</p><p>{LONG}</p></body>"
    kept = main_text.main_text(page)
    monkeypatch.setattr(main_text, "smoothed", lambda values: values)
    assert main_text.main_text(page) != kept and "in between" in kept


def test_main_text_takes_time_in_proportion():
    for html in ("<div>x" * 60_000, "x" + "</p></i>" * 100_000, "<article><div>x" * 30_000, "<div class=nav><span>x" * 20_000):
        began = time.process_time()
        main_text.main_text(html)
        assert time.process_time() - began < 30, html[:30]


@pytest.mark.parametrize("html,text", PAGES)
def test_main_text(html, text):
    assert main_text.main_text(html) == text


def test_broken_declarations_do_not_stop_the_parser():
    for html in ("<![foo <p>" + LONG, "<!DOCTYPE <p>" + LONG, "<!-- never closed " + LONG, "<p " * 2000, "&#x110000; &#0; " + LONG, "<" * 3000):
        assert isinstance(main_text.main_text(html), str)


def test_extracted_table(spark):
    df = spark.createDataFrame([(k % 9, html) for k, (html, _) in enumerate(PAGES)] + [(None, None)], "page_id bigint, html string")
    df = df.selectExpr("*", "'u' as url", "'clash' as text", "1 as _x")
    got = main_text.extracted(df, also=("url",))
    assert got.columns == ["page_id", "url", "text"] and got.count() == len(PAGES) + 1
    assert Counter(r.text for r in got.collect()) == Counter([t for _, t in PAGES] + [""])
    assert main_text.extracted(df.limit(0)).count() == 0


def test_smoothing_and_threshold():
    flat = main_text.smoothed(np.ones(9))
    assert np.allclose(flat[3:6], 1) and len(main_text.smoothed(np.ones(1))) == 1
    assert 1 < main_text.threshold(np.array([0.0, 1, 1, 50, 60])) < 50


# registered queries


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    said = check_queries.compare(name, entry.queries()[name](spark, SF_DIR), entry.oracle_sql()[name], con)
    assert said.startswith("ok"), said


@needs_tables
def test_queries_return_their_columns(spark, documents):
    n = documents.count()
    for name, columns in (
        ("op1_near_dedup", {"doc_id", "n_shingles", "component_id", "kept"}), ("op3_toxicity", {"doc_id", "held_out", "score", "predicted"}),
        ("op5_language", {"doc_id", "held_out", "lang_pred", "score"}), ("op10_byte_bpe", {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}),
        ("op6_shards", {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}),
    ):
        df = entry.queries()[name](spark, SF_DIR)
        assert set(df.columns) == columns and df.count() == n
    held = entry.queries()["op5_language"](spark, SF_DIR).where("held_out").collect()
    assert {r.doc_id for r in held} == {k for k in range(n) if zlib.crc32(str(k).encode()) % 4 == 2}


@needs_tables
def test_pipeline(spark, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mix", "bpe"]
    docs, kept = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == documents.columns
        kept.append(docs.count())
    n = documents.count()
    lowered = documents.select(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("t")).distinct().count()
    assert kept[0] >= 0.98 * n and kept[1] <= lowered and kept[2] <= kept[1] and kept[3] > 0
    final = corpus_pipeline.run(spark, SF_DIR)
    assert final.count() == kept[3] and final.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@needs_tables
def test_pipeline_stages_on_an_empty_table(spark, documents):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.limit(0), SF_DIR).count() == 0


def test_pipeline_stages_against_brute_force(spark):
    """Every stage on what its predecessor kept, nulls, ties and repeated rows among it, against a plain statement of what it does."""
    folder = SF_DIR.replace("sf0.01", "sf0.001")
    queries.prepare(spark)
    given = spark.read.parquet(f"{folder}/documents.parquet")
    some = [r for r in given.where("length(text) > 200").orderBy("doc_id").limit(6).collect()]
    more = [(None, some[0].text, "en", "web", 1), (None, "Alone without a key, but with some words of its own.", None, None, 1), (90_001, None, "en", "web", 0),
            (90_002, "", None, None, 0), (90_003, "12 34 !", "en", "web", 7), (90_004, some[1].text.upper(), None, "web", 1),
            (90_005, some[2].text + " end", "en", None, 1), (90_006, some[3].text, "en", "a", 1), (90_006, some[3].text, "en", "a", 1)]
    docs = session.stored(given.unionByName(spark.createDataFrame(more, given.schema)).repartition(5), "given")
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: Counter(tuple(r) for r in df.collect())

    net = language_id.fit(docs.where(language_id.remainder("doc_id", 4) != 2))
    tables, want = net.pair_tables(), Counter()
    for row in docs.collect():
        data = (row.text or "").encode()
        sums = np.zeros(len(net.languages))
        for k in range(0, len(data), language_id.WINDOW):
            part = np.frombuffer(data[k:k + language_id.WINDOW], np.uint8)
            codes = np.pad(language_id._CODE_OF[part], (0, language_id.WINDOW - len(part)))[None, :]
            sums += net.log_probabilities(codes, tables)[0] * len(part)
        if any(c.isalpha() for c in row.text or "") and np.exp(language_id._log_softmax(sums[None, :] / len(data))).max() >= 0.5:
            want[tuple(row)] += 1
    kept = session.stored(stages["language"](spark, docs, folder), "kept")
    assert rows(kept) == want and not [r for r in want if r[0] in (90_001, 90_002, 90_003)]

    best = {}
    for row in kept.collect():
        content = lowered(row.text)
        if content not in best or (row.doc_id or -1) > (best[content].doc_id or -1):
            best[content] = row
    exact = session.stored(stages["exact_dedup"](spark, kept, folder), "exact")
    assert rows(exact) == Counter(map(tuple, best.values()))

    near = session.stored(stages["near_dedup"](spark, exact, folder), "near")
    first = {k for k, _, _, stays in near_brute([tuple(r)[:2] for r in exact.collect()]) if stays}
    assert rows(near) == Counter(tuple(r) for r in exact.collect() if r.doc_id is None or r.doc_id in first)

    near = session.stored(near.where("doc_id is not null"), "keyed")  # SQL orders them by a hash of the key
    con = duckdb.connect()
    con.register("documents", near.toPandas())
    taken = {k: n // size for k, size, _, _, n in con.sql(queries.ORACLES["op8_source_mix"]).fetchall() if size}
    mix = session.stored(stages["mix"](spark, near, folder), "mix")
    assert rows(mix) == Counter({tuple(r): taken[r.doc_id] for r in near.collect() if taken.get(r.doc_id)})

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = Counter()
    for row in mix.collect():
        ids = plain.encode_ordinary(row.text)
        digests = (hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(row.text.encode()).hexdigest())
        coded[row.doc_id, len(ids), *digests] += 1
    assert rows(stages["bpe"](spark, mix, folder)) == coded
