"""The operators against brute force on awkward small tables: nulls, empty and long texts, ties, repeated rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from pactmill.llm import byte_bpe, exact_dedup, mixing, near_dedup, pivot_search, sharding, wildcard_urls as urls, wordhash
from pactmill.llm.components import components

random.seed(11)
WORDS = [f"w{k}" for k in range(3000)]
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def text_of(n):
    return " ".join(random.choices(WORDS, k=n))


def changed(text, n):
    words = text.split()
    for k in random.sample(range(len(words)), n):
        words[k] = random.choice(WORDS)
    return " ".join(words)


def lowered(text):
    return (text or "").encode().translate(LOWER)


@pytest.fixture(scope="module")
def awkward():
    base = [text_of(n) for n in (5, 60, 200, 400)]
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(100 + k, changed(base[2], 1 + k % 4)) for k in range(60)]  # a group of near copies
    rows += [(200 + k, base[1].upper() if k % 2 else base[1]) for k in range(80)]  # a hot text
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "one two"), (304, "ONE two"), (305, "One  two three"), (306, "É é"), (307, "é É")]
    rows += [(308, "x" * 300_000), (309, "ab " * 60_000), (310, text_of(30_000))]
    rows += [(None, base[3]), (400, base[0]), (400, base[0]), (-5, base[1])]
    return rows


# exact deduplication


def exact_brute(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[lowered(text)].append(key)
    out = []
    for content, keys in groups.items():
        keep = max((k for k in keys if k is not None), default=None)
        kept = [False] * len(keys)
        kept[keys.index(keep)] = True
        out += [(k, keep, len(keys), flag, hashlib.sha256(content).hexdigest()) for k, flag in zip(keys, kept)]
    return Counter(out)


@pytest.mark.parametrize("table_bytes", [1 << 26, 4_000])
def test_exact_groups(docs, awkward, table_bytes):
    got = exact_dedup.groups(docs(awkward, 4), table_bytes=table_bytes)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == exact_brute(awkward)


def test_grace_recursion_keeps_everything(tmp_path):
    records = [(random.choice(WORDS[:500]).encode() * 5, [[k], k, k, 1]) for k in range(4000)]
    want = Counter(c for c, _ in records)
    got = {c: v[3] for c, v in exact_dedup.grace_groups(iter(records), 2_000)}
    assert got == dict(want)


def test_content_table_grows_and_compares_contents(monkeypatch):
    monkeypatch.setattr(exact_dedup.xxhash, "xxh3_64_intdigest", lambda content, seed: 7)  # every hash collides
    table = exact_dedup.ContentTable()
    for content in (b"a", b"b", b"a", b"c"):
        value = table.find(content)
        value.append(content)
    assert table.values == [[b"a", b"a"], [b"b"], [b"c"]]


def test_exact_deduplicated_keeps_whole_rows(docs, awkward):
    df = docs(awkward)
    got = exact_dedup.deduplicated(df)
    assert got.columns == df.columns
    want = Counter((k, hashlib.sha256(lowered(t)).hexdigest()) for k, t in awkward)
    kept = {(k, s) for k, _, _, flag, s in exact_brute(awkward) if flag}
    assert Counter((r.doc_id, hashlib.sha256(lowered(r.text)).hexdigest()) for r in got.collect()) == Counter({key: 1 for key in want if key in kept})


# near-duplicates


def near_brute(rows):
    sets, parent = [], {}
    for key, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0d]+", lowered(text))
        sets.append((key, {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()))
        parent[key] = key

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    usable = [(k, s) for k, s in sets if k is not None and s]
    for n, (a, s) in enumerate(usable):
        for b, t in usable[:n]:
            if min(len(s), len(t)) * 100 >= 85 * max(len(s), len(t)) and 100 * len(s & t) >= 85 * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    out = Counter()
    for key, s in sets:
        component = None if key is None else root(key)
        out[key, len(s), component, key is not None and key == component] += 1
    return out


@pytest.mark.parametrize("task_rows", [2_048, 16])
def test_near_duplicates(docs, awkward, task_rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "TASK_ROWS", task_rows)  # 16: nodes branched by Spark, families in tiles
    assert Counter(map(tuple, near_dedup.near_duplicates(docs(awkward)).collect())) == near_brute(awkward)


def test_near_deduplicated_keeps_one_of_each(docs, awkward):
    df = docs([r for r in awkward if r[0] not in (None, 400)])
    got = near_dedup.deduplicated(df)
    assert got.columns == df.columns
    assert {r.doc_id for r in got.collect()} == {k for k, _, _, kept in near_brute([r[:2] for r in map(tuple, df.collect())]) if kept}


def test_near_deduplicated_judges_rows(docs):
    one, other = text_of(60), text_of(50)
    rows = [(None, one), (None, one), (1, one), (1, other), (2, other), (0, other), (3, one), (3, one), (4, None), (5, ""), (5, "")]
    got = sorted(map(str, (tuple(r)[:2] for r in near_dedup.deduplicated(docs(rows)).collect())))
    # the other text of key 1 is one of key 0's, and goes; the first one is its own
    want = [(None, one), (None, one), (0, other), (1, one), (4, None), (5, "")]
    assert got == sorted(map(str, want))


def test_a_family_of_near_copies_larger_than_a_task(docs, monkeypatch):
    """Every pair of the family is above 96 %: it does not shrink by branching, and must not be dropped or multiplied for that."""
    monkeypatch.setattr(near_dedup, "TASK_ROWS", 16)
    base = text_of(600)
    rows = [(k, changed(base, 1)) for k in range(64)] + [(100 + k, text_of(40)) for k in range(200)]
    got = near_dedup.near_duplicates(docs(rows)).where("doc_id < 100").select("component_id").distinct().collect()
    assert [r.component_id for r in got] == [0]
    seen, own = [], near_dedup.candidates
    monkeypatch.setattr(near_dedup, "candidates", lambda sets: own(sets, seen))
    near_dedup.near_duplicates(docs(rows)).count()
    assert max(seen) < 2 * seen[0]


def test_tiles_link_what_is_unlike_the_hub():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 256, near_dedup.ROWS).astype(np.uint8)
    rows = np.stack([base] * 6)
    rows[3:, :100] = rng.integers(0, 256, 100)  # three that are alike among each other only
    rows[5, :30] = base[:30]
    sizes, left = np.full(6, 50), np.array([False, False, False, True, True, False])
    found = near_dedup.tile_links(rows, sizes, left, np.array([True, True, True, False, False, False]))
    assert all(near_dedup.AGREEING <= (rows[i] == rows[j]).sum() for i, j in found)


def test_branching_inside_a_task_finds_what_comparing_all_finds(monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL_NODE", 8)
    base = [np.unique(np.random.default_rng(k).integers(0, 1 << 60, 300).astype(np.uint64)) for k in range(40)]
    sets = [np.sort(np.concatenate([b[:-3], np.array([n + 1], np.uint64)])) for b in base for n in range(6)]
    rows = np.stack([near_dedup.signature(s) for s in sets])
    together = Counter()
    for tree in range(6):
        for a, b in near_dedup.node_links(rows, np.array([len(s) for s in sets]), tree):
            assert a // 6 == b // 6
            together[a // 6] += 1
    assert len(together) >= 38


def test_shingle_sets_do_not_depend_on_blocks(monkeypatch):
    import pyarrow as pa

    texts = pa.array([text_of(n) for n in (3, 40, 700, 0, 5)] + [None, "é" * 500 + " b" * 500, " a", "A a"])
    whole = [s.tolist() for s in wordhash.shingle_sets(texts, 5)]
    monkeypatch.setattr(wordhash, "SEGMENT_BYTES", 64)
    assert [s.tolist() for s in wordhash.shingle_sets(texts, 5)] == whole
    monkeypatch.setattr(wordhash, "LONGEST_AT_ONCE", 16)
    assert wordhash.count_words(texts).tolist() == [len((t or "").split()) for t in texts.to_pylist()]


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(200, 150), (150, 170), (7, 7), (300, 301)] + [(400, 400 + k) for k in range(1, 50)]
    got = {r.id: r.component for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 150 for k in (150, 170, 200)} | {300: 300, 301: 300} | {k: 400 for k in range(400, 450)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# sharding


@pytest.mark.parametrize("bucket_bytes", [1 << 24, 20_000])
def test_shards(docs, awkward, bucket_bytes):
    df = docs(awkward)
    rows = sharding.sharded(df, 7, seed=3, bucket_bytes=bucket_bytes)
    got = rows.collect()
    assert Counter((r.row.doc_id, r.row.text) for r in got) == Counter(awkward)
    assert got[0].row.asDict().keys() == set(df.columns)
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    sizes = [len(by_shard[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1
    again = sharding.sharded(docs(awkward, 2), 7, seed=3, bucket_bytes=bucket_bytes).collect()
    assert Counter((r.row.doc_id, r.row.text, r.shard, r.slot) for r in got) == Counter((r.row.doc_id, r.row.text, r.shard, r.slot) for r in again)
    measured = rows.select(sharding.size(F.col("row.text")).alias("size"), sharding.crc(F.col("row.text")).alias("crc"), "row.text").collect()
    assert all(m["size"] == len((m.text or "").encode()) + 8 and m.crc == zlib.crc32((m.text or "").encode()) for m in measured)


def test_hot_rows_do_not_share_a_bucket(docs, tmp_path):
    rows = [(None, "")] * 3_000 + [(7, "the same")] * 2_000 + [(k, text_of(5)) for k in range(500)]
    outcomes = []
    for parts in (3, 8):
        shuffled = sharding.write_shuffled(docs(rows, parts), str(tmp_path / str(parts)), seed=5, bucket_bytes=2_000)
        assert shuffled.groupBy("bucket").count().agg(F.max("count")).first()[0] < 1_500
        placed = sharding.numbered(shuffled, 24)
        outcomes.append(Counter((r.row.doc_id, r.row.text, r.shard, r.slot) for r in placed.collect()))
    assert outcomes[0] == outcomes[1] and outcomes[0].total() == len(rows)
    assert Counter((k, t) for k, t, _, _ in outcomes[0].elements()) == Counter(rows)


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(near) for near in (sharding.fisher_yates(3, [1, k]) for k in range(3000)))
    assert len(seen) == 6 and min(seen.values()) > 400


# URLs

RULES = [urls.Rule("block", "net/"), urls.Rule("allow", "example.net/en/"), urls.Rule("block", "example.com/de/"), urls.Rule("allow", "org/fr/")]
URLS = [
    None, "", "no scheme", "http://a.net", "http://a.net/", "http://NET/x", "https://example.net/en/1", "https://x.example.net/en/",
    "https://x.example.net/en", "https://xexample.net/en/1", "http://b.example.com/de/3?x=1", "http://b.example.com/DE/3",
    "http://b.org/fr/#t", "http://borg/fr/", "http://a.com/x.net/y", "http://a.com?u=http://b.net/", "ftp://É.net/ü/", "://net/", "http:///net/",
    "http://a.net?/", "http://a.b.c.d.example.net/en/" + "x" * 50_000, "http://u@x.net:80/p", "a://b://c.net/",
]


def url_brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):], re.S)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in RULES:
        at = rule.site.index("/")
        if (host == rule.site[:at] or host.endswith("." + rule.site[:at])) and path.startswith(rule.site[at:]):
            best = rule if best is None or len(rule.site) >= len(best.site) else best
    return host, path, best and best.site, best.verdict if best else "allow"


def test_url_verdicts(spark):
    df = spark.createDataFrame([(k, u) for k, u in enumerate(URLS * 2)], "page_id bigint, url string").selectExpr("*", "1 as host", "2 as rule")
    got = urls.judged(df, RULES).select("row.page_id", "host", "path", "rule", "verdict").collect()
    assert {r[0]: tuple(r[1:]) for r in got} == {k: url_brute(u) for k, u in enumerate(URLS * 2)}
    assert urls.judged(df.limit(0), RULES).count() == 0
    assert urls.judged(df, []).where("rule is null and verdict = 'allow'").count() == df.count()


def test_automaton_over_many_words():
    globs = [f"host{k}.example/*/{k}/**" for k in range(60)] + ["**"]
    automaton = urls.Automaton(globs)
    assert automaton.words > 10
    texts = ["host7.example/a/7/x/y", "host7.example/a/b/7/", "host59.example//59/", "", "x" * 200]
    data = "".join(texts).encode()
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = automaton.accepted(np.frombuffer(data, np.uint8), at)
    for text, fits in zip(texts, found):
        assert [bool(f) for f in fits] == [bool(re.fullmatch(g.replace(".", r"\.").replace("**", "\0").replace("*", "[^/]*").replace("\0", ".*"), text)) for g in globs]


# mixing


def targets_brute(sizes):
    """Share by weight, stop at three times the size, share the excess anew."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    fixed, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            return fixed | {s: level * weight[s] for s in open_}
        for s in over:
            fixed[s] = 3.0 * sizes[s]
            left -= fixed[s]
        open_ -= over
    return fixed


@pytest.fixture(scope="module")
def sources():
    rows = [(k, text_of(random.choice([0, 1, 5, 40])), None, random.choice("abcdefgh") if k % 3 else "hot") for k in range(900)]
    return rows + [(1000, None, None, "a"), (1001, text_of(9), None, None), (1002, "", None, "empty"), (1003, text_of(2000), None, "É")] + [(5000, "same words here", None, "copies")] * 50


def test_mix(docs, sources):
    got = mixing.mixed(docs(sources), seed=5).collect()
    words, sizes, taken = {}, defaultdict(int), defaultdict(int)
    for key, text, _, source in sources:
        words[key] = len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))
        sizes[source] += words[key]
    want = targets_brute(dict(sizes))
    source_of = {key: source for key, _, _, source in sources}
    assert len(got) == len(sources)
    for r in got:
        source = source_of[r.doc_id]
        assert r["size"] == words[r.doc_id] and r.source_size == sizes[source] and abs(r.target - want[source]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        taken[source] += r.taken
    for source, target in want.items():
        largest = max(words[key] for key, _, _, s in sources if s == source)
        assert abs(taken[source] - target) <= largest / 2 + 1e-6
    again = mixing.mixed(docs(sources, 5), seed=5).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mixture_repeats_rows(docs, sources):
    df = docs(sources)
    mix = mixing.mixture(df, seed=5)
    assert mix.columns == df.columns
    taken = mixing.mixed(df, seed=5).agg(F.sum("taken")).first()[0]
    assert mix.agg(F.sum(F.size(F.filter(F.split("text", r"[\x20\x09-\x0d]+"), lambda w: w != "")))).first()[0] == taken
    assert mixing.mixed(df.limit(0)).count() == 0


# vectors


def topk_brute(rows, every, k=10):
    codes = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in codes if i % every == 0}):
        own = min(c for i, c in codes if i == q)
        scores = sorted((-sum(a * b for a, b in zip(own, c)), i) for i, c in codes if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows,query_rows", [(8_192, 4_096), (40, 5)])
def test_top_k(spark, block_rows, query_rows):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(0, 0.2, 12).astype(np.float32).tolist()) for k in range(300)]
    rows += [(1000 + k, [0.25] * 12) for k in range(120)]  # one common vector, many ties
    rows += [(2000, None), (2010, []), (2020, [None] * 12), (2030, [float("nan")] * 12), (2040, [float("inf")] * 12), (2050, [0.0] * 12), (None, [1.0] * 12)]
    rows += [(2060, [9.0] * 5), (40, [0.1] * 12), (77, rows[77][1])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4).selectExpr("*", "1 as id", "2 as rank")
    got = pivot_search.top_k(df, lambda v: v % 10 == 0, block_rows=block_rows, query_rows=query_rows, pivots=6)
    assert sorted(map(tuple, got.collect())) == topk_brute(rows, 10)


def test_top_k_of_few_or_none(spark):
    one = spark.createDataFrame([(0, [1.0, 2.0]), (3, [1.0, 0.5])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in pivot_search.top_k(one, lambda v: v % 10 == 0).collect()] == [(0, 1, 3, 1024 * 1024 + 2048 * 512)]
    assert pivot_search.top_k(one.limit(0), lambda v: v % 10 == 0).count() == 0


def test_top_k_of_huge_components(spark):
    """Where the bound on a product passes 64 bits but the product does not, it is exact; one that does is an error."""
    rows = [(0, [4e6, 0.0]), (1, [0.0, 4e6]), (2, [1.0, 1.0]), (3, [-4e6, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    far = 4 * 10**6 * 1024
    got = [tuple(r)[2:] for r in pivot_search.top_k(df.where("vec_id < 3"), lambda v: v == 0).orderBy("rank").collect()]
    assert got == [(2, far * 1024), (1, 0)]
    with pytest.raises(Exception, match="does not fit 64 bits"):
        pivot_search.top_k(df, lambda v: v == 0).collect()


def test_blocks_go_only_where_they_are_visited(spark):
    index = spark.range(100).selectExpr("id", "array(id) codes", "double(id) dist", "double(id) norm", "0 pivot", "0 ring", "int(id % 4) block")
    visits = spark.range(9).selectExpr(
        "id + 1000 id", "array(1L) codes", "double(1) norm", "double(null) reach", "double(0) to_pivot", "0 pivot", "0 ring", "int(if(id = 0, 3, 1)) block"
    )
    plan_rows = pivot_search._searched(index, visits, 4, 1).collect()
    assert {(r.query_id, r.vec_id) for r in plan_rows} == {(1000, 99), *((1000 + k, 97) for k in range(1, 9))}


# byte-level BPE

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    "", "a", " ", "   x", "a" * 5_000, "ab" * 900, " " * 700 + "b", "é" * 300, "<|endoftext|>", "\x00\x01\x1c\x1d x", "!\x1cy \x1c\x1c z", "I'll don't 'S", "日本語テキスト" * 9,
    "x" * 31, "x" * 32, "x" * 33, "12345678901234567890", "a\n\n  b\t\tc \n", "\u00a0\u2003 nb", "👩‍👩‍👧 emoji", "".join(random.choice("abcdef ") for _ in range(5_000)),
]


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


def test_bpe_equals_tiktoken(docs, encoding):
    df = docs([(k, t) for k, t in enumerate(ODD)] + [(None, None), (3, "twice"), (3, "twice")])
    got = byte_bpe.coded(df, PATH, public_tokenizers.PATTERN).collect()
    assert len(got) == len(ODD) + 3
    for r in got:
        if r.doc_id is not None:
            text = "twice" if bytes(r.decoded) == b"twice" else ODD[r.doc_id]
            assert np.frombuffer(r.ids, "<u4").tolist() == encoding.encode_ordinary(text) and r.n_tokens == len(r.ids) // 4
            assert bytes(r.decoded) == text.encode()
        else:
            assert r.n_tokens == 0 and bytes(r.ids) == bytes(r.decoded) == b""
    assert byte_bpe.coded(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("longest, characters", [(0, 4_000_000), (4, 4_000_000), (64, 4_000_000), (64, 200)])
def test_both_trees_merge_alike(encoding, monkeypatch, longest, characters):
    monkeypatch.setattr(byte_bpe, "LONGEST_TOGETHER", longest)
    monkeypatch.setattr(byte_bpe, "CACHED_RUNS", 50)
    monkeypatch.setattr(byte_bpe, "CACHED_CHARACTERS", characters)
    monkeypatch.setattr(byte_bpe, "CHARACTERS_TOGETHER", 100)
    codec = byte_bpe.Codec(PATH, public_tokenizers.PATTERN)
    texts = ODD + ["".join(random.choice("thearionst") for _ in range(random.randrange(1, 40))) for _ in range(300)]
    for text, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()



def test_mixes_agree_however_rows_are_dealt_out(docs):
    rows = [(None if k % 3 else 7, text_of(3 + k % 9), None, "ab"[k % 2]) for k in range(160)] + [(7, "one two three", None, "a")] * 5
    outcomes = [Counter(map(tuple, mixing.mixed(docs(rows, parts), seed=3, whole_rows=True).select("row.doc_id", "row.text", "taken").collect()))
                for parts in (2, 5)]
    assert outcomes[0] == outcomes[1] and outcomes[0].total() == len(rows)


@pytest.mark.parametrize("pattern", [r"[^\s]+[\r\n]*|\s+", r"\w+ ?|[^\w]+", public_tokenizers.PATTERN])
def test_any_pattern_splits_as_the_library_does(docs, pattern):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    texts = ["one\r\n\r\ntwo  three \n", "a b\nc", "", "\n x\n", text_of(50).replace(" w", "\nw", 7)]
    got = {r.doc_id: r.ids for r in byte_bpe.coded(docs(list(enumerate(texts))), path, pattern).collect()}
    assert [np.frombuffer(got[k], "<u4").tolist() for k in range(len(texts))] == [plain.encode_ordinary(t) for t in texts]
    assert byte_bpe.Codec(path, pattern).by_run == (pattern == public_tokenizers.PATTERN)


def test_urls_repeat_and_tables_may_be_empty(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None)], "page_id bigint, url string").selectExpr("*", "'x' as rule", "1 as host")
    rules = [urls.Rule("block", "net/")]
    assert Counter((r.row.page_id, r.rule, r.verdict) for r in urls.judged(df, rules).collect()) == {(1, "net/", "block"): 2, (None, None, "allow"): 1}
    assert urls.judged(df.limit(0), rules).count() == 0
