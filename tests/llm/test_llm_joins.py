"""Set join, token alignment and ranked search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pactmill.llm import jaccard_join, lexical_search, token_alignment
from test_llm_tables import awkward, lowered, text_of  # noqa: F401

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

# set join


def grams(text, width=3):
    words = re.findall(rb"[^\x20\x09-\x0d]+", lowered(text))
    span = min(width, len(words))
    return {tuple(words[k:k + span]) for k in range(len(words) - span + 1)} if words else set()


def join_brute(rows, share):
    sets = [grams(text) for _, text in rows]
    root = {key: key for key, _ in rows}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    for i, (one, _) in enumerate(rows):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= share * (len(sets[i]) + len(sets[j]) - shared):
                low, high = sorted((find(one), find(rows[j][0])))
                root[high] = low
    return Counter((key, len(own), find(key)) for (key, _), own in zip(rows, sets))


def family_rows(seed, vocabulary):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)]
    bases = [[rng.choice(words) for _ in range(n)] for n in [*range(0, 40, 3), 11, 19, 60, 150, 400]]
    rows = []
    for base in bases:
        rows.append(base)
        for _ in range(7):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(own) + 1)
                if rng.random() < 0.5 or at == len(own):
                    own.insert(at, rng.choice(words))
                else:
                    del own[at]
            rows.append(own)
    passage = [rng.choice(words) for _ in range(12)]
    rows += [passage + [rng.choice(words) for _ in range(rng.randint(0, 4))] for _ in range(50)]
    long = [rng.choice(words) for _ in range(300)]
    rows += [long[:k] + ["new"] + long[k + 1:] for k in range(0, 60, 2)]  # near copies without their base
    rows = [(3 * k + 1, " ".join(own)) for k, own in enumerate(rows)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("share", "hot", "bits", "vocabulary"), [(90, 512, 400_000_000, 400), (90, 3, 20_000, 60), (80, 2, 3_000, 400)])
def test_join_finds_every_link(docs, share, hot, bits, vocabulary):
    rows = family_rows(share + hot, vocabulary)
    got = jaccard_join.joined(docs(rows), share=share, hot=hot, family_bits=bits)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, got.collect())) == join_brute(rows, share)


def test_join_on_awkward_rows(docs, awkward):  # noqa: F811
    rows = [r for r in awkward if r[0] is not None]
    # key 400 stands twice with the same text, so brute force treats it as one node as well
    assert Counter(map(tuple, jaccard_join.joined(docs(rows)).collect())) == join_brute(rows, 90)
    got = {tuple(r) for r in jaccard_join.joined(docs(awkward)).collect()}
    assert (None, len(grams(awkward[3][1])), None) in got
    assert jaccard_join.joined(docs([])).count() == 0


def test_bands_hold_every_similar_size():
    for x in range(1, 700):
        for y in range(x, x * 100 // 90 + 1):
            shared = -(-90 * (x + y) // 190)  # the smallest intersection that links them
            if shared > x:
                continue
            both = {n: m for n, m in jaccard_join.placements(x)}.items() & {n: m for n, m in jaccard_join.placements(y)}.items()
            assert both and all(x + y - 2 * shared <= m - 1 for _, m in both), (x, y)


def test_one_deletion_neighbours_meet():
    rng = np.random.default_rng(5)
    tokens = np.sort(rng.integers(0, 1 << 63, 40).astype(np.uint64))
    entries = jaccard_join.subset_entries(tokens).tolist()
    other = np.delete(tokens, 7)
    number, count = jaccard_join.placements(40)[0]
    segment = int(jaccard_join._segments(tokens[7:8], number, count)[0])
    dear = {entry for k, entry in enumerate(entries[:count]) if k != segment and k % 2}
    whole, less = jaccard_join.allocated_entries(tokens, dear)
    assert not dear & set(whole.tolist())
    assert len(jaccard_join.placements(39)) and set(less.tolist()) & set(jaccard_join.subset_entries(other).tolist())


# token alignment


@pytest.fixture(scope="module")
def encoder():
    with open(A_PATH, encoding="utf-8") as a, open(B_PATH, "rb") as b:
        return token_alignment.Encoder(a.read(), b.read())


def ranges(ids, contents):
    at = 0
    for k in ids:
        yield at, at + len(contents[k]), k
        at += len(contents[k])


_a = Tokenizer.from_file(A_PATH)
_a.encode_special_tokens = True
_b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def align_brute(text, encoder):
    if not text:
        return 0, 0, "", Counter()
    a, b, whole = _a.encode(" " + text, add_special_tokens=False).ids, _b.encode(text), (" " + text).encode()
    if not b"".join(encoder.a_bytes[k] for k in a) == whole == b"".join(encoder.b_bytes[k] for k in b):
        return 0, 0, "", Counter()
    left, right = list(ranges(a, encoder.a_bytes)), list(ranges(b, encoder.b_bytes))
    groups, before = [], 0
    for end in sorted({e for _, e, _ in left} & {e for _, e, _ in right}):
        groups.append("|".join(",".join(str(k) for _, e, k in side if before < e <= end) for side in (left, right)))
        before = end
    links = Counter((x, y) for s, e, x in left for t, f, y in right if s < f and t < e)
    return len(a), len(b), ";".join(groups), links


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a\n  b \n\n c", "a \n b", "x\x1c y", "x\x85 y\xa0 z", "　 a᠎ b ​ c", "▁x b",
    "<|endoftext|> a <s> <0x41> <unk>", "日本語 テスト です", "x" * 3_000, "é \U0001d4b3 \U0001f600\U0001f600 " * 20, "a\x00b", "don't  we'll   go\r\n\r\n  now",
    " \n ", "ﬁne ① Å", "Å", "anticonstitutionnellement " * 30,
]


def test_alignment_against_brute_force(encoder, monkeypatch):
    texts = ODD + [text_of(n) for n in (1, 7, 80)]
    whole = list(token_alignment.Aligner(encoder).documents(texts))
    for text, (n_a, n_b, n_groups, groups, pairs, times) in zip(texts, whole):
        a, b, want, links = align_brute(text, encoder)
        assert (n_a, n_b, groups.decode(), n_groups) == (a, b, want, want.count("|")), text
        assert {(p >> 32, p & (1 << 32) - 1): t for p, t in zip(pairs.tolist(), times.tolist())} == links
    # the same in many small parts, and with words that are forgotten in between
    for name, value in (("WORDS_TOGETHER", 3), ("TOKENS_TOGETHER", 40), ("CACHED_WORDS", 5)):
        monkeypatch.setattr(token_alignment, name, value)
    for one, other in zip(whole, token_alignment.Aligner(encoder).documents(texts)):
        assert one[:4] == other[:4] and (one[4] == other[4]).all() and (one[5] == other[5]).all()


def test_galloping_ranks():
    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (1, 50), (7, 9), (40, 4_000), (500, 500), (300, 301)):
        long = np.cumsum(rng.integers(1, 6, m))
        short = np.append(np.sort(rng.choice(np.arange(1, long[-1]), n - 1, False)), long[-1])
        assert (token_alignment.galloping_ranks(short, long) == np.searchsorted(long, short)).all()


@pytest.mark.parametrize("frequent", [100_000, 3])
def test_alignment_counts(docs, encoder, monkeypatch, frequent):
    monkeypatch.setattr(token_alignment, "FREQUENT_PAIRS", frequent)
    rows = [(k, text) for k, text in enumerate(ODD)] + [(100 + k, text_of(30)) for k in range(20)]
    rows += [(None, "the end of the text"), (7, "the end of the text"), (7, "the end of the text")]
    found = [align_brute(text, encoder) for _, text in rows]
    held = Counter(pair for *_, links in found for pair in links)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    want = Counter(
        (key, a, b, groups.count("|"), hashlib.sha256(groups.encode()).hexdigest() if groups else "", links.total(),
         sum(t for p, t in links.items() if held[p] == most[p[0]]), sum(t * held[p] for p, t in links.items()))
        for (key, _), (a, b, groups, links) in zip(rows, found)
    )
    aligned = token_alignment.aligned(docs(rows), A_PATH, B_PATH)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    got = token_alignment.with_counts(aligned.select("row.doc_id", "n_a", "n_b", "n_groups", digest, "pairs", "times"))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"]
    assert Counter(map(tuple, got.collect())) == want
    empty = token_alignment.aligned(docs([]), A_PATH, B_PATH)
    assert empty.count() == 0 and token_alignment.with_counts(empty.select("row.doc_id", "pairs", "times")).count() == 0


# ranked search


def search_brute(rows, items, k=10):
    own = [Counter(re.findall(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered(text))) for _, text in rows]
    n_docs, total = sum(1 for c in own if c), sum(c.total() for c in own)
    df = Counter(term for c in own for term in c)
    out = []
    for item, text in items:
        scored = []
        for (key, _), counts in zip(rows, own):
            score = 0
            for term in set(re.findall(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered(text))) & counts.keys():
                m = 10 + (90 * counts.total() * n_docs) // total
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += weight * ((1_000_000_000 * counts[term]) // (1_000 * counts[term] + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0))
        scored.sort()
        out += [(item, rank, None if null else key, -score) for rank, (score, null, key) in enumerate(scored[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize(("block", "together"), [(16_384, 500_000), (5, 40)])
def test_search_against_brute_force(spark, docs, awkward, monkeypatch, block, together):  # noqa: F811
    monkeypatch.setattr(lexical_search, "BLOCK_DOCUMENTS", block)
    monkeypatch.setattr(lexical_search, "TERMS_TOGETHER", together)
    monkeypatch.setattr(lexical_search, "PIECE_BYTES", 50_000)
    rows = awkward + [(1_000 + k, f"common word{k % 7} {'rare ' * (k % 3)}") for k in range(60)] + [(5_000, "tie, one"), (4_999, "One tie"), (None, "tie one")]
    items = [(1, awkward[2][1][:200]), (2, "common RARE word3"), (3, None), (4, ""), (5, "nowhere"), (6, "tie; one"), (6, "É two"), (None, "common")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    got = lexical_search.ranked(docs(rows, 4), asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == search_brute(rows, items)
    assert lexical_search.ranked(docs([]), asked).count() == 0 and lexical_search.ranked(docs(rows), asked.limit(0)).count() == 0


def test_accumulators_stop(monkeypatch):
    """A block whose rarest lists decide: the long list adds to survivors only, and no other document gets an accumulator."""
    made = []
    monkeypatch.setattr(lexical_search, "_distinct", lambda parts, partial, own=lexical_search._distinct: made.append(own(parts, partial)) or made[-1])
    docs_, terms = np.array([*range(12), *range(1_000)]), np.array([0] * 12 + [1] * 1_000)
    shares = np.where(terms == 0, 100, 5).astype(np.int64)
    shares[12 + 3] = 9
    ((_, found, scores),) = lexical_search.search_block(docs_, terms, shares, [np.array([0, 1])], 1)
    assert found.tolist() == [3] and scores.tolist() == [109] and max(map(len, made)) == 12
