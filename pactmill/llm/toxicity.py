"""Toxicity by multiple-instance learning.

Only whole documents are labelled. A sentence has a score, a logistic function of the words in it; a document's score is
the noisy-or of its sentences: one minus the product of what is left by each. The gradient of the document's loss reaches the sentences in
proportion to their share in that, so the sentences that explain the label are found in training and can be located
afterwards.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SENTENCE_END = re.compile(r"[.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5)
MORE_FREQUENT = 1.5
KNOWN_TOKENS = 500_000  # tokens whose weight a worker remembers
OFFENDING = 0.5  # score of a sentence from which on it is reported


def features(token: str) -> list[str]:
    """The lower-cased words in a token, and their beginnings, which families of words share."""
    found = []
    for word in WORD.findall(token.lower()):
        found += [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) >= n)]
    return found


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def __post_init__(self) -> None:
        self._token: dict[str, float] = {}

    def sentence(self, text: str) -> float:
        """The score of a sentence: its distinct tokens count, each with the weights of its features."""
        known, z = self._token, self.bias
        for token in set(text.split()):
            weight = known.get(token)
            if weight is None:
                if len(known) >= KNOWN_TOKENS:
                    known.clear()
                weight = known[token] = sum(self.weights.get(feature, 0.0) for feature in features(token))
            z += weight
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Begin and end of every sentence that is not blank."""
    at = 0
    for stop in SENTENCE_END.finditer(text):
        if not text[at:stop.start()].isspace() and at < stop.start():
            yield at, stop.start()
        at = stop.end()
    if at < len(text) and not text[at:].isspace():
        yield at, len(text)


def train(
    texts: list[str], labels: list[int], weights: list[float] | None = None, least: int = 4, steps: int = 300,
    rate: float = 0.1, shrink: float = 1e-4,
) -> Model:
    """Full-batch Adam on the noisy-or likelihood.

    Only features in at least ``least`` documents that are more frequent in toxic ones have a weight. ``weights`` says for how
    many documents each one stands.
    """
    tokens: dict[str, list[str]] = {}
    split = []
    for text in texts:
        split.append([])
        for a, b in sentences(text):
            found = set(text[a:b].split())
            for token in found:
                if token not in tokens:
                    tokens[token] = features(token)
            split[-1].append(found)
    y = np.array(labels, float)
    seen = (Counter(), Counter())
    for doc, label in zip(split, labels):
        seen[label].update({feature for token in set().union(*doc) for feature in tokens[token]})
    base = MORE_FREQUENT * max(y.sum(), 1) / max((1 - y).sum(), 1)
    chosen = sorted(f for f, n in seen[1].items() if n + seen[0][f] >= least and n > base * seen[0][f])
    vocabulary = {feature: k for k, feature in enumerate(chosen)}
    own = {token: [vocabulary[f] for f in found if f in vocabulary] for token, found in tokens.items()}
    sizes = np.array([len(doc) for doc in split])
    first = np.concatenate([[0], np.cumsum(sizes)])
    doc_of = np.repeat(np.arange(len(split)), sizes)
    flat = [(first[d] + s, k) for d, doc in enumerate(split) for s, found in enumerate(doc) for token in found for k in own[token]]
    at, word = np.array(flat, np.int64).reshape(-1, 2).T
    share = np.ones(len(y)) if weights is None else np.array(weights, float)
    share = share / max(share.sum(), 1e-9)
    w, b = np.zeros(len(vocabulary)), -4.0
    state = [np.zeros(len(w)), np.zeros(len(w)), 0.0, 0.0]
    for step in range(1, steps + 1):
        z = b + np.bincount(at, w[word], int(first[-1]))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y))  # log of what all sentences leave
        toxic = np.maximum(-np.expm1(clean), 1e-9)
        # derivative of the loss by a sentence's z: p for a clean document, -p * (1 - toxic) / toxic for a toxic one
        factor = share * np.where(y > 0, -np.exp(clean) / toxic, 1.0)
        d_z = p * factor[doc_of]
        d_w, d_b = np.bincount(word, d_z[at], len(w)) + shrink * w / len(y), d_z.sum()
        state[0] += 0.1 * (d_w - state[0])
        state[1] += 0.01 * (d_w * d_w - state[1])
        state[2] += 0.1 * (d_b - state[2])
        state[3] += 0.01 * (d_b * d_b - state[3])
        up, down = 1 - 0.9**step, 1 - 0.99**step
        w -= rate * (state[0] / up) / (np.sqrt(state[1] / down) + 1e-8)
        b -= rate * (state[2] / up) / (np.sqrt(state[3] / down) + 1e-8)
    return Model({feature: float(w[k]) for feature, k in vocabulary.items() if abs(w[k]) > 0.01}, float(b))


def fit(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_label: int = 2_000, seed: int = 0,
) -> Model | None:
    """Train on a bounded sample of the labelled rows given, with their whole texts: of each label the ``per_label`` that come first by a hash of
    the key. Of rows that share a key one counts, the first by a hash of its text. Sampled rows stand for all of their label. None unless both labels occur.
    """
    ranked = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    counts = dict(tuple(row) for row in ranked.groupBy("_label").count().collect())
    if set(counts) != {0, 1}:
        return None
    chosen = [
        ranked.where(F.col("_label") == y).orderBy(F.xxhash64(F.lit(seed), F.col("_key"))).limit(per_label) for y in (0, 1)
    ]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]).distinct())  # at most twice per_label rows
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(sample, "_key")
    # one row a key, chosen in the tasks that read them, so that no more rows than are sampled reach the driver
    rows = rows.groupBy("_key", "_label").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text")).select("_key", "_text", "_label").collect()
    if not rows:
        return None
    rows.sort(key=lambda row: (str(row[0]), row[2]))
    found = Counter(row[2] for row in rows)
    return train([row[1] or "" for row in rows], [row[2] for row in rows], [counts[row[2]] / found[row[2]] for row in rows])


def scored(df: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, score and ``offending``, the sentences that are likely toxic themselves (begin and end
    in characters, score).

    The whole text counts, and sentences of any length. Null and empty texts have no sentence and score 0, as has everything without a model. Rows are
    independent, columns not named are not looked at; an empty table gives no rows.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    shape = (
        f"key {rows.schema['key'].dataType.simpleString()}, score double, "
        "offending array<struct<begin: int, end: int, score: double>>"
    )
    spans = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def one(text: str) -> tuple[float, list[dict]]:
        left, offending = 1.0, []
        for begin, end in sentences(text):
            p = model.sentence(text[begin:end])
            left *= 1 - p
            if p >= OFFENDING:
                offending.append({"begin": begin, "end": end, "score": p})
        return 1 - left, offending

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(text or "") if model else (0.0, []) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], spans)],
                ["key", "score", "offending"],
            )

    return rows.mapInArrow(run, shape).withColumnRenamed("key", key)
