"""Language identification by a byte-level convolutional network.

Banks of filters of several widths run over the bytes of a window; each filter keeps its largest response in the window, and a
softmax layer turns those into language probabilities. A text is cut into windows of a fixed length that cover it whole;
its languages' log-probabilities are the mean over its windows, weighted by their length. Training and prediction are numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pactmill.llm.wordhash import texts_as_bytes

WIDTHS = (2, 4)
FILTERS = 16  # of each width
WINDOW = 256
CODES = 64  # classes of bytes
UNDETERMINED = "und"
WINDOWS_TOGETHER = 128

# Code 0 pads. Letters are one class each, without case; so are the bytes that start or continue longer characters, by their
# lowest bits; digits, blanks and the other signs share classes.
_CODE_OF = np.zeros(256, np.uint8)
_CODE_OF[:128] = 1
_CODE_OF[[9, 10, 11, 12, 13, 32]] = 2
_CODE_OF[48:58] = 3
_CODE_OF[[39, 96]] = 4
_CODE_OF[65:91] = _CODE_OF[97:123] = 5 + np.arange(26)
_CODE_OF[128:192] = 31 + np.arange(64) % 24
_CODE_OF[192:256] = 55 + np.arange(64) % 9


@dataclass
class Network:
    languages: list[str]
    filters: list[np.ndarray]  # per width: (width, CODES, FILTERS)
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def pair_tables(self) -> list[list[np.ndarray]]:
        """Per width the summed responses to two neighbouring bytes, so that a filter costs a look-up per two bytes."""
        return [
            [(bank[k][:, None, :] + bank[k + 1][None, :, :]).reshape(CODES * CODES, -1) for k in range(0, len(bank), 2)]
            for bank in self.filters
        ]

    def log_probabilities(self, codes: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Of windows (rows of ``codes``)."""
        pairs = codes[:, :-1].astype(np.intp) * CODES + codes[:, 1:]
        pooled = []
        for bank in tables:
            span = pairs.shape[1] - 2 * (len(bank) - 1)
            response = np.take(bank[0], pairs[:, :span], axis=0, mode="clip")  # "clip" skips the check of the bounds
            for k, table in enumerate(bank[1:], 1):
                response += np.take(table, pairs[:, 2 * k:2 * k + span], axis=0, mode="clip")
            pooled.append(response.max(axis=1))
        return _log_softmax(np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0) @ self.dense + self.offset)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def windows(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of windows: codes, the text each belongs to, and how many bytes of it each holds."""
    counts = -(-(at[1:] - at[:-1]) // WINDOW)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    for begin in range(0, int(firsts[-1]), WINDOWS_TOGETHER):
        number = np.arange(begin, min(begin + WINDOWS_TOGETHER, int(firsts[-1])))
        text = np.searchsorted(firsts, number, "right") - 1
        start = at[text] + (number - firsts[text]) * WINDOW
        size = np.minimum(WINDOW, at[text + 1] - start)
        place = start[:, None] + np.arange(WINDOW)
        inside = np.arange(WINDOW) < size[:, None]
        yield np.where(inside, _CODE_OF[data[np.minimum(place, len(data) - 1)]], 0), text, size


def train(
    texts: list[str], labels: list[str], steps: int = 400, batch: int = 96, rate: float = 0.02, seed: int = 0
) -> Network:
    """Adam on random windows of the texts, each language equally often."""
    languages = sorted(set(labels))
    of = {language: k for k, language in enumerate(languages)}
    data, at = texts_as_bytes(pa.array(texts, pa.large_string()))
    codes, text, _ = (np.concatenate(parts) for parts in zip(*windows(data, at)))
    target = np.array([of[label] for label in labels])[text]
    members = [np.flatnonzero(target == k) for k in range(len(languages))]
    rng = np.random.default_rng(seed)
    width = FILTERS * len(WIDTHS)
    net = Network(
        languages, [rng.normal(0, 0.3, (w, CODES, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(width, np.float32), rng.normal(0, 0.2, (width, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    weights = [*net.filters, net.bias, net.dense, net.offset]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        chosen = np.array([rng.choice(members[k]) for k in rng.integers(0, len(languages), batch)])
        for weight, grad, m, v in zip(weights, _gradients(net, codes[chosen], target[chosen]), first, second):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            weight -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


def _gradients(net: Network, codes: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    n = len(codes)
    pooled, where = [], []
    for bank in net.filters:
        span = codes.shape[1] - len(bank) + 1
        response = sum(bank[k][codes[:, k:k + span]] for k in range(len(bank)))
        place = response.argmax(axis=1)
        where.append(place)
        pooled.append(np.take_along_axis(response, place[:, None, :], axis=1)[:, 0])
    hidden = np.concatenate(pooled, axis=1) + net.bias
    active = np.maximum(hidden, 0)
    d_logits = np.exp(_log_softmax(active @ net.dense + net.offset))
    d_logits[np.arange(n), target] -= 1
    d_logits /= n
    d_hidden = (d_logits @ net.dense.T) * (hidden > 0)
    grads = []
    for b, bank in enumerate(net.filters):
        own, grad = d_hidden[:, b * FILTERS:(b + 1) * FILTERS], np.zeros_like(bank)
        for k in range(len(bank)):
            byte = codes[np.arange(n)[:, None], where[b] + k]
            np.add.at(grad[k], (byte, np.arange(FILTERS)[None, :]), own)
        grads.append(grad)
    return [*grads, d_hidden.sum(axis=0), active.T @ d_logits + 1e-4 * net.dense, d_logits.sum(axis=0)]


def fit(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 250,
    windows_per_row: int = 16, seed: int = 0,
) -> Network | None:
    """Train on a bounded sample: of every language the ``per_language`` rows that come first by a hash of the key, and of
    each ``windows_per_row`` windows drawn from all over its text, or the whole text if it has no more. None if there is no labelled text."""
    labelled = labelled.where(F.col(lang).isNotNull() & F.rlike(F.coalesce(text, F.lit("")), F.lit(r"\p{L}")))
    hashed = labelled.select(
        F.col(lang).alias("lang"), F.xxhash64(F.lit(seed), F.col(key), F.col(lang)).alias("h"), F.col(text).alias("text")
    )
    first = Window.partitionBy("lang").orderBy("h")
    counts = hashed.groupBy("lang").count().collect()
    if not counts:
        return None
    # hashes are uniform: below this edge lie about twice as many rows as are wanted, so few rows leave their tasks
    edges = [
        (row["lang"], min((1 << 63) - 1, (2 * per_language + 100 << 64) // row["count"] - (1 << 63))) for row in counts
    ]
    edge = F.create_map(*[part for name, h in edges for part in (F.lit(name), F.lit(h).cast("bigint"))])[F.col("lang")]
    count = F.ceil(F.length("text") / WINDOW).cast("bigint")
    at = lambda k: F.when(count > windows_per_row, F.pmod(F.xxhash64("h", k), count)).otherwise(k)
    drawn = F.transform(
        F.sequence(F.lit(0), F.least(count, F.lit(windows_per_row)).cast("int") - 1),
        lambda k: F.substring("text", (at(k) * WINDOW + 1).cast("int"), F.lit(WINDOW)),
    )
    near = hashed.where(F.col("h") <= edge).withColumn("text", drawn)
    rows = near.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language).collect()
    rows.sort(key=lambda row: (row.lang, row.n))
    return train([part for row in rows for part in row.text], [row.lang for row in rows for _ in row.text], seed=seed)


def predicted(df: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``df`` as a struct column ``row``, with lang_pred and score, the probability of that language.

    Null texts and texts without a letter are ``und`` with score 0, as is everything if there is no network. The whole
    text counts. Ties go to the language that sorts first. Rows are independent, columns may have any names; an empty table gives no rows.
    """
    inner = [f"c{i}" for i in range(len(df.columns))]  # so that no name can clash
    at_text = df.columns.index(text)
    flat = df.toDF(*inner).withColumn("letter", F.rlike(F.coalesce(inner[at_text], F.lit("")), F.lit(r"\p{L}")))
    shape = ", ".join(f"{name} {field.dataType.simpleString()}" for name, field in zip(inner, df.schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.pair_tables() if net else None
        for batch in batches:
            n = batch.num_rows
            names, scores = [UNDETERMINED] * n, np.zeros(n)
            letter = batch.column(len(inner)).to_numpy(zero_copy_only=False)
            data, at = texts_as_bytes(batch.column(at_text))
            if net and len(data):
                sums = np.zeros((n, len(net.languages)))
                for codes, text_of, size in windows(data, at):
                    np.add.at(sums, text_of, net.log_probabilities(codes, tables) * size[:, None])
                share = np.exp(_log_softmax(sums / np.maximum(at[1:] - at[:-1], 1)[:, None]))
                best = share.argmax(axis=1)
                scores = np.where(letter, share[np.arange(n), best], 0.0)
                names = [net.languages[k] if has else UNDETERMINED for k, has in zip(best, letter)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores)], [*inner, "lang_pred", "score"]
            )

    found = flat.mapInArrow(run, f"{shape}, lang_pred string, score double")
    row = F.struct(*[F.col(c).alias(name) for c, name in zip(inner, df.columns)])
    return found.select(row.alias("row"), "lang_pred", "score")


def recognised(df: DataFrame, net: Network | None, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``df`` whose language is recognised: not ``und``, and with a score of at least ``least``."""
    found = predicted(df, net, text).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return found.select("row.*")


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(divisor))
