"""URL verdicts by a bit-parallel wildcard automaton.

All globs are packed into one row of 64-bit words, a bit per pattern position. One step of Shift-And moves every pattern
over the next byte of the canonical URL at once; a second mask keeps the bits of positions that stand at a wildcard.
Many URLs advance together, one numpy step per byte position.

Glob syntax: ``*`` is any run of characters without ``/``, ``**`` any run at all, all else stands for itself. The canonical URL is the
lower-cased host followed by the path.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SLASH = ord("/")


@dataclass(frozen=True)
class Rule:
    """``site`` is a host and a path prefix, such as ``example.net/en/``. It fits the host and all its subdomains."""

    verdict: str
    site: str

    @property
    def globs(self) -> tuple[str, str]:
        return f"{self.site}**", f"*.{self.site}**"


class Automaton:
    """Shift-And over several words of 64 bits with self-loops at wildcards."""

    def __init__(self, globs: list[str]) -> None:
        literal: list[tuple[int, int]] = []  # (bit, byte that leads into it)
        loops: list[tuple[int, bool]] = []  # (bit, whether its wildcard passes over slashes)
        self.begin, self.accept, bit = [], [], 0
        for glob in globs:
            self.begin.append(bit)
            at, data = 0, glob.encode()
            while at < len(data):
                if data[at:at + 1] == b"*":
                    wide = data[at:at + 2] == b"**"
                    loops.append((bit, wide))
                    at += 2 if wide else 1
                    continue
                bit += 1
                literal.append((bit, data[at]))
                at += 1
            self.accept.append(bit)
            bit += 1
        self.words = bit // 64 + 1
        self.step, self.stay = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        for b, byte in literal:
            self.step[byte, b // 64] |= np.uint64(1 << b % 64)
        for b, wide in loops:
            self.stay[:, b // 64] |= np.uint64(1 << b % 64)
            if not wide:
                self.stay[_SLASH, b // 64] &= np.uint64(~(1 << b % 64) & (1 << 64) - 1)
        self.first = np.zeros(self.words, np.uint64)
        for b in self.begin:
            self.first[b // 64] |= np.uint64(1 << b % 64)

    def accepted(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For every text (bytes ``data[at[i]:at[i + 1]]``) and glob whether the glob fits the whole text."""
        sizes = at[1:] - at[:-1]
        order = np.argsort(-sizes, kind="stable")
        starts, sizes_down = at[:-1][order], -sizes[order]
        state = np.tile(self.first, (len(order), 1))
        for k in range(int(-sizes_down[0]) if len(order) else 0):
            live = int(np.searchsorted(sizes_down, -k, "left"))  # texts longer than k
            now = state[:live]
            byte = data[starts[:live] + k]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.step[byte]) | (now & self.stay[byte])
        found = np.empty((len(order), len(self.accept)), bool)
        for g, b in enumerate(self.accept):
            found[order, g] = (state[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1)
        return found


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or URL."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or URL."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _longest(rules: list[Rule]):
    automaton = Automaton([glob for rule in rules for glob in rule.globs])
    ranked = sorted(range(len(rules)), key=lambda i: (len(rules[i].site), i))

    def run(canonical: pa.Array) -> pa.Array:
        column = canonical.cast(pa.large_binary())
        _, offsets, data = column.buffers()
        if not len(column) or data is None:
            return pa.nulls(len(column), pa.int32())
        at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
        fits = automaton.accepted(np.frombuffer(data, np.uint8), at).reshape(len(column), len(rules), 2).any(axis=2)
        best = np.full(len(column), -1)
        for i in ranked:  # longer ones last
            best[fits[:, i]] = i
        return pa.array(best.astype(np.int32), mask=best < 0)

    return run


def judged(df: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` as a struct column ``row``, with host, path, rule and verdict of its URL.

    The longest fitting rule wins, the later one of two equally long. Without one, ``rule`` is null and the verdict is
    ``default``. A null URL or one without ``://`` has an empty host and path, which no rule fits. Every row is judged on its own, repeated or not; an
    empty table gives no rows. The rule list is a parameter and stays in the plan; nothing is shuffled.
    """
    parts = df.select(F.struct("*").alias("row"), F.col(url).alias("_url")).select(
        "row", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path")
    )
    if not rules:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    run = _longest(rules)

    @F.arrow_udf(T.IntegerType())
    def longest_rule(canonical: pa.Array) -> pa.Array:
        return run(canonical)

    sites = F.array(*[F.lit(rule.site) for rule in rules])
    verdicts = F.array(*[F.lit(rule.verdict) for rule in rules])
    return (
        parts.withColumn("_n", longest_rule(F.concat("host", "path")))
        .withColumn("rule", F.get(sites, F.col("_n")))
        .withColumn("verdict", F.coalesce(F.get(verdicts, F.col("_n")), F.lit(default)))
        .drop("_n")
    )
