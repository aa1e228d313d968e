"""Answers: putting chunks together, pairing with cases, and running a caller's generation function."""

from __future__ import annotations

import multiprocessing
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pactmill import fixed_values as fv, session

PART_ROWS = 65_536


def assemble(
    chunks: DataFrame, request: str = "request_id", seq: str = "seq", content: str = "content",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Concatenate chunk contents in sequence order, one row per request; chunks after the final marker still count.

    Chunks are gathered and sorted in parts of ``part_rows``; the texts of a request's parts are then joined. Only an
    answer that does not fit in one value (2 GB) fails, as it must.
    """
    part = F.expr(f"{seq} div {part_rows}").alias("part")
    gathered = F.sort_array(F.collect_list(F.struct(F.col(seq).alias("seq"),
                                                    F.coalesce(F.col(content), F.lit("")).alias("content"))))
    return (
        chunks.groupBy(request, part)
        .agg(gathered.alias("chunks"))
        .select(request, "part", F.array_join(F.col("chunks.content"), "").alias("text"))
        .groupBy(request)
        .agg(F.sort_array(F.collect_list(F.struct("part", "text"))).alias("parts"))
        .select(request, F.array_join(F.col("parts.text"), "").alias("answer"))
    )


def pair_with_cases(cases: DataFrame, answers: DataFrame, key: str = "case_id", answer: str = "raw") -> DataFrame:
    """Every case with its answers; a case without one gets the empty answer.

    Matched and unmatched cases are found apart. Only an inner join can be split on a hot key on both sides, and the
    unmatched side needs nothing but distinct keys, which are reduced before they move. Shuffles start from more partitions as the tables grow.
    """
    session.finer(cases, answers)
    matched = cases.join(answers, key, "inner")
    unmatched = cases.join(answers.select(key).distinct(), key, "left_anti")
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in answers.schema.fields if f.name != key]
    together = matched.unionByName(unmatched.select("*", *extra))
    return together.withColumn(answer, F.coalesce(F.col(answer), F.lit("")))


class _Caller:
    """Runs a caller's model in a process of its own, which is ended when a call takes too long and started anew for the next one."""

    def __init__(self, load: Callable[[], Callable], batch: int | None, limit_s: float) -> None:
        self.load, self.batch, self.limit_s = load, batch, limit_s
        self.process = self.pipe = None

    def _serve(self, pipe) -> None:
        try:
            model = self.load()
        except Exception as failure:  # noqa: BLE001 - sent to the task, which fails with it
            pipe.send((None, f"{type(failure).__name__}: {failure}"))
            return
        pipe.send((True, None))
        while (calls := pipe.recv()) is not None:
            for texts in calls:
                began = time.perf_counter()
                try:
                    said = list(model(texts)) if self.batch else [model(texts[0])]
                    if len(said) != len(texts):
                        raise ValueError(f"{len(said)} answers to {len(texts)} texts")
                    pipe.send((said, None, time.perf_counter() - began))
                except Exception as failure:  # noqa: BLE001 - any failure of the caller's model is recorded
                    pipe.send((None, f"{type(failure).__name__}: {failure}", time.perf_counter() - began))

    def _start(self) -> None:
        forked = multiprocessing.get_context("fork")  # the model need not be sent, and the worker has no other threads
        self.pipe, far = forked.Pipe()
        self.process = forked.Process(target=self._serve, args=(far,), daemon=True)
        self.process.start()
        far.close()
        try:
            ready, error = self.pipe.recv()
        except EOFError:
            ready, error = None, "its process ended"
        if not ready:
            self.end()
            raise RuntimeError(f"the model could not be loaded: {error}")

    def call(self, calls: list[list[str]]) -> Iterator[tuple[list[str], str | None, float]]:
        """For each call the answers to its texts, or empty ones and the reason, and the seconds it took.

        The calls are sent together, and each one's answers come as soon as they are there: the model need not wait between them.
        """
        at = 0
        while at < len(calls):
            if self.process is None:
                self._start()
            began, error = time.perf_counter(), f"TimeoutError: no answer within {self.limit_s:g} s"
            try:
                self.pipe.send(calls[at:])
                while at < len(calls):
                    began = time.perf_counter()
                    if not self.pipe.poll(self.limit_s):
                        break
                    said, failed, seconds = self.pipe.recv()
                    yield (said if failed is None else [""] * len(calls[at])), failed, seconds
                    at += 1
            except (EOFError, OSError):
                error = "ChildProcessError: the model's process ended"
            if at < len(calls):
                self.end()
                yield [""] * len(calls[at]), error, time.perf_counter() - began
                at += 1

    def end(self) -> None:
        if self.process is not None:
            self.process.kill()
            self.process.join()
            self.process.close()
            self.pipe.close()
        self.process = self.pipe = None


def generate(
    df: DataFrame, instruction: str, load: Callable[[], Callable], keep: list[str], limit_s: float = fv.TIMEOUT_SECONDS,
    batch: int | None = None,
) -> DataFrame:
    """Run a caller's model over every instruction and store what it says, so that nothing that reads the result calls the
    model again.

    ``load`` is called once per partition, in a process of its own, and returns the function from instruction to answer; with ``batch``, the
    function from a list of up to so many instructions to the list of their answers. A call that fails, or takes longer than ``limit_s``
    seconds, gives empty answers and its error text; the job goes on. A call that is too long is ended with its process, and the model is
    loaded again for the next one. ``elapsed_ms`` is a text's share of its call.
    """
    kept = df.select(*keep, F.col(instruction).alias("instruction"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    size = batch or 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        caller = _Caller(load, batch, limit_s)

        def answered(rows: pd.DataFrame) -> pd.DataFrame:
            answers, errors, elapsed = [], [], []
            texts = rows["instruction"].tolist()
            parts = [texts[at:at + size] for at in range(0, len(texts), size)]
            for part, (said, error, seconds) in zip(parts, caller.call(parts)):
                answers += said
                errors += [error] * len(part)
                elapsed += [int(seconds * 1000 / len(part))] * len(part)
            return rows.assign(raw=answers, error=errors, elapsed_ms=elapsed)

        try:
            rest = None
            for rows in batches:  # calls reach over Arrow batches, so that only a partition's last one is short
                rows = rows if rest is None or rest.empty else pd.concat([rest, rows])
                full = len(rows) // size * size
                rest = rows.iloc[full:]
                if full:
                    yield answered(rows.iloc[:full])
            if rest is not None and not rest.empty:
                yield answered(rest)
        finally:
            caller.end()

    generated = kept.mapInPandas(run, f"{schema}, raw string, error string, elapsed_ms bigint")
    return session.stored(generated, "generated")
