"""Putting streamed answer chunks together, with a time-out on event time.

Requests are dealt by hash over many groups; a group is Spark's key, and its rows of a micro-batch are handled in one call. An open request has
a record of its own in the state, and each micro-batch adds its chunks behind those that wait. Requests that are done leave only their id and time,
many to a state row. A micro-batch reads and writes the records and chunks of the requests it has chunks of, and of no others; beside these it reads
the ids that are done in the groups it touches. A group has one timer, at the earliest time at which one of its requests may be due; only
then are the records of the group gone through.

* An answer is one row, emitted once: when the final chunk and all earlier ones have arrived.
* After that a tombstone absorbs late chunks until its time is up.
* When nothing arrives for ``timeout_s`` of event time the answer becomes the empty text (``how = 'timeout'``), or, if the
  final chunk had come but earlier ones are missing, the text that did arrive (``how = 'gap'``).
* Rows without request, sequence number or time, such as lines that could not be read, are not chunks: ``assembled`` leaves
  them out and ``unusable`` gives them.

Time-outs fire only as the watermark moves: a stream that goes quiet does not time out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pactmill import fixed_values as fv

OUTPUT = "request_id string, answer string, how string"
UNUSABLE = "unusable"  # ``how`` of a row that is no chunk; its answer is the whole row as JSON
GROUPS = 16_384  # requests are dealt over so many groups
PART_ROWS = 65_536  # chunks to a state row, at most
LATEST = "2262-01-01"  # times after it count as this one
PACKS = 16  # more rows of ids that are done than this are joined to one
# an open request: the sequence number marked final or -1, the last event time, the time to look at it, its chunk rows, the waiting chunks
RECORD = "final bigint, last_ms bigint, due_ms bigint, parts bigint, waiting bigint"
CHUNKS = "seqs array<bigint>, contents array<string>"
CLOSED = "ids array<string>, last_ms array<bigint>, due_ms array<bigint>"
_USABLE = "request_id is not null and seq is not null and ts is not null"


def _rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["request_id", "answer", "how"], dtype=object)


class Assembly(StatefulProcessor):
    """The requests of one group: their records, their waiting chunks, the ids of those that are done, and one timer.

    The time to look at a request is only moved when it has come: if chunks arrived in the meantime it is set anew.
    """

    def __init__(self, timeout_ms: int) -> None:
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.records = handle.getMapState("records", "request_id string", RECORD)
        self.chunks = handle.getMapState("chunks", "request_id string, part bigint", CHUNKS)
        self.closed = handle.getListState("closed", CLOSED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        closed = self._closed()
        fresh, finals, lasts = {}, {}, {}
        for frame in rows:
            lines = []
            columns = (frame[c].tolist() for c in ("request_id", "seq", "ms", "content", "done"))
            for request, seq, ms, content, done in zip(*columns):
                if request is None:  # no chunks: they pass, and nothing is kept of them
                    lines.append((None, content, UNUSABLE))
                    continue
                lasts[request] = max(lasts.get(request, 0), ms)
                if request not in closed:
                    fresh.setdefault(request, {})[seq] = content or ""
                    if done:
                        finals[request] = min(finals.get(request, seq), seq)
            if lines:
                yield _rows(lines)
        answers, ended, due = [], {}, []
        # an empty group is seen in one look, without one for each request
        known = len(fresh) == 1 or bool(fresh) and self.records.exists()
        for request, pieces in fresh.items():
            record = self.records.getValue((request,)) if known else None
            final, last_ms, due_ms, parts, waiting = record or (-1, 0, 0, 0, 0)
            last_ms = max(last_ms, lasts[request])
            if request in finals:
                final = finals[request] if final < 0 else min(final, finals[request])
            if not due_ms:
                due_ms = self._due(last_ms, mark)
                due.append(due_ms)
            # a look at the chunks that wait is only worth it when there may be enough of them
            whole = pieces
            if waiting and 0 <= final < waiting + len(pieces):
                whole = self._waiting(request, parts) | pieces
            if final >= 0 and len(whole) > final and all(seq in whole for seq in range(final + 1)):
                answers.append((request, "".join(whole[seq] for seq in sorted(whole)), "done"))
                ended[request] = (last_ms, due_ms)
                if record:
                    self._forget(request, parts)
            else:
                parts = self._wait(request, parts, list(pieces.items()))
                self.records.updateValue((request,), (final, last_ms, due_ms, parts, waiting + len(pieces)))
        for request in lasts.keys() & closed.keys():
            if lasts[request] > closed[request][0]:
                ended[request] = (lasts[request], closed[request][1])
        if ended:
            self.closed.appendList([self._pack(ended)])
        if due:
            self._wake(min(due))
        if answers:
            yield _rows(answers)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        answers, due = [], []
        for (request,), (final, last_ms, due_ms, parts, waiting) in list(self.records.iterator()):
            if due_ms < mark:
                if last_ms + self.timeout_ms < mark:
                    pieces = self._waiting(request, parts) if final >= 0 else {}
                    text = "".join(pieces[seq] for seq in sorted(pieces))
                    answers.append((request, text, "gap" if final >= 0 else "timeout"))
                    self._forget(request, parts)
                    continue
                due_ms = self._due(last_ms, mark)
                self.records.updateValue((request,), (final, last_ms, due_ms, parts, waiting))
            due.append(due_ms)
        closed = self._closed()
        kept = {
            request: (last_ms, due_ms if due_ms >= mark else self._due(last_ms, mark))
            for request, (last_ms, due_ms) in closed.items() if due_ms >= mark or last_ms + self.timeout_ms >= mark
        }
        if not kept:
            self.closed.clear()
        elif kept != closed:
            self.closed.put([self._pack(kept)])
        due += [due_ms for _, due_ms in kept.values()]
        if due:  # later than the watermark, so that it does not end in this batch
            self.handle.registerTimer(min(due))
        if answers:
            yield _rows(answers)

    def _closed(self) -> dict[str, tuple[int, int]]:
        """Last event time and time to look of the requests that are done; what came last about a request holds."""
        packs = list(self.closed.get())
        closed = {request: (last_ms, due_ms) for pack in packs for request, last_ms, due_ms in zip(*pack)}
        if len(packs) > PACKS:
            self.closed.put([self._pack(closed)])
        return closed

    @staticmethod
    def _pack(closed: dict[str, tuple[int, int]]) -> tuple:
        return [*closed], [last_ms for last_ms, _ in closed.values()], [due_ms for _, due_ms in closed.values()]

    def _wait(self, request: str, parts: int, pieces: list[tuple]) -> int:
        """Add chunks behind those that wait; the number of chunk rows there are then."""
        for at in range(0, len(pieces), PART_ROWS):
            seqs, contents = zip(*pieces[at:at + PART_ROWS])
            self.chunks.updateValue((request, parts), ([*seqs], [*contents]))
            parts += 1
        return parts

    def _waiting(self, request: str, parts: int) -> dict[int, str]:
        """The chunks in the order in which they came: a chunk that came twice counts as it came last."""
        return {seq: text for part in range(parts) for seq, text in zip(*self.chunks.getValue((request, part)))}

    def _forget(self, request: str, parts: int) -> None:
        self.records.removeKey((request,))
        for part in range(parts):
            self.chunks.removeKey((request, part))

    def _due(self, last_ms: int, mark: int) -> int:
        """One millisecond behind the last moment at which the request is still alive, not behind the watermark."""
        return max(last_ms + self.timeout_ms, mark) + 1

    def _wake(self, due_ms: int) -> None:
        timers = list(self.handle.listTimers())
        if not timers or due_ms < min(timers):
            for timer in timers:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due_ms)

    def close(self) -> None:
        pass


def unusable(chunks: DataFrame) -> DataFrame:
    """Rows that are no chunks, as they are: a stream of its own for a quarantine."""
    return chunks.where(f"not ({_USABLE})")


def assembled(
    chunks: DataFrame, timeout_s: int = fv.TIMEOUT_SECONDS, watermark: str = "10 seconds", keep_unusable: bool = False,
    groups: int = GROUPS,
) -> DataFrame:
    """Stream of (request_id, seq, ts, content, done) to a stream of answers; with ``keep_unusable`` rows that are no chunks come along, marked
    by ``how``, so that one query can write both. A stream keeps its number of ``groups`` as long as it keeps its checkpoint."""
    usable = F.expr(_USABLE)
    rows = chunks if keep_unusable else chunks.where(usable)
    line = F.to_json(F.struct(*(F.col(f"`{c}`") for c in chunks.columns)))
    whole = F.when(~usable, line)
    # pandas holds no later times than those of 2262; rows that are no chunks get numbers too, so that no whole number turns into a float
    timed = rows.withColumn("_line", whole).withColumn("ts", F.when(F.col("ts").isNotNull(), F.least("ts", F.lit(LATEST).cast("timestamp"))))
    keyed = timed.withWatermark("ts", watermark).select(
        F.pmod(F.xxhash64(F.coalesce("_line", "request_id")), F.lit(groups)).alias("group"), F.when(usable, F.col("request_id")).alias("request_id"),
        F.coalesce("seq", F.lit(0)).alias("seq"), "ts", F.coalesce(F.unix_millis("ts"), F.lit(0)).alias("ms"),
        F.when(usable, F.col("content")).otherwise(F.col("_line")).alias("content"), F.coalesce("done", F.lit(False)).alias("done"),
    )
    return keyed.groupBy("group").transformWithStateInPandas(
        Assembly(timeout_s * 1000), OUTPUT, outputMode="Append", timeMode="EventTime"
    )
