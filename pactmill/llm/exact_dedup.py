"""Exact deduplication by Grace hashing.

1. Each task collapses equal texts of its own input before anything moves, so a text that a third of all rows share
   leaves a task once per filled table, not once per row.
2. The collapsed texts are shuffled by content. A task that receives more distinct content than its table may hold
   partitions it to spill files by the next hash, and those again, until every bucket fits an open-addressing table.
   Tables compare complete content, never only hashes.
3. Rows find their group through the number of the collapsed row that stood for them: narrow rows only.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from pactmill import session

TABLE_BYTES = 48 << 20  # distinct content that one table may hold
FANOUT = 16

_COLLAPSED = "key bigint, row bigint, stand_in bigint, content binary, best_key bigint, best_row bigint, n bigint"
_RESOLVED = "stand_in bigint, keep_key bigint, keep_row bigint, group_size bigint, text_sha256 string"


class ContentTable:
    """Open addressing with linear probing over complete contents."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.values: list[list] = []
        self.bytes = 0

    def __len__(self) -> int:
        return len(self.contents)

    def find(self, content: bytes, level: int = 0) -> list | None:
        """The value list of ``content``; an empty one the first time."""
        hashed = xxhash.xxh3_64_intdigest(content, level)
        mask = len(self.slots) - 1
        at = hashed & mask
        while (k := self.slots[at]) >= 0:
            if self.hashes[k] == hashed and self.contents[k] == content:
                return self.values[k]
            at = (at + 1) & mask
        self.slots[at] = len(self.contents)
        self.hashes.append(hashed)
        self.contents.append(content)
        self.values.append([])
        self.bytes += len(content) + 64
        if 3 * len(self.contents) > 2 * len(self.slots):
            self._grow()
        return self.values[-1]

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for k, hashed in enumerate(self.hashes):
            at = hashed & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k


def _better(one: tuple, other: tuple) -> bool:
    """Whether (key, row) ``one`` stays rather than ``other``: the largest key, then the first row; null is smallest."""
    if one[0] == other[0]:
        return one[1] < other[1]
    return other[0] is None or (one[0] is not None and one[0] > other[0])


def _collapse(table_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            keys, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            stand_ins = []
            for key, row, content in zip(keys, rows, batch.column(2).cast(pa.binary()).to_pylist()):
                value = table.find((content or b"").lower())
                if not value:
                    value += [row, key, row, 0]
                value[3] += 1
                if _better((key, row), (value[1], value[2])):
                    value[1:3] = key, row
                stand_ins.append(value[0])
            yield _narrow(keys, rows, stand_ins)
            if table.bytes > table_bytes:
                yield from _collapsed(table)
                table = ContentTable()
        yield from _collapsed(table)

    return run


def _batch(ddl_types: list, columns: list) -> pa.RecordBatch:
    names = ["key", "row", "stand_in", "content", "best_key", "best_row", "n"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ddl_types)], names)


_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def _narrow(keys: list, rows: list, stand_ins: list) -> pa.RecordBatch:
    nothing = [None] * len(keys)
    return _batch(_TYPES, [keys, rows, stand_ins, nothing, nothing, nothing, nothing])


def _collapsed(table: ContentTable, step: int = 256) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(table), step):
        values = table.values[i:i + step]
        nothing = [None] * len(values)
        stand_in, key, row, n = zip(*values)
        yield _batch(_TYPES, [nothing, nothing, stand_in, table.contents[i:i + step], key, row, n])


def grace_groups(records: Iterable[tuple], table_bytes: int, level: int = 1) -> Iterator[tuple[bytes, list]]:
    """Merge (content, [stand_ins, best key, best row, n]) records of equal content, each content once.

    While the distinct content fits ``table_bytes``, one table takes it. Beyond that the table and all further records
    go to ``FANOUT`` spill files by the next hash, and each file is merged in the same way. A table takes one content of
    any size.
    """
    table, files, folder = ContentTable(), None, None
    try:
        for content, value in records:
            if files is not None:
                _spill(files, content, value, level)
                continue
            held = table.find(content, level)
            if held:
                held[0].extend(value[0])
                held[3] += value[3]
                if _better(tuple(value[1:3]), tuple(held[1:3])):
                    held[1:3] = value[1:3]
            else:
                held += [list(value[0]), *value[1:]]
            table.bytes += 8 * len(value[0])
            if table.bytes > table_bytes and len(table) > 1:
                folder = tempfile.TemporaryDirectory(prefix="grace-")
                files = [open(os.path.join(folder.name, str(k)), "w+b") for k in range(FANOUT)]
                for content_, value_ in zip(table.contents, table.values):
                    _spill(files, content_, value_, level)
                table = ContentTable()
        if files is None:
            yield from zip(table.contents, table.values)
            return
        for file in files:
            file.seek(0)
            yield from grace_groups(_read_back(file), table_bytes, level + 1)
            file.close()
    finally:
        for file in files or ():
            file.close()
        if folder is not None:
            folder.cleanup()


def _spill(files: list, content: bytes, value: list, level: int) -> None:
    bucket = xxhash.xxh3_64_intdigest(content, 1_000_003 * (level + 1)) % FANOUT
    pickle.dump((content, value), files[bucket], pickle.HIGHEST_PROTOCOL)


def _read_back(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _resolve(table_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                for content, stand_in, key, row, n in zip(*(batch.column(i).to_pylist() for i in range(5))):
                    yield content, [[stand_in], key, row, n]

        out: list[list] = [[], [], [], [], []]
        for content, (stand_ins, key, row, n) in grace_groups(records(), table_bytes):
            sha = hashlib.sha256(content).hexdigest()
            for column, value in zip(out, (stand_ins, *([v] * len(stand_ins) for v in (key, row, n, sha)))):
                column.extend(value)
            if len(out[0]) >= 1024:
                yield _resolved(out)
                out = [[], [], [], [], []]
        yield _resolved(out)

    return run


def _resolved(columns: list[list]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = ["stand_in", "keep_key", "keep_row", "group_size", "text_sha256"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row with the largest
    key stays, a null key being smallest; among rows that share that key exactly one stays. ``kept`` marks it. An empty
    table gives no rows. Columns other than the two named are not looked at.
    """
    rows = df.select(
        F.col(key).cast("bigint").alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")
    )
    # stored, so that row numbers and stand-ins stay the same whatever is read again after a loss
    collapsed = session.stored(rows.mapInArrow(_collapse(table_bytes), _COLLAPSED), "collapsed-texts")
    contents = collapsed.where("content is not null").select("content", "stand_in", "best_key", "best_row", "n")
    resolved = contents.repartition(F.xxhash64("content")).mapInArrow(_resolve(table_bytes), _RESOLVED)
    members = collapsed.where("row is not null").select("key", "row", "stand_in")
    return members.join(resolved, "stand_in").select(
        F.col("key").alias(key), F.col("keep_key").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256",
    )


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``df`` that stay, all their columns as they are. Of rows that agree in key and text one stays."""
    plain = lambda key_: (key_.isNull().alias("_null"), F.coalesce(key_, F.lit(0).cast("bigint")).alias("_key"))
    found = groups(df, key, text, table_bytes).where("kept").select(*plain(F.col(key)), F.col("text_sha256").alias("_sha"))
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = df.select(
        F.struct("*").alias("row"), *plain(F.col(key).cast("bigint")), F.sha2(lowered.cast("binary"), 256).alias("_sha")
    )
    # the window is over the columns of the join, so that rows move once for both
    same = ["_null", "_key", "_sha"]
    kept = rows.join(found, same, "left_semi").withColumn("_n", F.row_number().over(Window.partitionBy(*same).orderBy("_key")))
    return kept.where("_n = 1").select("row.*")
