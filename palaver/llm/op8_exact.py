"""Operator 8: exact deduplication by Grace hash partitioning.

1. Each task aggregates its own rows in an open-addressing table of complete contents. A content leaves the task once
   per table, so a text that a third of all rows hold is shuffled once per task, not once per row.
2. Spark partitions these contents by hash. A task reads its partition into an open-addressing table of bounded size;
   contents that find it full are written to spill files by the next bits of the hash, and each file is read the same
   way. Only different contents take space, so many copies of one content cannot overfill a table. The spill files are
   the task's own scratch, gone when it ends; nobody else reads them, and a task that is lost starts again.
3. The groups found go back to the rows by the number of the table entry that a row was aggregated in.

Contents are compared whole. A hash only says where to look.
"""

import hashlib
import pickle
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.tables import in_slices, read, texts_of
from palaver.workspace import write_once

TABLE_BYTES = 48_000_000
FAN_OUT_BITS = 4

Record = tuple[int, bytes, int, int | None, int, int]  # hash, content, entry, largest doc_id, its row, rows


class OpenTable:
    """Contents by linear probing, at most ``limit`` bytes of them; ``-1`` marks an empty slot."""

    def __init__(self, limit: int):
        self.limit, self.used = limit, 0
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def find(self, key: int, content: bytes) -> int | None:
        """The index of the content, added if it is new; None if it is new and the table is full."""
        mask = len(self.slots) - 1
        at = key & mask
        while (i := self.slots[at]) >= 0:
            if self.hashes[i] == key and self.contents[i] == content:
                return i
            at = (at + 1) & mask
        if self.contents and self.used + len(content) + 100 > self.limit:
            return None
        self.slots[at] = len(self.contents)
        self.used += len(content) + 100
        self.hashes.append(key)
        self.contents.append(content)
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return len(self.contents) - 1

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for i, key in enumerate(self.hashes):
            at = key & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def normalised(text: str) -> bytes:
    """UTF-8 with A-Z in lower case; texts are equal when these bytes are."""
    return text.encode().lower()


def later(doc: int | None, row: int, other: int | None, other_row: int) -> bool:
    """Whether the first row is to stay rather than the other: the larger doc_id, null lowest, then the later row."""
    return (doc is not None, doc or 0, row) > (other is not None, other or 0, other_row)


def aggregate(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """A row per document with its table entry; the row that opened an entry has the content, the last one its totals."""
    base = TaskContext.get().partitionId() << 36
    row = entry_base = base
    table, totals = OpenTable(limit), []

    def close() -> pa.RecordBatch:
        entries = range(entry_base, entry_base + len(totals))
        return _rows(None, None, list(entries), [t[0] for t in totals], [t[1] for t in totals], [t[2] for t in totals], table.hashes, table.contents)

    for part in in_slices(batches):
        docs, entries, rows = part.column("doc_id").to_pylist(), [], []
        for doc, text in zip(docs, part.column("text").to_pylist()):
            content = normalised(text)
            key = xxhash.xxh3_64_intdigest(content)
            if (i := table.find(key, content)) is None:
                yield close()
                entry_base += len(totals)
                table, totals = OpenTable(limit), []
                i = table.find(key, content)
            if i == len(totals):
                totals.append([doc, row, 0])
            total = totals[i]
            total[2] += 1
            if later(doc, row, total[0], total[1]):
                total[:2] = doc, row
            entries.append(entry_base + i)
            rows.append(row)
            row += 1
        yield _rows(docs, rows, entries)
    yield close()


def _rows(docs, rows, entries, top=None, top_row=None, count=None, hashes=None, contents=None) -> pa.RecordBatch:
    none = [None] * len(entries)
    columns = [
        pa.array(docs if docs is not None else none, pa.int64()),
        pa.array(rows if rows is not None else none, pa.int64()),
        pa.array(entries, pa.int64()),
        pa.array(top or none, pa.int64()),
        pa.array(top_row or none, pa.int64()),
        pa.array(count or none, pa.int64()),
        pa.array(np.array(hashes or [], np.uint64).view(np.int64) if hashes else none, pa.int64()),
        pa.array(contents or none, pa.binary()),
    ]
    return pa.record_batch(columns, names=["doc_id", "row", "entry", "top", "top_row", "rows", "hash", "content"])


def grace(records: Iterator[Record], limit: int, shift: int = 64 - FAN_OUT_BITS) -> Iterator[list[tuple]]:
    """The groups of equal contents: lists of (entry, doc_id that stays, its row, group size, digest), one per record."""
    table, groups = OpenTable(limit), []
    with tempfile.TemporaryDirectory() as folder:
        files: dict[int, object] = {}
        for key, content, entry, top, top_row, rows in records:
            if (i := table.find(key, content)) is None:
                # the hash's bits from the top; a partition that runs out of bits goes on with one file
                bucket = key >> shift & ((1 << FAN_OUT_BITS) - 1) if shift >= 0 else 0
                if bucket not in files:
                    files[bucket] = open(f"{folder}/{bucket}", "w+b")
                pickle.dump((key, content, entry, top, top_row, rows), files[bucket])
                continue
            if i == len(groups):
                groups.append([[], top, top_row, 0])
            group = groups[i]
            group[0].append(entry)
            group[3] += rows
            if later(top, top_row, group[1], group[2]):
                group[1:3] = top, top_row
        for (entries, top, top_row, size), content in zip(groups, table.contents):
            digest = hashlib.sha256(content).digest()
            yield [(entry, top, top_row, size, digest) for entry in entries]
        table, groups = None, []
        for file in files.values():
            file.seek(0)
            yield from grace(_spilled(file), limit, shift - FAN_OUT_BITS)
            file.close()


def _spilled(file) -> Iterator[Record]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def grouping(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task that finds the groups of its partition."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[Record]:
        for batch in batches:
            keys = batch.column("hash").to_numpy().view(np.uint64).tolist()
            rest = (batch.column(c).to_pylist() for c in ("entry", "top", "top_row", "rows"))
            for i, (key, *others) in enumerate(zip(keys, *rest)):
                yield key, batch.column("content")[i].as_py(), *others

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["entry", "keep_id", "keep_row", "group_size", "digest"]
        types = [pa.int64()] * 4 + [pa.binary()]
        held: list[tuple] = []
        for found in grace(records(batches), limit):
            held += found
            if len(held) >= 10_000:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
                held = []
        if held:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    return run


def exact_groups(docs: DataFrame, limit: int = TABLE_BYTES) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``digest`` (SHA-256, binary) of every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; a null text is empty. Of equal texts exactly one row is kept,
    that with the largest doc_id; a null doc_id is lower than any other, and of rows that repeat a doc_id one is kept.
    ``keep_id`` is null only if all doc_ids of the group are. An empty table gives no rows, other columns are ignored.
    ``limit``: bytes of contents that a table holds; it does not change the result.
    """
    columns = "doc_id bigint, row bigint, entry bigint, top bigint, top_row bigint, rows bigint, hash bigint, content binary"
    tables = write_once(texts_of(docs).mapInArrow(lambda batches: aggregate(batches, limit), columns), "contents")
    contents = tables.where("rows is not null").drop("doc_id", "row")
    found = contents.repartition(F.col("hash")).mapInArrow(
        grouping(limit), "entry bigint, keep_id bigint, keep_row bigint, group_size bigint, digest binary"
    )
    members = tables.where("rows is null").select("doc_id", "row", "entry")
    return members.join(found, "entry").select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document, and whether it stays."""
    found = exact_groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
WITH n AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
