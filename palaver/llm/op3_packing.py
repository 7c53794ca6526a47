"""Operator 3: packing of token sequences by hierarchical residual best fit.

Leaves: each task tokenises its rows and packs them in blocks of bounded size. Pieces of full length are sequences of
their own; the rest go, longest first, into the sequence with the least room that takes them. Nodes: sequences that are
nearly full are done. The underfull ones are items of the next round, in which ``FAN_IN`` nodes are merged and packed
again, until one node is left.

After best fit at most one sequence of a node is half empty or more, so a node can gain no more than a sequence for each
sibling's such sequence. It is thus enough to pass up the ``CARRY`` sequences with most room, which bounds every task of
the tree; the others are done, with all their pieces.
"""

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.tables import read, texts_of
from palaver.workspace import write_once

CAPACITY = 1024
END = 2
BLOCK = 200_000
FAN_IN = 16
CARRY = 512
NEARLY_FULL = 4
CACHE = 400_000
#: A task's blocks are numbered within this many; a task number above it starts at the next multiple.
BLOCKS_EACH = 1 << 20
# More rows than a task packs.
ROWS_EACH = 1 << 40

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit integers, of a byte-level BPE vocabulary.

    The ids are those of the tokenizer file with ``add_special_tokens=False``; the same vocabulary as ranks is five times
    as fast. ``added`` are the ids of the file's added tokens: a text is split at them first, and they get their id.
    Pre-tokens do not cross a space before a character that is not white space, so the ids of what is between such spaces
    are kept in a table of at most ``CACHE`` entries.
    """

    def __init__(self, ranks_path: str, added: dict[str, int] | None = None):
        import base64

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}
        self.added = {token: np.array([i], "<u4").tobytes() for token, i in (added or {}).items()}
        self.split = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})").split if self.added else None

    def _plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.split and len(spans := self.split(text)) > 1:
            return b"".join(self.added[x] if i % 2 else self._between(x) for i, x in enumerate(spans))
        return self._between(text)

    def _between(self, text: str) -> bytes:
        parts = text.split(" ")
        if not all(part and not part[0].isspace() for part in parts[1:]):
            return self._plain(text)
        known, found = self.known, [self._plain(parts[0])]
        for part in parts[1:]:
            ids = known.get(part)
            if ids is None:
                if len(known) >= CACHE:
                    known.clear()
                ids = known[part] = self._plain(" " + part)
            found.append(ids)
        return b"".join(found)


def added_tokens(tokenizer_path: str) -> dict[str, int]:
    """The ids of a tokenizer file's added tokens, which are taken as they stand anywhere in a text."""
    with open(tokenizer_path, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    if odd := [t["content"] for t in tokens if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]:
        raise ValueError(f"added tokens that are not taken as they stand: {odd}")
    return {t["content"]: t["id"] for t in tokens}


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """For each item its bin and its offset there, and the used length of each bin; longest items first."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, []  # bit r of rooms: some bin has room r
    for item in order.tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(used)
            used.append(0)
        bins[item], offsets[item] = at, used[at]
        used[at] += length
        left = room - length
        if left:
            with_room[left].append(at)
            rooms |= 1 << left
    return bins, offsets, used


def carried(used: np.ndarray, capacity: int, carry: int) -> np.ndarray:
    """Which bins go on to the next round: the underfull ones, those with most room first."""
    order = np.argsort(used, kind="stable")[:carry]
    goes = np.zeros(len(used), bool)
    goes[order] = used[order] < capacity - NEARLY_FULL
    return goes


def pieces(docs: DataFrame, ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit) of every document.

    A document is the ids of its text and then ``END``. A longer one than ``capacity`` is cut from its end, so that only
    its first piece is shorter. A null or empty text is the one id ``END``. The tokenizer file beside the ranks, of the
    same name, gives the added tokens.
    """
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    added = added_tokens(ranks_path.removesuffix(".tiktoken") + ".json")
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path, added)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows = batch.slice(at, 500), []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = encoder.encode(text) + end
                    n, start = len(ids) // 4, 0
                    first = n % capacity or capacity
                    for piece, stop in enumerate(range(first, n + 1, capacity)):
                        rows.append((doc, piece, start, stop - start, ids[4 * start : 4 * stop]))
                        start = stop
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()])], names=["doc_id", "piece", "start", "length", "ids"])

    return texts_of(docs).mapInArrow(run, PIECE)


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, fan_in: int = FAN_IN, carry: int = CARRY) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset`` (bigint): every row's sequence and its gapless place there.

    ``items`` has ``length`` (1 to ``capacity``) and any other columns but the two that are added; it is evaluated once.
    Ties are packed in the order of the rows. An empty table gives no rows.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        # A leaf ends with the batch that fills it, so bins are numbered by the rows that the task has packed before.
        node, first, held, rows = task * BLOCKS_EACH, task * ROWS_EACH, [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= block:
                yield packed(held, node, first)
                node, first, held, rows = node + 1, first + rows, [], 0
        if rows:
            yield packed(held, node, first)

    def packed(held: list[pa.RecordBatch], node: int, first: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        bins, offsets, used = best_fit(table.column("length").to_numpy(), capacity)
        used = np.array(used, np.int64)
        added = [
            ("_node", pa.array(np.full(len(bins), node))),
            ("_bin", pa.array(first + bins)),
            ("_offset", pa.array(offsets)),
            ("_used", pa.array(used[bins])),
            ("_goes", pa.array(carried(used, capacity, carry)[bins])),
        ]
        for name, values in added:
            table = table.append_column(name, values)
        return table.to_batches()[0]

    leaves = write_once(
        items.mapInArrow(leaf, f"{columns}, _node bigint, _bin bigint, _offset bigint, _used bigint, _goes boolean"), "leaves"
    )
    level = leaves.where("_goes").groupBy("_bin").agg(F.first("_node").alias("node"), F.first("_used").alias("used"))
    level = level.select(F.col("_bin").alias("bin"), _leaf_number(leaves), "used")
    level = write_once(level, "packing-level")
    moves = None
    while True:
        nodes = level.agg(F.max("node")).first()[0]
        if nodes is None:
            break
        found = level.withColumn("node", F.expr(f"node div {fan_in}")).groupBy("node").applyInPandas(
            _merge(capacity, carry), "node bigint, bin bigint, sequence bigint, shift bigint, used bigint, goes boolean"
        )
        found = write_once(found, "packing-level")
        step = found.select("bin", "sequence", "shift")
        moves = step if moves is None else _followed(moves, step)
        if nodes < fan_in:
            break
        level = found.where("goes").groupBy("sequence").agg(F.first("node").alias("node"), F.first("used").alias("used"))
        level = write_once(level.select(F.col("sequence").alias("bin"), "node", "used"), "packing-level")
    if moves is None:
        return leaves.select(*items.columns, F.col("_bin").alias("sequence_id"), F.col("_offset").alias("offset"))
    placed = leaves.join(moves, F.col("_bin") == F.col("bin"), "left")
    return placed.select(
        *[F.col(c) for c in items.columns],
        F.coalesce("sequence", "_bin").alias("sequence_id"),
        (F.col("_offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )


def _leaf_number(leaves: DataFrame):
    """Leaves in a dense order: a task's first block is its own number, further ones are spread behind the tasks."""
    return F.expr(f"node div {BLOCKS_EACH} + node % {BLOCKS_EACH} * 1024").alias("node")


def _followed(moves: DataFrame, step: DataFrame) -> DataFrame:
    """The moves of the rounds so far, followed by those of the next round."""
    step = step.select(F.col("bin").alias("via"), F.col("sequence").alias("to"), F.col("shift").alias("by"))
    on = moves.join(step, F.col("sequence") == F.col("via"), "left")
    return on.select("bin", F.coalesce("to", "sequence").alias("sequence"), (F.col("shift") + F.coalesce("by", F.lit(0))).alias("shift"))


def _merge(capacity: int, carry: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One round of best fit over the bins of a node; a new bin is named after its first part."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bin")
        bins, offsets, used = best_fit(group["used"].to_numpy(), capacity)
        used = np.array(used, np.int64)
        names = np.empty(len(used), np.int64)
        first = offsets == 0
        names[bins[first]] = group["bin"].to_numpy()[first]
        return pd.DataFrame(
            {"node": group["node"], "bin": group["bin"], "sequence": names[bins], "shift": offsets, "used": used[bins], "goes": carried(used, capacity, carry)[bins]}
        )

    return run


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place; the ids themselves as a checksum."""
    made = pieces(read(spark, sf_dir, "documents"))
    return pack(made.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
