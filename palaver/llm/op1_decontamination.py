"""Operator 1: benchmark decontamination by greedy string tiling.

Every run of ``SEED`` words of the benchmark is a seed, named by its Karp-Rabin fingerprint; a shorter item is one as a
whole. Documents emit the places of
their own runs that may be seeds (a bitmap of fixed size tells, however large the benchmark is), and a join on the
fingerprint gives the places that a document and an item share. All matches of ``SEED`` words or more are runs of such
places on a diagonal, so tiling needs no text: the longest match whose words are all unmarked is marked in both texts,
what marking leaves of overlapping matches goes back, until no match is long enough. The marked share of an item's
words is its coverage, in which passages that were put in another order count as much as a whole copy.

Words are runs of letters and digits (ASCII signs and white space are between them) in lower case.
"""

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.shingles import runs, words
from palaver.llm.tables import bitmap, in_slices, passes, read, texts_of
from palaver.workspace import write_once

SEED = 5
COVERAGE = 0.6
SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def places(texts: list[str], seed: int, shorter: tuple[int, ...] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each text the fingerprints of its runs of ``seed`` words with their places, and its number of words.

    Also the first one of each different run of the ``shorter`` lengths; None takes the whole of a text that is shorter.
    """
    hashes, begins = words([t.lower() for t in texts], SEPARATORS)
    found, more = runs(hashes, seed), [(n, runs(hashes, n)) for n in shorter or ()]
    for start, stop in zip(begins[:-1].tolist(), begins[1:].tolist()):
        n = stop - start
        if shorter is None and 0 < n < seed:
            yield runs(hashes[start:stop], n), np.zeros(1, np.int64), n
            continue
        own = found[start : max(start, stop - seed + 1)]
        seeds, at = [own], [np.arange(len(own))]
        for length, all_ in more:
            once, first = np.unique(all_[start : max(start, stop - length + 1)], return_index=True)
            seeds.append(once)
            at.append(first)
        yield np.concatenate(seeds), np.concatenate(at), n


def seed_rows(table: DataFrame, key: str, seed: int, marks=None, shorter: tuple[int, ...] | None = None) -> DataFrame:
    """``row``, ``key``, ``n_words``, ``place``, ``seed`` of every run of ``seed`` words that may be in the bitmap.

    ``shorter`` is that of ``places``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for part in in_slices(batches):
            rows, keys, sizes, at, seeds = [], [], [], [], []
            for doc, (found, begins, n) in zip(part.column("doc_id").to_pylist(), places(part.column("text").to_pylist(), seed, shorter)):
                found = found.view(np.int64)
                where = np.flatnonzero(passes(marks.value, found)) if marks else np.arange(len(found))
                at.append(begins[where])
                seeds.append(found[where])
                rows.append(np.full(len(where), row))
                sizes.append(np.full(len(where), n))
                keys += [doc] * len(where)
                row += 1
            columns = [np.concatenate(rows), pa.array(keys, pa.int64()), *(np.concatenate(c) for c in (sizes, at, seeds))]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["row", key, "n_words", "place", "seed"])

    return table.mapInArrow(run, f"row bigint, {key} bigint, n_words bigint, place bigint, seed bigint")


def tiles(pairs: list[tuple[int, int]], seed: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from shared places: (place in the document, place in the item, words) of every tile.

    Of matches of equal length the first in the document, then in the item, is marked first.
    """
    heap: list[tuple[int, int, int]] = []
    places_on = sorted({(q - p, p) for p, q in pairs})
    for (diagonal, _), group in groupby(enumerate(places_on), lambda x: (x[1][0], x[1][1] - x[0])):
        run = [p for _, (_, p) in group]
        heap.append((-(len(run) + seed - 1), run[0], run[0] + diagonal))
    heapq.heapify(heap)
    in_doc: set[int] = set()
    in_item: set[int] = set()
    found = []
    while heap:
        size, p, q = heapq.heappop(heap)
        free = [i for i in range(-size) if p + i not in in_doc and q + i not in in_item]
        if len(free) == -size:
            found.append((p, q, -size))
            in_doc.update(range(p, p - size))
            in_item.update(range(q, q - size))
            continue
        for _, group in groupby(enumerate(free), lambda x: x[1] - x[0]):
            part = [i for _, i in group]
            if len(part) >= seed:
                heapq.heappush(heap, (-len(part), p + part[0], q + part[0]))
    return found


def coverages(docs: DataFrame, benchmark: DataFrame, seed: int = SEED) -> DataFrame:
    """``row``, ``doc_id``, ``item_id``, ``n_item_words``, ``covered_words``, ``n_tiles``, ``longest_tile`` of each pair.

    A pair is here if the document and the item share ``seed`` words in a row, or all words of an item that has fewer.
    ``row`` tells rows with one doc_id apart.
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    seeds = write_once(seed_rows(items, "item_id", seed).withColumnsRenamed({"row": "item", "n_words": "n_item_words", "place": "item_place"}), "seeds")
    marks = docs.sparkSession.sparkContext.broadcast(bitmap(seeds, "seed"))
    lengths = seeds.where(F.col("n_item_words") < seed).select("n_item_words").distinct()
    shorter = tuple(sorted(r[0] for r in lengths.collect()))
    shared = seed_rows(texts_of(docs), "doc_id", seed, marks, shorter).drop("n_words").join(seeds, "seed")
    pairs = shared.groupBy("row", "item").agg(
        F.first("doc_id").alias("doc_id"), F.first("item_id").alias("item_id"), F.first("n_item_words").alias("n_item_words"), F.collect_list(F.struct("place", "item_place")).alias("places")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered, number, longest = [], [], []
            for group, n in zip(batch.column("places"), batch.column("n_item_words").to_pylist()):
                made = tiles([(x["place"], x["item_place"]) for x in group.as_py()], min(seed, n))
                covered.append(sum(t[2] for t in made))
                number.append(len(made))
                longest.append(max((t[2] for t in made), default=0))
            kept = [batch.column(c) for c in ("row", "doc_id", "item_id", "n_item_words")]
            added = [pa.array(c, pa.int64()) for c in (covered, number, longest)]
            yield pa.record_batch(kept + added, names=["row", "doc_id", "item_id", "n_item_words", "covered_words", "n_tiles", "longest_tile"])

    return pairs.mapInArrow(
        run, "row bigint, doc_id bigint, item_id bigint, n_item_words bigint, covered_words bigint, n_tiles bigint, longest_tile bigint"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED) -> DataFrame:
    """The pairs of a document (``doc_id``, ``text``) and an item (``item_id``, ``text``) with at least this coverage.

    Texts without words and null texts are in no pair; an item of fewer than ``seed`` words is covered as a whole, in one
    run, or not at all. A null doc_id or item_id comes
    back as null; rows that repeat one are looked at on their own and give a row each. Empty tables give no rows, other
    columns are ignored.
    """
    found = coverages(docs, benchmark, seed).withColumn("coverage", F.col("covered_words") / F.col("n_item_words"))
    return found.where(F.col("coverage") >= coverage)


def decontaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` without those whose doc_id is in a contaminated pair; a row without doc_id stays."""
    found = contaminated(docs, benchmark, coverage, seed).select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(found, F.col("doc_id") == F.col("_found"), "left_anti")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and how it was found."""
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("row")
