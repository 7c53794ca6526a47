"""Operator 10: exact Jaccard join on word shingles with PartEnum signatures.

Sets are grouped by size into bands that overlap, so that two sets within the similarity bound are in a common band. In
a band the domain of shingles is divided into ``P`` partitions by hash range. Sets within the bound differ in at most
``k = floor((1 - t) / (1 + t) * (|r| + |s|))`` shingles and so in at most ``k`` partitions. Each set therefore emits
its projections on its ``k + 1`` heaviest partitions (most shingles first, then by hash): the weight of equal
projections is equal, so of the two sets the one with the higher limit has an equal projection that the other emits too.
Preferring heavy partitions keeps passages that many texts share from making signatures on their own.

Sets that are equal are one class from the start. The pairs of a bucket are first held against a lower bound of their
difference, the Hamming distance of parity sketches (each shingle flips one of some bits), and against their sizes. In a
first round a bucket gives only pairs that span what may be linked, a link fewer than members; these are compared
exactly, on the whole sets. A second round takes every other pair within the bounds whose components still differ.
A group of near copies thus costs a comparison per member, not one per pair, and no link that could join two
components is left out. Buckets with the same members count once; a large one is looked at in blocks of fixed size.
"""

from collections.abc import Iterator
from fractions import Fraction
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palaver.llm.components import connected_components
from palaver.llm.shingles import mix, shingle_sets
from palaver.llm.tables import bitmap, in_slices, passes, read, small_batches, texts_of
from palaver.workspace import write_once

SIMILARITY = Fraction(4, 5)
SHINGLE = 5
BAND = 2
BLOCK = 1024
#: Bytes of text whose shingles a task holds at once.
SLICE = 500_000


def class_of(found: np.ndarray) -> int:
    """A set's 64-bit hash, with its size in it."""
    with np.errstate(over="ignore"):
        return int(mix(mix(found).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(found)))[0].view(np.int64))


def bands(size: int, similarity: Fraction = SIMILARITY) -> list[tuple[int, int]]:
    """The bands of a set, each with the most shingles in which the set differs from a partner there.

    Band ``j`` belongs to the pairs whose smaller set has ``BAND**j`` to ``BAND**(j + 1) - 1`` shingles.
    """
    rate = (1 - similarity) / (1 + similarity)
    own = floor(log(size, BAND) + 1e-9)
    found = [(own, floor(rate * (size + size / similarity)))]
    largest_below = BAND**own - 1
    if largest_below >= 1 and largest_below >= size * similarity:
        found.append((own - 1, floor(rate * (size + largest_below))))
    return found


def partitions(band: int, similarity: Fraction = SIMILARITY) -> int:
    """The number of partitions of a band: a fifth more than its largest sets need."""
    rate = (1 - similarity) / (1 + similarity)
    return ceil(rate * (1 + 1 / similarity) * BAND ** (band + 1) * Fraction(6, 5)) + 1


def signatures(found: np.ndarray, similarity: Fraction = SIMILARITY) -> np.ndarray:
    """The signatures of a sorted, distinct, non-empty set of shingle hashes."""
    made = []
    with np.errstate(over="ignore"):
        spread = mix(found + np.uint64(1))
        for band, most in bands(len(found), similarity):
            p = np.uint64(partitions(band, similarity))
            where = ((found >> np.uint64(32)) * p) >> np.uint64(32)
            starts = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            counts = np.diff(np.append(starts, len(found))).astype(np.uint64)
            salt = mix(where[starts] + np.uint64((band + 1) << 40))
            sums = mix(np.add.reduceat(spread, starts) + salt + counts)
            if len(starts) > most + 1:
                weight = (np.minimum(counts, np.uint64(63)) << np.uint64(58)) | (sums >> np.uint64(6))
                sums = sums[np.argpartition(weight, len(weight) - most - 1)[len(weight) - most - 1 :]]
            elif len(starts) < most + 1:  # empty projections are needed too
                empty = np.setdiff1d(np.arange(int(p), dtype=np.uint64), where[starts])
                sums = np.concatenate([sums, mix(mix(empty + np.uint64((band + 1) << 40)) + np.uint64(7))])
            made.append(sums)
    return np.concatenate(made)


def classes(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``class``, the hash of the document's set (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, SLICE):
            sets = shingle_sets(part.column("text").to_pylist(), shingle)
            sizes = pa.array([len(s) for s in sets], pa.int64())
            hashes = pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())
            yield pa.record_batch([part.column("doc_id"), sizes, hashes], names=["doc_id", "n_shingles", "class"])

    return texts_of(docs).mapInArrow(run, "doc_id bigint, n_shingles bigint, class bigint")


def signature_rows(docs: DataFrame, shingle: int = SHINGLE, similarity: Fraction = SIMILARITY) -> DataFrame:
    """``signature``, ``class`` of every set; a task emits those of equal sets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in in_slices(batches, SLICE):
            made, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for found in shingle_sets(part.column("text").to_pylist(), shingle):
                if not len(found) or (name := class_of(found)) in seen:
                    continue
                seen.add(name)
                made.append(signatures(found, similarity))
                owners.append(np.full(len(made[-1]), name, np.int64))
            if len(seen) > 1_000_000:
                seen.clear()
            columns = [pa.array(np.concatenate(made).view(np.int64)), pa.array(np.concatenate(owners))]
            yield pa.record_batch(columns, names=["signature", "class"])

    return texts_of(docs).select("text").mapInArrow(run, "signature bigint, class bigint")


def sketch(found: np.ndarray) -> bytes:
    """The parities of the shingles in as many bits as a power of two, at least twice and at most four times their number.

    Half as many bits are the exclusive or of the two halves, so sketches of sets of different size compare.
    """
    bits = 1 << max(6, len(found).bit_length() + 1)
    at = mix(found + np.uint64(3)) & np.uint64(bits - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def same_length(sketches: list[bytes]) -> np.ndarray:
    """The sketches as rows of 64-bit words, folded to the shortest."""
    words = min(map(len, sketches)) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, words), axis=0) for x in sketches])


def sets_of(docs: DataFrame, wanted: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``class``, ``n``, ``sketch``, ``elements`` (sorted 64-bit hashes) of the wanted classes (``class``, ``doc_id``: a member).

    The documents are not shuffled: a bitmap of fixed size leaves out almost all that are not wanted.
    """
    marks = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            keep = passes(marks.value, ids.fill_null(0).to_numpy(zero_copy_only=False)) | ids.is_null().to_numpy(zero_copy_only=False)
            for part in in_slices(iter([batch.filter(pa.array(keep))]), SLICE):
                sets = [s for s in shingle_sets(part.column("text").to_pylist(), shingle) if len(s)]
                columns = [pa.array([class_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())]
                columns += [pa.array([sketch(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.record_batch(columns, names=["class", "n", "sketch", "elements"])

    found = texts_of(docs).mapInArrow(run, "class bigint, n bigint, sketch binary, elements binary")
    return found.join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"])


def different_buckets(rows: DataFrame) -> DataFrame:
    """The rows (``signature``, ``class``) of one bucket of each set of members."""
    members = rows.groupBy("signature").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("class")).alias("one"), F.bit_xor(F.xxhash64("class", F.lit(1))).alias("two")
    )
    chosen = members.groupBy("size", "one", "two").agg(F.min("signature").alias("signature"))
    return rows.join(chosen.select("signature"), "signature", "left_semi")


def candidates(rows: DataFrame, sets: DataFrame, similarity: Fraction, spanning: bool, block: int = BLOCK) -> DataFrame:
    """Pairs (``a`` < ``b``) of a bucket (``signature``, ``class``, ``component``) within the bounds, in two components.

    ``spanning``: only as many as it takes to span the classes that may be linked.
    """
    in_bucket = Window.partitionBy("signature").orderBy("class")
    rows = rows.withColumns({"part": F.floor((F.row_number().over(in_bucket) - 1) / block), "size": F.count("*").over(Window.partitionBy("signature"))})
    parts = "cast((size - 1) div " + str(block) + " as bigint)"
    rows = rows.withColumn("other", F.explode(F.expr(f"sequence(0L, {parts})")))
    rows = rows.join(sets.select("class", "n", "sketch"), "class")
    member = F.struct("class", "component", "n", "sketch")
    groups = rows.groupBy("signature", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    rate = (1 - similarity) / (1 + similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs: list[np.ndarray] = [np.empty((0, 2), np.int64)]
            for group in batch.column("members"):
                group = group.values
                names, labels, sizes = (group.field(c).to_numpy() for c in ("class", "component", "n"))
                if len(set(labels.tolist())) < 2:
                    continue
                order = np.argsort(names)
                names, labels, sizes = names[order], labels[order].copy(), sizes[order]
                bits = same_length(group.field("sketch").to_pylist())[order]
                for i in range(len(names) - 1):
                    apart = np.bitwise_count(bits[i] ^ bits[i + 1 :]).sum(axis=1, dtype=np.int64)
                    other = sizes[i + 1 :]
                    near = apart * rate.denominator <= rate.numerator * (sizes[i] + other)
                    near &= np.minimum(sizes[i], other) * similarity.denominator >= similarity.numerator * np.maximum(sizes[i], other)
                    near &= labels[i + 1 :] != labels[i]
                    js = np.flatnonzero(near) + i + 1
                    if spanning and len(js):
                        others, firsts = np.unique(labels[js], return_index=True)
                        js = js[firsts]
                        labels[np.isin(labels, others)] = labels[i]
                    pairs.append(np.stack([np.full(len(js), names[i]), names[js]], axis=1))
            made = np.concatenate(pairs)
            yield pa.record_batch([pa.array(made[:, 0]), pa.array(made[:, 1])], names=["a", "b"])

    groups = groups.agg(F.collect_list(member).alias("members")).select("members")
    return groups.mapInArrow(run, "a bigint, b bigint").distinct()


def linked(pairs: DataFrame, sets: DataFrame, similarity: Fraction = SIMILARITY) -> DataFrame:
    """The pairs (``a``, ``b``) of classes whose sets are within the bound, by comparing the whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                r, s = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                if len(r) > len(s):
                    r, s = s, r
                at = np.searchsorted(s, r)
                at[at == len(s)] = 0
                common = int((s[at] == r).sum())
                keep.append(common * similarity.denominator >= similarity.numerator * (len(r) + len(s) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("class").alias("a"), F.col("elements").alias("left"))
    two = sets.select(F.col("class").alias("b"), F.col("elements").alias("right"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a bigint, b bigint")


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, similarity: Fraction = SIMILARITY) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row of ``docs`` (``doc_id``, ``text``).

    Two documents are linked when the Jaccard similarity of their shingle sets is at least ``similarity``; a component
    is named by its smallest doc_id. A text without words (null, empty or blank) has no shingles and is alone. Equal
    rows give equal rows. A null doc_id links like any other, is never a component's name unless all its members are
    null, and comes back as null. An empty table gives no rows; other columns are ignored.
    """
    with small_batches(docs.sparkSession):
        return _components(docs, shingle, similarity)


def _components(docs: DataFrame, shingle: int, similarity: Fraction) -> DataFrame:
    """All that runs Python is written here, so that it is run in the small batches; what is returned joins written tables."""
    known = write_once(classes(docs, shingle), "shingle-classes")
    named = known.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("doc_id"))

    in_bucket = Window.partitionBy("signature").orderBy("class")
    rows = signature_rows(docs, shingle, similarity)
    rows = rows.withColumns({"before": F.lag("class").over(in_bucket), "after": F.lead("class").over(in_bucket)})
    shared = rows.where("before <> class or after <> class").select("signature", "class").distinct()
    buckets = write_once(different_buckets(write_once(shared, "shared")), "buckets")
    wanted = write_once(named.join(buckets.select("class").distinct(), "class"), "wanted")
    sets = write_once(sets_of(docs, wanted, shingle), "sets")

    first = write_once(candidates(buckets.withColumn("component", F.col("class")), sets, similarity, spanning=True), "pairs")
    near = write_once(linked(first, sets, similarity), "near")
    joined = write_once(connected_components(near), "components")

    apart = buckets.join(joined.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    rest = candidates(apart, sets, similarity, spanning=False).join(first, ["a", "b"], "left_anti")
    more = write_once(linked(write_once(rest, "pairs"), sets, similarity), "near")
    if not more.isEmpty():
        stars = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
        joined = write_once(connected_components(stars.unionAll(more)), "components")
    return _named(known, named, joined)


def _named(known: DataFrame, named: DataFrame, joined: DataFrame) -> DataFrame:
    """Each document with the smallest doc_id of its component."""
    labels = named.join(joined.withColumnRenamed("node", "class"), "class", "left")
    labels = labels.select("class", "doc_id", F.coalesce("component", "class").alias("component"))
    least = labels.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labels = labels.join(least, "component").select("class", "component_id")
    found = known.join(labels, "class", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, similarity: Fraction = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component; rows that repeat a doc_id stay together."""
    found = jaccard_components(docs, shingle, similarity)
    others = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_other")).distinct()
    return docs.join(others, F.col("doc_id") == F.col("_other"), "left_anti")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return jaccard_components(read(spark, sf_dir, "documents"))
