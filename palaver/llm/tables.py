"""What the operators of this subpackage share: reading tables, slices of batches, and a filter of fixed size."""

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BITMAP_BITS = 24
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A whole table of the folder."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only, so that other columns can have any name; a null text is empty."""
    return docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def in_slices(batches: Iterator[pa.RecordBatch], size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        offsets = np.cumsum([0, *pa.compute.binary_length(batch.column("text")).to_pylist()])
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """What is run inside hands Python batches of about ``size``, which is held by both sides; the session's setting comes back.

    The default is 64 MB, of which each side holds a multiple while a batch is filled or read. Rows are the same.
    """
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, size)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """A bitmap of 2**24 bits in which the bit of every key (a bigint) is set: 2 MB, however many keys there are.

    Spark merges the bits of each 64-bit word first, so at most 2**18 rows come to the driver. It lets some other
    keys pass and never drops one of these, so it goes before an exact join and changes no result.
    """
    bit = f"shiftrightunsigned(xxhash64({column}), {64 - BITMAP_BITS})"
    words = keys.selectExpr(f"cast(shiftright({bit}, 6) as int) AS word", f"shiftleft(1L, cast({bit} % 64 as int)) AS mask")
    merged = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    found = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    found[merged["word"].to_numpy()] = merged["mask"].to_numpy()
    return found.view(np.uint64)


def passes(found: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (int64) may be in the bitmap."""
    bit = spark_hash(keys) >> np.uint64(64 - BITMAP_BITS)
    return (found[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def spark_hash(longs: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of one bigint column."""
    # fixed values: the primes of XXH64 and Spark's seed
    p1, p2, p3 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    p4, p5, seed = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5), np.uint64(42)

    def turn(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint64(by)) | (x >> np.uint64(64 - by))

    with np.errstate(over="ignore"):
        x = turn(np.asarray(longs, dtype=np.int64).view(np.uint64) * p2, 31) * p1
        x = turn(x ^ (seed + p5 + np.uint64(8)), 27) * p1 + p4
        x = (x ^ (x >> np.uint64(33))) * p2
        x = (x ^ (x >> np.uint64(29))) * p3
        return x ^ (x >> np.uint64(32))
