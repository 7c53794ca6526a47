"""Operator 13: periodic run detection with string synchronising sets.

A run is a stretch of consecutive words with smallest period q that is at least four periods long and cannot be extended.
At every dyadic scale t the synchronising set holds the positions i at which the hash of the t words from i or from i + t is
the smallest of those from i to i + t. Whether a position belongs to the set depends on the 2 t words from it (its context)
alone, and every stretch of t positions meets the set unless it is highly periodic, that is, has a period of at most t / 4
there. Hence a run with a period p between t and 2 t has a position of the set among its first t, and the next position with
the same context is exactly p behind it: such pairs propose the periods. Highly periodic regions are detected apart, from
the runs of the scales up to t / 4; their positions have no part in the set, and those runs supply their small periods.

Proposals are extended to both sides by binary search on prefix fingerprints, all at once, and then held against the
words themselves, so no result rests on a hash. The work is n log n for n words, in numpy, for many documents at a time.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.shingles import mix, powers
from palaver.llm.tables import in_slices, read, texts_of

SHORTEST = 6
PERIODS = 4
SLICE = 1_000_000
FULL = np.uint64(2**64 - 1)


class Stretch:
    """Numbered words, with prefix fingerprints that tell equal stretches by their start and length."""

    def __init__(self, words: np.ndarray):
        self.words = words
        power, self.inverse = powers(len(words) + 1)
        values = mix(words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        self.sums = np.append(np.uint64(0), np.cumsum(values * power[:-1], dtype=np.uint64))

    def prints(self, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        return (self.sums[starts + length] - self.sums[starts]) * self.inverse[starts]

    def every(self, length: int) -> np.ndarray:
        """The fingerprints of all stretches of one length."""
        return (self.sums[length:] - self.sums[: len(self.sums) - length]) * self.inverse[: len(self.sums) - length]

    def ahead(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from ``x`` and from ``y`` > ``x`` on are equal."""
        return self._longest(len(self.words) - y, lambda n: self.prints(x, n) == self.prints(y, n))

    def behind(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words before ``x`` and before ``y`` > ``x`` are equal."""
        return self._longest(x.copy(), lambda n: self.prints(x - n, n) == self.prints(y - n, n))

    @staticmethod
    def _longest(most: np.ndarray, equal) -> np.ndarray:
        low = np.zeros_like(most)
        while (low < most).any():
            middle = (low + most + 1) // 2
            same = equal(middle)
            low, most = np.where(same, middle, low), np.where(same, most, middle - 1)
        return low


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbouring values, ``width`` a power of two plus one."""
    step = 1
    while 2 * step < width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[: len(values) - 1], values[1:]) if step < width else values


def synchronising_set(stretch: Stretch, scale: int, periodic: np.ndarray) -> np.ndarray:
    """Positions whose context of ``2 * scale`` words selects them; ``periodic``: positions of highly periodic regions."""
    hashes = mix(stretch.every(scale))
    hashes[periodic[: len(hashes)]] = FULL
    n = len(hashes) - scale
    if n <= 0:
        return np.empty(0, np.int64)
    least = lowest(hashes, scale + 1)
    return np.flatnonzero((least < FULL) & ((least == hashes[:n]) | (least == hashes[scale:])))


def proposals(stretch: Stretch, scale: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the set and how far behind each the next one with its context is, from ``scale`` to below twice that."""
    chosen = chosen[chosen + 2 * scale <= len(stretch.words)]
    contexts = stretch.prints(chosen, 2 * scale)
    order = np.argsort(contexts, kind="stable")
    contexts, chosen = contexts[order], chosen[order]
    apart = np.diff(chosen)
    found = (contexts[1:] == contexts[:-1]) & (apart >= scale) & (apart < 2 * scale)
    return chosen[:-1][found], apart[found]


def extended(stretch: Stretch, at: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """The longest stretches around the positions with the proposed periods: rows of start, end and period, each once."""
    runs, order = np.empty((0, 3), np.int64), np.lexsort((at, periods))
    at, periods = at[order], periods[order]
    while len(at):
        # the first proposal of each chain of one period stands for those inside its run
        first = np.ones(len(at), bool)
        first[1:] = (periods[1:] != periods[:-1]) | (np.diff(at) > periods[1:])
        x, p = at[first], periods[first]
        starts, ends = x - stretch.behind(x, x + p), x + p + stretch.ahead(x, x + p)
        runs = np.concatenate([runs, np.stack([starts, ends, p], axis=1)])
        chain = np.cumsum(first) - 1
        left = at + periods > ends[chain]
        at, periods = at[left], periods[left]
    runs = np.unique(runs[runs[:, 1] - runs[:, 0] >= PERIODS * runs[:, 2]], axis=0)
    return np.array([exact(stretch.words, *run) for run in runs.tolist()], np.int64).reshape(-1, 3)


def exact(words: np.ndarray, start: int, end: int, period: int) -> tuple[int, int, int]:
    """The run by the words themselves: as given, unless different stretches had one fingerprint."""
    differ = np.flatnonzero(words[start : end - period] != words[start + period : end])
    if len(differ):
        edges = np.concatenate([[-1], differ, [end - period - start]])
        widest = int(np.argmax(np.diff(edges)))
        start, end = start + int(edges[widest]) + 1, start + int(edges[widest + 1]) + period
    return start, end, period


def runs_of(words: np.ndarray, longest: int) -> np.ndarray:
    """All runs of at least ``PERIODS`` periods in numbered words: rows of start, end and smallest period."""
    found, scale = np.empty((0, 3), np.int64), 1
    stretch = Stretch(words)
    while PERIODS * scale <= longest:
        regions = found[(found[:, 2] * 4 <= scale) & (found[:, 1] - found[:, 0] >= scale)]
        marks = np.zeros(len(words) + 1, np.int64)
        np.add.at(marks, regions[:, 0], 1)
        np.add.at(marks, regions[:, 1] - scale + 1, -1)
        periodic = np.cumsum(marks)[:-1] > 0
        at, periods = proposals(stretch, scale, synchronising_set(stretch, scale, periodic))
        more = extended(stretch, at, periods)
        found = np.concatenate([found, more[more[:, 1] - more[:, 0] >= PERIODS * more[:, 2]]])
        scale *= 2
    # one stretch with several periods has the smallest
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    same = np.zeros(len(found), bool)
    same[1:] = (found[1:, :2] == found[:-1, :2]).all(axis=1)
    return found[~same]


def in_documents(texts: list[str]) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """For each text its runs (start, length, period), its words, and which of them are kept."""
    split = [t.encode().split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    order = np.argsort(-sizes, kind="stable")
    begins = np.zeros(len(split) + 1, np.int64)
    flat, offset = [], 0
    for i in order.tolist():  # between two texts stands a word of its own, so no run passes from one to the next
        begins[i] = offset
        flat += split[i]
        flat.append(b" %d" % i)
        offset += len(split[i]) + 1
    numbers = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    found = runs_of(numbers, int(sizes.max(initial=0)))
    found = found[found[:, 1] - found[:, 0] >= SHORTEST]
    dropped = np.zeros(len(flat) + 1, np.int64)
    np.add.at(dropped, found[:, 0] + found[:, 2], 1)
    np.add.at(dropped, found[:, 1], -1)
    kept = np.cumsum(dropped) == 0
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    for i, words in enumerate(split):
        low, high = np.searchsorted(found[:, 0], [begins[i], begins[i] + sizes[i]])
        own = found[low:high]
        yield np.stack([own[:, 0] - begins[i], own[:, 1] - own[:, 0], own[:, 2]], axis=1), words, kept[begins[i] : begins[i] + sizes[i]]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``): ``runs`` by start and period, and the ``collapsed`` text.

    Words are what stands between ASCII blanks, by their bytes. ``runs`` are structs of start (word number), length and
    period, of at least six words and four periods; ``collapsed`` has the words that no run contains behind its first
    period, joined by one blank. A null, empty or blank text has no runs and is empty, a null doc_id comes back as null,
    repeated rows come back each, other columns are ignored, an empty table gives no rows. A text is worked on as a whole,
    with some 300 bytes of memory for each of its words.
    """
    schema = "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, SLICE):
            runs, collapsed = [], []
            for found, words, kept in in_documents(part.column("text").to_pylist()):
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found.tolist()])
                collapsed.append(b" ".join(words if kept.all() else [w for w, k in zip(words, kept.tolist()) if k]).decode())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(runs, kind), pa.array(collapsed, pa.string())], names=["doc_id", "runs", "collapsed"])

    return texts_of(docs).mapInArrow(run, schema)


def with_repeats(docs: DataFrame) -> DataFrame:
    """The documents of the contract: in about one of ten, words from a certain one on are repeated with a certain period."""
    spaced = texts_of(docs).withColumn("h", F.crc32(F.col("doc_id").cast("string"))).withColumn("g", F.floor(F.col("h") / 10))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = spaced.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n = F.size("words")
    at = (F.col("g") % F.greatest(n, F.lit(1))).cast("int")
    chosen = chosen.withColumn("at", F.when(n > 0, at)).withColumn("period", F.expr("cast(1 + (size(words) - at) div (3 + g % 8) AS int)"))
    repeated = F.expr("slice(flatten(array_repeat(slice(words, at + 1, period), cast(ceil((size(words) - at) / period) AS int))), 1, size(words) - at)")
    text = F.when(F.col("at").isNotNull(), F.concat_ws(" ", F.concat(F.expr("slice(words, 1, at)"), repeated))).otherwise(F.col("text"))
    return chosen.select("doc_id", text.alias("text"))


def best(field: str) -> Column:
    """A field of the run with the greatest length by period; the first of those that tie."""
    better = "b.length IS NULL OR r.length * b.period > b.length * r.period"
    none = "cast(null AS struct<start: bigint, length: bigint, period: bigint>)"
    return F.expr(f"aggregate(runs, {none}, (b, r) -> CASE WHEN {better} THEN r ELSE b END).{field}")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, with the repeats that the contract puts into some of them."""
    found = periodic_runs(with_repeats(read(spark, sf_dir, "documents")))
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    found = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), *(best(k).alias(k) for k in ("start", "length", "period")), listed.alias("listed"), "collapsed")
    milli = F.expr("1000 * length div period").alias("exponent_milli")
    return found.select("doc_id", "n_runs", "start", "length", "period", milli, F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
