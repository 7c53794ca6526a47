"""Operator 4: quality classifier with supervised subword embeddings.

A document's features are its words, the 3- to 5-byte n-grams inside its words (their ends marked by a blank), hashed into
tables of learned vectors, and whether each word is the one before it again. The vectors of each of these five kinds are
averaged over the whole text, and the mean of the five goes to a softmax over two classes.
Vectors and softmax are trained together by stochastic gradient descent in numpy, on a bounded sample of the labelled
rows that are not held out; the sample has as many rows of either class, and the prior of all these labels is put back.

The score is linear in the vectors up to the softmax, so for scoring each vector is multiplied with the class weights
once. What executors get is one number per table entry, 2 MB whatever the size of the input.
"""

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.shingles import SPACES, words
from palaver.llm.tables import in_slices, read, texts_of

BITS = 17
LENGTHS = (3, 4, 5)
KINDS = len(LENGTHS) + 2
DIMENSIONS = 16
#: The sample: at most so many documents of each class, none with more characters.
SAMPLE_ROWS = 1500
SAMPLE_CHARS = 20_000
#: Steps of gradient descent: with fewer documents each is met more often.
STEPS = 15_000
RATE = 0.5
#: Vectors are met in one document of many and in small shares: they learn faster than the softmax.
BOOST = 20
#: Vectors are drawn in blocks of so many: a draw is twice as wide as what is kept of it.
DRAWN = 1 << 14
THRESHOLD = 0.3
FOLDS = 5


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: the table entries of the texts, and where each text's begin among them."""
    hashes, begins = words(texts)
    yield (hashes >> np.uint64(64 - BITS)).astype(np.int64), begins
    again = np.append(False, hashes[1:] == hashes[:-1])[: len(hashes)]
    again[begins[:-1][begins[:-1] < len(hashes)]] = False
    yield again.astype(np.int64) + ((KINDS - 1) << BITS), begins
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b" " + b" ".join(raw) + b"      ", np.uint8)
    blank = SPACES[data]
    data = np.where(blank, np.uint8(32), data).astype(np.uint32)
    ends = np.cumsum([0, *(len(r) + 1 for r in raw)])
    n = len(data) - 5
    inside = ~blank
    for kind, length in enumerate(LENGTHS, 1):
        value = data[:n] * np.uint32(1)
        for i in range(1, length):
            value = value * np.uint32(0x01000193) + data[i : n + i]
        value *= np.uint32(0x9E3779B1)
        valid = inside[1 : n + 1].copy()
        for i in range(2, length - 1):
            valid &= inside[i : n + i]
        at = np.flatnonzero(valid)
        found = (value[at] >> np.uint32(32 - BITS)).astype(np.int64) + (kind << BITS)
        yield found, np.searchsorted(at, ends)


@dataclass
class Model:
    """``weights``: what each table entry adds to the log odds, by ``bias`` and the mean of the means of each kind."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts))
        for found, begins in features(texts):
            sums = np.append(0.0, np.cumsum(self.weights[found], dtype=np.float64))
            total += np.diff(sums[begins]) / np.maximum(np.diff(begins), 1)
        odds = self.bias + total / KINDS
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The table entries of each text, their shares of it, and where each text's begin: 8 bytes for an entry of a text.

    They are kept end to end, for an array for each text would leave the driver's memory in pieces that do not go back.
    """
    entries, shares, begins = array("i"), array("f"), [0]
    for text in texts:
        for found, _ in features([text]):
            once, counts = np.unique(found, return_counts=True)
            entries.frombytes(once.astype(np.int32).tobytes())
            shares.frombytes((counts / max(1, counts.sum()) / KINDS).astype(np.float32).tobytes())
        begins.append(len(entries))
    return np.asarray(entries), np.asarray(shares), begins


def train(texts: list[str], labels: list[int], prior: float, seed: int = 7) -> Model:
    """Vectors and softmax by gradient descent, one document at a time; ``prior``: the share of label 1 among all."""
    if len(set(labels)) < 2:
        return Model(np.zeros(KINDS << BITS, np.float32), float(np.log(prior / (1 - prior))))
    random = np.random.default_rng(seed)
    vectors = np.empty((KINDS << BITS, DIMENSIONS), np.float32)
    for start in range(0, len(vectors), DRAWN):
        part = vectors[start : start + DRAWN]
        part[:] = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, part.shape)
    out, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    all_entries, all_shares, begins = bags(texts)
    epochs = -(-STEPS // len(texts))
    steps = epochs * len(texts)
    for step, i in enumerate(np.concatenate([random.permutation(len(texts)) for _ in range(epochs)]).tolist()):
        entries, shares = all_entries[begins[i] : begins[i + 1]], all_shares[begins[i] : begins[i + 1]].copy()
        mean = shares @ vectors[entries]
        logits = mean @ out + bias
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[labels[i]] -= 1
        rate = np.float32(RATE * (1 - step / steps))
        back = out @ p
        out -= rate * np.outer(mean, p)
        bias -= rate * p
        vectors[entries] -= BOOST * rate * np.outer(shares, back)
    share = np.mean(labels)
    shift = np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return Model(vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0] + shift))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows that are not held out (``labels``: ``doc_id``, ``quality``).

    The sample is chosen by a hash of doc_id, is at most ``SAMPLE_ROWS`` documents of each class and leaves out texts of
    more than ``SAMPLE_CHARS`` characters. Of rows with one doc_id that with the smallest hash of its text is taken, so that
    no more than ``2 * SAMPLE_ROWS`` rows come to the driver. Labels that are neither 0 nor 1 and labels without a document are ignored;
    with labels of one class or none every score is the prior.
    """
    labels = labels.select(F.col("doc_id").cast("bigint"), F.col("quality").cast("int").alias("quality"))
    labels = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    counts = dict(labels.groupBy("quality").count().collect())
    total = sum(counts.values())
    prior = (counts.get(1, 0) + 1) / (total + 2)
    chosen = [labels.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS) for q in (0, 1)]
    sample = texts_of(docs).where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id")
    rows = one_of_each(sample).toArrow().sort_by([(c, "ascending") for c in ("doc_id", "text", "quality")])
    return train(rows["text"].to_pylist(), rows["quality"].to_pylist(), prior)


def one_of_each(sample: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``quality``: of rows with one doc_id and quality that whose text has the smallest hash."""
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return sample.groupBy("doc_id", "quality").agg(least).select("doc_id", "least.text", "quality")


def held_out(doc_id):
    """Whether a document belongs to the fold that nothing is learned from; a null doc_id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` of every row of ``docs`` (``doc_id``, ``text``), from its whole text and nothing else.

    A text without features (null, empty) has the score of the bias. Equal texts have equal scores up to rounding, a null
    doc_id comes back as null, an empty table gives no rows, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        for part in in_slices(batches, 1_000_000):
            scores = known.scores(part.column("text").to_pylist())
            yield pa.record_batch([part.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return texts_of(docs).mapInArrow(run, "doc_id bigint, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``, as they are but for a null text, which is empty."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for part in in_slices(iter([batch.set_column(batch.schema.get_field_index("text"), "text", texts)]), 1_000_000):
                keep = known.scores(part.column("text").to_pylist()) >= threshold
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = read(spark, sf_dir, "documents")
    found = scored(docs, fit(docs, read(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
