"""Operator 12: toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows typical of toxic documents and one on windows of ordinary ones. A
window is a word of the lower-cased text with its blanks, of a long word a piece of 64 bytes; what the toxic dictionary
saves on it against the ordinary one, in bytes, is its distance. For every threshold on that distance, the windows of a document that pass it give two numbers:
whether there is one, and their share. A logistic regression on these numbers calibrates the thresholds. It is fitted on
distances from dictionaries that were trained without the document, the last dictionaries on all of the sample.

zstandard stores inputs that it cannot shorten by some bytes as they are and looks for no match in the last eight bytes, so
for words alone all savings would be lost. Every window is therefore compressed with a few bytes behind it that both
dictionaries end with, which makes each byte saved count. Window, sizes and strategy were chosen by cross-validation inside
the folds that are not held out.
Equal windows of a slice are compressed once. What executors get is both dictionaries and a few weights, about 40 kB.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.op4_quality import held_out
from palaver.llm.tables import in_slices, read, texts_of

#: The sample: at most so many documents of each class, none with more characters.
SAMPLE_ROWS = 1500
SAMPLE_CHARS = 20_000
#: Sizes of the dictionaries of class 0 and 1 in bytes.
SIZES = (32_768, 4_096)
#: Words go into training if this share of a class's documents have them; toxic ones if ordinary documents explain at most half.
SHARE = 0.02
#: Occurrences of words that a dictionary is trained on, and words in a training sample.
BAG, TOGETHER = 300_000, 12
#: A longer word than this many bytes is cut.
LONG = 64
#: What stands behind every window and at the end of both dictionaries.
FRAME = bytes([1, 2, 3, 4, 5, 6, 7, 8, 14, 15, 16, 17])
DISTANCES = np.arange(1, 7)
PARTS = 3
RIDGE = 1.0
THRESHOLD = 0.5
PARAMETERS = {"strategy": zstandard.STRATEGY_BTLAZY2, "min_match": 3, "window_log": 17, "hash_log": 14, "chain_log": 17, "search_log": 6, "target_length": 24}
BARE = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}


def words_of(text: str) -> list[bytes]:
    """The words between ASCII blanks, A-Z lower-cased; long ones in pieces."""
    found = text.encode().lower().split()
    if max(map(len, found), default=0) <= LONG:
        return found
    return [w[i : i + LONG] for w in found for i in range(0, len(w), LONG)]


def windows(text: str) -> list[bytes]:
    """The words of a text, each with its blanks and the frame."""
    end = b" " + FRAME
    return [b" " + w + end for w in words_of(text)]


def typical(texts: list[str], labels: list[int]) -> list[Counter]:
    """For class 0 and 1 the words that go into training, with the number of documents that speak for them."""
    seen, n = [Counter(), Counter()], [labels.count(0), labels.count(1)]
    for text, label in zip(texts, labels):
        seen[label].update(set(words_of(text)))
    ordinary = Counter({w: a for w, a in seen[0].items() if a >= max(2, SHARE * n[0])})
    toxic = Counter()
    for word, a in seen[1].items():
        expected = n[1] * (seen[0][word] + 1) / (n[0] + 2)
        if a >= max(2, SHARE * n[1]) and expected <= a / 2:
            toxic[word] = round(a - expected)
    return [ordinary, toxic]


def dictionary(words: Counter, size: int, random: np.random.Generator) -> bytes:
    """A dictionary trained on the words, each as often as it counts; of the words themselves if they are too few to train."""
    names = sorted(words)
    bag = np.repeat(np.arange(len(names)), [words[w] for w in names]) if names else np.empty(0, np.int64)
    bag = [names[i] for i in random.permutation(bag)[:BAG].tolist()]
    samples = [b" " + b" ".join(bag[i : i + TOGETHER]) + b" " for i in range(0, len(bag), TOGETHER)]
    try:
        content = zstandard.train_dictionary(size, samples, k=24, d=6).as_bytes()
    except (zstandard.ZstdError, ValueError):
        content = b" ".join(sorted(names, key=lambda w: (words[w], w)))[-size:] + b" "
    return content + FRAME


def compressed_lengths(parts: list[bytes], known: bytes) -> np.ndarray:
    """How many bytes each part takes with a dictionary."""
    compressor = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(known), compression_params=zstandard.ZstdCompressionParameters(**PARAMETERS, **BARE))
    sizes = np.array([len(p) for p in parts], np.uint64)
    segments = np.stack([np.cumsum(sizes) - sizes, sizes], axis=1)
    found = compressor.multi_compress_to_buffer(zstandard.BufferWithSegments(b"".join(parts), segments.tobytes()), threads=0)
    return np.array([len(x) for x in found], np.int64)


def distances(texts: list[str], dictionaries: tuple[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distances of all windows of the texts, and where each text's windows begin among them."""
    of_text = [windows(t) for t in texts]
    begins = np.cumsum([0, *map(len, of_text)])
    encoded = pa.array([w for ws in of_text for w in ws], pa.binary()).dictionary_encode()
    different = encoded.dictionary.to_pylist()
    if not different:
        return np.empty(0, np.int64), begins
    saved = compressed_lengths(different, dictionaries[0]) - compressed_lengths(different, dictionaries[1])
    return saved[encoded.indices.to_numpy()], begins


def features(texts: list[str], dictionaries: tuple[bytes, bytes]) -> np.ndarray:
    """A row for each text: for every threshold whether a window passes it, and the logarithm of the share that does."""
    found, begins = distances(texts, dictionaries)
    passed = np.concatenate([np.zeros((1, len(DISTANCES)), np.int64), np.cumsum(found[:, None] >= DISTANCES, axis=0)])
    counts = np.diff(passed[begins], axis=0)
    shares = counts / np.maximum(np.diff(begins), 1)[:, None]
    return np.concatenate([counts > 0, np.log1p(100 * shares)], axis=1)


@dataclass
class Model:
    """Both dictionaries and the logistic regression; without dictionaries every score is that of the bias."""

    dictionaries: tuple[bytes, bytes] | None
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        odds = np.full(len(texts), self.bias)
        if self.dictionaries:
            odds += (features(texts, self.dictionaries) * self.weights).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def calibrated(rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression with a ridge, by Newton's method."""
    x = np.concatenate([rows, np.ones((len(rows), 1))], axis=1)
    penalty = np.diag([RIDGE] * rows.shape[1] + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (labels - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def train(texts: list[str], labels: list[int], prior: float, seed: int = 7) -> Model:
    """Dictionaries and thresholds; ``prior``: the share of label 1 among all."""
    log_prior = float(np.log(prior / (1 - prior)))
    if min(labels.count(0), labels.count(1)) < PARTS:
        return Model(None, np.zeros(0), log_prior)

    def trained(chosen: np.ndarray) -> tuple[bytes, bytes]:
        words = typical([texts[i] for i in chosen], [labels[i] for i in chosen])
        return tuple(dictionary(w, size, np.random.default_rng(seed)) for w, size in zip(words, SIZES))

    y, part = np.array(labels), np.empty(len(labels), np.int64)
    for label in (0, 1):  # each class is dealt out evenly
        at = np.random.default_rng(seed).permutation(np.flatnonzero(y == label))
        part[at] = np.arange(len(at)) % PARTS
    rows = np.zeros((len(texts), 2 * len(DISTANCES)))
    for k in range(PARTS):
        apart = np.flatnonzero(part == k)
        rows[apart] = features([texts[i] for i in apart], trained(np.flatnonzero(part != k)))
    weights, bias = calibrated(rows, y)
    share = y.mean()
    return Model(trained(np.arange(len(texts))), weights, bias + log_prior - float(np.log(share / (1 - share))))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows that are not held out (``labels``: ``doc_id``, ``toxic``).

    The sample is chosen by a hash of doc_id, is at most ``SAMPLE_ROWS`` documents of each class and leaves out texts of more
    than ``SAMPLE_CHARS`` characters. Of rows with one doc_id that with the smallest hash of its text is taken, so that no
    more than ``2 * SAMPLE_ROWS`` rows come to the driver. Labels that are neither 0 nor 1 and labels without a document are
    ignored; with fewer than ``PARTS`` documents of a class every score is the prior.
    """
    labels = labels.select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int").alias("label"))
    labels = labels.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    counts = dict(labels.groupBy("label").count().collect())
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    chosen = [labels.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS) for k in (0, 1)]
    sample = texts_of(docs).where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    rows = sorted(sample.groupBy("doc_id", "label").agg(least).select("doc_id", "least.text", "label").collect())
    return train([r["text"] for r in rows], [r["label"] for r in rows], prior)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` of every row of ``docs`` (``doc_id``, ``text``), from its whole text and nothing else.

    A null, empty or blank text has no windows and so the lowest evidence. Equal texts have equal scores, whatever stands
    beside them; a null doc_id comes back as null, repeated rows come back each, other columns are ignored, an empty table
    gives no rows. A text may be of any length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, 1_000_000):
            scores = model.scores(part.column("text").to_pylist())
            yield pa.record_batch([part.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return texts_of(docs).mapInArrow(run, "doc_id bigint, score double")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = read(spark, sf_dir, "documents")
    found = scored(docs, fit(docs, read(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
