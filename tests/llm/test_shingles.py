"""Word hashes in blocks and Arrow batches of bounded size: the same hashes, in memory that does not grow with a slice."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from palaver.llm import op10_jaccard, shingles
from palaver.llm.tables import BATCH_BYTES, small_batches
from tests.llm.cases import prose, table, texts


def test_hashes_are_those_of_the_words_alone():
    r = random.Random(3)
    known = [*(w for w in prose(r, 200) if w.strip()), "é" * 7, "x" * (shingles.BLOCK - 1), "x" * shingles.BLOCK, "y" * (shingles.BLOCK + 1), "z" * 2 * shingles.BLOCK]
    alone = {w: shingles.words([w])[0][0] for w in known}
    assert len(set(alone.values())) == len(set(known))
    for _ in range(3):
        parts = [[r.choice(known[:-4]) for _ in range(r.randrange(40_000))] + r.sample(known, 3) for _ in range(4)]
        made = [r.choice(["", " "]) + r.choice([" ", "\n", "  "]).join(p) + r.choice(["", " \t"]) for p in parts]
        found, begins = shingles.words(["", *made, " "])
        assert found.tolist() == [alone[w] for p in parts for w in p]
        assert begins.tolist() == [0, 0, *np.cumsum([len(p) for p in parts]).tolist(), begins[-1]] and begins[-1] == len(found)


def test_a_long_slice_takes_few_bytes_for_each_of_its_own(monkeypatch):
    monkeypatch.setattr(shingles, "_powers", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    text = "word and another " * 250_000
    tracemalloc.start()
    try:
        shingles.words([text])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 18 * len(text)  # 8 for each sum and 16 for the powers would be more
    assert len(shingles._powers[0]) <= shingles.BLOCK


def test_powers_of_a_long_word_are_not_kept(monkeypatch):
    monkeypatch.setattr(shingles, "_powers", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    monkeypatch.setattr(shingles, "KEPT", 1000)
    power, inverse = shingles.powers(3000)
    assert (power * inverse == 1).all() and power[1] == shingles.BASE and len(shingles._powers[0]) <= 1000
    assert shingles.powers(900)[0].tolist() == power[:900].tolist()


def test_batches_inside_are_small(spark):
    def run(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["bytes"])

    df = spark.range(0, 3000, 1, 1).selectExpr("repeat('abcdefgh', 250) AS text").mapInArrow(run, "bytes bigint")
    before = spark.conf.get(BATCH_BYTES)
    with pytest.raises(ZeroDivisionError), small_batches(spark, "1m"):
        assert max(r.bytes for r in df.collect()) < 1_100_000
        1 / 0
    assert spark.conf.get(BATCH_BYTES) == before
    assert max(r.bytes for r in df.collect()) > 5_000_000


def test_everything_the_join_runs_is_in_small_batches(spark, monkeypatch):
    before, during = spark.conf.get(BATCH_BYTES), []
    write = op10_jaccard.write_once
    monkeypatch.setattr(op10_jaccard, "write_once", lambda df, label: (during.append(df.sparkSession.conf.get(BATCH_BYTES)), write(df, label))[1])
    found = op10_jaccard.jaccard_components(table(spark, texts()))
    assert set(during) == {"4m"} and spark.conf.get(BATCH_BYTES) == before
    assert "ArrowEvalPython" not in (plan := found._jdf.queryExecution().toString()) and "MapInArrow" not in plan
