"""Quality classifier: accuracy on the rows that are held out, and the same score however rows are grouped."""

import tracemalloc
import zlib

import numpy as np

from palaver.llm import op4_quality
from palaver.llm.op4_quality import BITS, DIMENSIONS, KINDS, Model, accepted, bags, features, fit, op4_quality_classifier, scored, train
from tests.llm.cases import table, texts

SF = "/root/testdata/sf0.01"


def test_held_out_labels_are_predicted(spark):
    found = {r.doc_id: r for r in op4_quality_classifier(spark, SF).collect()}
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if found[r.doc_id].held_out]
    right = sum(found[r.doc_id].predicted == r.quality for r in labels)
    assert right >= 0.95 * len(labels) > 50


def test_scores_do_not_depend_on_neighbours(spark):
    good, bad = ["a plain line of words " * 3, "some more of the same kind"], ["BUY!! NOW!! CHEAP!!", "x x x x x x x"]
    model = train(good + bad, [1, 1, 0, 0], 0.5)
    rows = texts()
    alone = {t: float(model.scores([t or ""])[0]) for _, t in rows}
    found = scored(table(spark, rows).repartition(2), model).collect()
    assert len(found) == len(rows)
    together = {(i, round(s, 6)) for i, s in found}
    assert together == {(i, round(alone[t], 6)) for i, t in rows}
    docs = table(spark, rows)
    kept = accepted(docs, model, 0.5)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t in rows if alone[t] >= 0.5)


def test_labels_of_one_class_or_none_give_the_prior(spark):
    docs = table(spark, [(1, "a b"), (2, None)])
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (7, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert {round(r.score, 3) for r in scored(docs, fit(docs, labels)).collect()} == {0.75}
    assert {r.score for r in scored(docs, fit(docs, labels.limit(0))).collect()} == {0.5}
    assert scored(table(spark, []), Model(train([], [], 0.5).weights, 0.0)).collect() == []


def test_features_stay_inside_words():
    entries = [set(f.tolist()) for f, _ in features(["ab cd", "cd ab"])]
    halves = [[f.tolist()[b[i] : b[i + 1]] for i in range(2)] for f, b in features(["ab cd", "cd ab"])]
    assert all(sorted(x) == sorted(y) for x, y in halves) and len(entries) == 5


def test_a_repeated_document_is_learned_from_once(spark, monkeypatch):
    a, b, c, d = [i for i in range(1, 20) if zlib.crc32(str(i).encode()) % 5][:4]
    docs = table(spark, [(a, f"text {i}") for i in range(60)] + [(b, "b c"), (b, "b c"), (c, "d"), (d, None)])
    labels = spark.createDataFrame([(a, 1, 0), (b, 0, 0), (c, 1, 0), (d, 0, 0), (a, 1, 0)], "doc_id bigint, quality int, toxic int")
    seen = []
    monkeypatch.setattr(op4_quality, "train", lambda *given: seen.append(given))
    fit(docs.repartition(4), labels)
    fit(docs.repartition(7), labels)
    taken, quality, prior = seen[0]
    assert seen[0] == seen[1] and prior == 0.5
    assert taken[0].startswith("text ") and taken[1:] == ["b c", "d", ""] and quality == [1, 0, 1, 0]


def test_training_takes_little_more_than_its_vectors(monkeypatch):
    monkeypatch.setattr(op4_quality, "STEPS", 4)
    given = ["a plain line of words", "BUY!! NOW!!"], [1, 0], 0.5
    train(*given)
    tracemalloc.start()
    try:
        model = train(*given)
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    vectors = 4 * (KINDS << BITS) * DIMENSIONS
    assert peak < 1.25 * vectors and held < 0.1 * vectors  # all drawn at once they take three times as much
    assert model.weights.shape == (KINDS << BITS,)


def test_bags_are_those_of_each_text_at_8_bytes_an_entry():
    given = [t or "" for _, t in texts()] + ["", "x x x x y", "words " * 500]
    entries, shares, begins = bags(given)
    assert entries.nbytes + shares.nbytes == 8 * begins[-1] and len(begins) == len(given) + 1
    for text, start, stop in zip(given, begins, begins[1:]):
        kinds = [np.unique(found, return_counts=True) for found, _ in features([text])]
        assert entries[start:stop].tolist() == [e for once, _ in kinds for e in once.tolist()]
        known = [counts / max(1, counts.sum()) / KINDS for _, counts in kinds]
        assert shares[start:stop].tolist() == np.concatenate(known).astype(np.float32).tolist()
    assert [len(x) for x in bags([""])[:2]] == [0, 0]


def test_the_vectors_drawn_do_not_depend_on_the_block(monkeypatch):
    monkeypatch.setattr(op4_quality, "STEPS", 50)
    given = ["a plain line of words", "BUY!! NOW!!", "some more words"], [1, 0, 1], 0.5
    known = train(*given)
    monkeypatch.setattr(op4_quality, "DRAWN", (KINDS << BITS) + 1)
    assert (train(*given).weights == known.weights).all() and train(*given).bias == known.bias
