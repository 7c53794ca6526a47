"""Toxicity: the rows that are held out, scores that depend on the text alone, and what little training data gives."""

import zlib

import numpy as np
import pytest

from palaver.llm import op12_toxicity as op
from palaver.llm.op12_toxicity import Model, compressed_lengths, dictionary, distances, fit, op12_toxicity, scored, train, typical, words_of
from tests.llm.cases import table, texts

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model():
    plain = ["the weather of the north is mild and the river is wide " * 2, "some of the people went to the market in the morning"]
    bad = ["you rotten scoundrel of the north", "the people are scoundrel folk and rotten", "Rotten! the scoundrel went away"]
    return train(plain * 30 + bad * 20, [0] * 60 + [1] * 60, 0.2)


def test_held_out_documents_are_told_apart(spark):
    found = {r.doc_id: r for r in op12_toxicity(spark, SF).collect()}
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if found[r.doc_id].held_out]
    toxic = np.array([found[r.doc_id].predicted for r in labels if r.toxic])
    plain = np.array([found[r.doc_id].predicted for r in labels if not r.toxic])
    ranks = np.argsort(np.argsort([found[r.doc_id].score for r in labels]))
    marked = np.array([r.toxic for r in labels]) == 1
    auc = (ranks[marked].mean() - ranks[~marked].mean()) / len(labels) + 0.5
    print(f"held out: {len(labels)} labels, AUC {auc:.3f}, {toxic.mean():.3f} of toxic caught, {1 - plain.mean():.3f} of others left alone")
    assert auc > 0.9 and toxic.mean() > 0.6 and plain.mean() < 0.05


def test_scores_do_not_depend_on_neighbours(spark, model):
    rows = texts() + [(90, "a ROTTEN day for the scoundrel"), (91, "a mild day for the people"), (90, "a ROTTEN day for the scoundrel")]
    alone = {t: float(model.scores([t or ""])[0]) for _, t in rows}
    found = scored(table(spark, rows).repartition(3), model).collect()
    assert sorted((str(i), s) for i, s in found) == sorted((str(i), alone[t]) for i, t in rows)
    assert alone["a ROTTEN day for the scoundrel"] > 0.5 > alone["a mild day for the people"] >= alone[None] == alone[""]
    assert scored(table(spark, []), model).collect() == []


def test_a_window_far_behind_counts(model):
    long = "the river is wide " * 30_000
    assert model.scores([long + "rotten scoundrel"])[0] > model.scores([long])[0]
    assert model.scores(["é" * 300_000])[0] <= 0.5


def test_dictionaries_save_bytes_on_their_own_words():
    known = [dictionary(w, s, np.random.default_rng(1)) for w, s in zip(typical(["plain words here"] * 50 + ["a worthless thing"] * 50, [0] * 50 + [1] * 50), op.SIZES)]
    found, begins = distances(["plain worthless", "", "worthless"], tuple(known))
    assert begins.tolist() == [0, 2, 2, 3] and found[0] < 0 < found[1] == found[2]
    framed = [compressed_lengths([b" worthless " + op.FRAME], known[k])[0] for k in (0, 1)]
    assert framed[0] - framed[1] == found[1]


def test_typical_words_are_those_that_other_documents_do_not_explain():
    ordinary, toxic = typical(["the sun", "the moon", "the rain", "The sun"], [0, 0, 1, 1])
    assert set(ordinary) == {b"the"} and not toxic
    _, toxic = typical(["the sun"] * 20 + ["the foe"] * 10, [0] * 20 + [1] * 10)
    assert set(toxic) == {b"foe"}
    assert words_of("A" * 130 + " b") == [b"a" * 64, b"a" * 64, b"aa", b"b"]


def test_labels_of_one_class_or_none_give_the_prior(spark):
    docs = table(spark, [(1, "a b"), (2, None)])
    labels = spark.createDataFrame([(1, 0, 1), (2, 0, None), (7, 0, 1)], "doc_id bigint, quality int, toxic int")
    assert {round(r.score, 3) for r in scored(docs, fit(docs, labels)).collect()} == {0.75}
    assert {r.score for r in scored(docs, fit(docs, labels.limit(0))).collect()} == {0.5}
    assert Model(None, np.zeros(0), 0.0).scores([]).tolist() == []


def test_a_repeated_document_is_learned_from_once(spark, monkeypatch):
    a, b, c = [i for i in range(1, 20) if zlib.crc32(str(i).encode()) % 5][:3]
    docs = table(spark, [(a, f"text {i}") for i in range(60)] + [(b, "b c"), (b, "b c"), (c, None)])
    labels = spark.createDataFrame([(a, 0, 1), (b, 0, 0), (c, 0, 0), (a, 0, 1)], "doc_id bigint, quality int, toxic int")
    seen = []
    monkeypatch.setattr(op, "train", lambda *given: seen.append(given))
    fit(docs.repartition(4), labels)
    fit(docs.repartition(7), labels)
    taken, toxic, _ = seen[0]
    assert seen[0] == seen[1] and taken[0].startswith("text ") and taken[1:] == ["b c", ""] and toxic == [1, 0, 0]
