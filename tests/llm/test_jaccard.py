"""The Jaccard join: its components against all pairs, and the signatures' promise on random sets."""

import random
from fractions import Fraction

import numpy as np
import pytest

from palaver.llm import op10_jaccard
from palaver.llm.components import connected_components
from palaver.llm.op10_jaccard import class_of, jaccard_components, one_of_each, same_length, signatures, sketch
from palaver.llm.shingles import shingle_sets
from palaver.llm.tables import bitmap, passes, spark_hash
from tests.llm.cases import shingles, table, texts


def components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets[:x]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(x)] = find(y)
    names = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            names[find(x)] = min(i, names.get(find(x), i))
    return sorted((str(i), len(s), str(names.get(find(x), i))) for x, (i, s) in enumerate(sets))


def test_components_are_those_of_all_pairs(spark):
    rows = texts()
    found = jaccard_components(table(spark, rows).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == components(rows)


def test_one_of_each_keeps_rows_as_they_are(spark):
    docs = table(spark, texts())
    kept = one_of_each(docs).collect()
    names = {int(i): int(c) for i, _, c in components(texts()) if i != "None"}
    assert {r.doc_id for r in kept if r.doc_id is not None} == {i for i, c in names.items() if i == c}
    assert kept[0].asDict().keys() == set(docs.columns)


def test_an_empty_table_gives_no_rows(spark):
    assert jaccard_components(table(spark, [])).collect() == []


@pytest.mark.parametrize("size", [1, 2, 4, 5, 9, 16, 33, 64, 150, 700])
def test_sets_within_the_bound_share_a_signature_and_pass_the_sketch(size):
    r = np.random.default_rng(size)
    for _ in range(60):
        union = np.unique(r.integers(0, 2**63, size + size // 4 + 1).astype(np.uint64) * np.uint64(2))
        common = int(np.ceil(0.8 * len(union)))
        order = r.permutation(len(union))
        cut = common + r.integers(0, len(union) - common + 1)
        a, b = np.sort(union[order[:cut]]), np.sort(union[np.append(order[:common], order[cut:])])
        assert set(signatures(a).tolist()) & set(signatures(b).tolist())
        bits = same_length([sketch(a), sketch(b)])
        assert int(np.bitwise_count(bits[0] ^ bits[1]).sum()) <= len(np.setxor1d(a, b))


def test_shingle_sets_are_those_of_the_words():
    r = random.Random(4)
    rows = ["".join(r.choice("aB é\n\t\x0b-.") for _ in range(r.randint(0, 80))) for _ in range(300)]
    found = shingle_sets(rows)
    assert [len(s) for s in found] == [len(shingles(t)) for t in rows]
    by_set = {}
    for t, s in zip(rows, found):
        if len(s):
            assert by_set.setdefault(class_of(s), shingles(t)) == shingles(t)


def test_connected_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(-60, 60), r.randrange(-60, 60)) for _ in range(70)] + [(3, 3), (None, 1)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    parent = {x: x for e in edges for x in e if x is not None and None not in e}
    for _ in parent:
        for a, b in edges:
            if a is not None and b is not None:
                parent[a] = parent[b] = min(parent[a], parent[b])
    alone = {x for x in parent if all(a == b or x not in (a, b) for a, b in edges if a is not None)}
    assert found == {x: c for x, c in parent.items() if x not in alone}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_links_found_later_join_the_components_known(spark, monkeypatch):
    r = random.Random(9)
    rows = []
    for group in range(4):
        base = [f"w{r.randrange(10**6)}" for _ in range(60)]
        for i in range(5):
            rows.append((group * 10 + i, " ".join(base[: len(base) - i] + [f"end{group}{j}" for j in range(i)])))
    docs, calls = table(spark, rows), []
    plain = op10_jaccard.connected_components
    monkeypatch.setattr(op10_jaccard, "connected_components", lambda edges: (calls.append({tuple(e) for e in edges.collect()}), plain(edges))[1])
    known = sorted(map(tuple, jaccard_components(docs).collect()))
    assert {c for _, _, c in known} == {0, 10, 20, 30} and len(calls) == 1  # nothing was left to find

    every = op10_jaccard.candidates
    monkeypatch.setattr(op10_jaccard, "candidates", lambda *a, spanning: every(*a, spanning=spanning).where("a % 3 = 0" if spanning else "true"))
    assert sorted(map(tuple, jaccard_components(docs).collect())) == known
    first, second = calls[1:]
    stars = dict(map(tuple, plain(spark.createDataFrame(sorted(first), "a bigint, b bigint")).collect()))
    assert set(stars.items()) < second and not first & (second - set(stars.items()))


def test_bitmap_never_drops_a_key(spark):
    keys = [0, -1, 5, 2**62, -(2**63)]
    frame = spark.createDataFrame([(k,) for k in keys], "k bigint")
    assert passes(bitmap(frame, "k"), np.array(keys)).all()
    assert spark_hash(np.array(keys)).view(np.int64).tolist() == [r[0] for r in frame.selectExpr("xxhash64(k)").collect()]
    assert Fraction(passes(bitmap(frame, "k"), np.arange(10, 10_010)).sum().item(), 10_000) < Fraction(1, 100)
