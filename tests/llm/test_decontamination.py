"""Decontamination: tiling against plain greedy string tiling over the words themselves."""

import random
import re

from palaver.llm.op1_decontamination import contaminated, coverages, decontaminated, tiles
from tests.llm.cases import prose, table


def words(text):
    return re.findall(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+", (text or "").lower())


def greedy(doc, item, least=5):
    """Greedy string tiling by looking at all pairs of places in every round."""
    marked_d, marked_i, found = set(), set(), []
    while True:
        best = (least - 1, 0, 0)
        for p in range(len(doc)):
            for q in range(len(item)):
                n = 0
                while p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n] and p + n not in marked_d and q + n not in marked_i:
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        if best[0] < least:
            return found
        n, p, q = best
        found.append(n)
        marked_d |= set(range(p, p + n))
        marked_i |= set(range(q, q + n))


def fixture():
    r = random.Random(6)
    items = [(i, " ".join(prose(r, r.randint(15, 40)))) for i in range(8)] + [(90, "too short for it"), (91, None), (92, ""), (None, " ".join(prose(r, 20)))]
    docs = [(i, " ".join(prose(r, 60))) for i in range(6)]
    for i, (_, text) in enumerate(items[:8]):
        w = text.split()
        half = len(w) // 2
        docs.append((20 + i, " ".join(prose(r, 30) + [x.upper() + "!!" for x in w] + prose(r, 30))))
        docs.append((40 + i, " ".join(w[half:] + prose(r, 10) + w[:half])))
        docs.append((60 + i, " ".join(w[:7] + prose(r, 50))))
    docs += [(80, None), (81, ""), (82, "one"), (20, docs[6][1]), (None, items[3][1]), (83, "a a a a a a a a a a " * 3)]
    return docs, items


def test_coverage_is_that_of_greedy_tiling(spark):
    docs, items = fixture()
    bench = spark.createDataFrame([(i, t, "d") for i, t in items], "item_id bigint, text string, doc_id string")
    expected = sorted(
        (str(i), str(j), len(words(b)), sum(g), len(g), max(g)) for i, t in docs for j, b in items if (g := greedy(words(t), words(b)))
    )
    found = coverages(table(spark, docs).repartition(3), bench).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.n_item_words, r.covered_words, r.n_tiles, r.longest_tile) for r in found) == expected
    over = sorted((a, b) for a, b, n, c, *_ in expected if c >= 0.6 * n)
    assert sorted((str(r.doc_id), str(r.item_id)) for r in contaminated(table(spark, docs), bench).collect()) == over
    kept = decontaminated(table(spark, docs), bench)
    gone = {a for a, _ in over} - {"None"}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if str(i) not in gone)
    assert kept.columns == table(spark, docs).columns


def test_empty_tables_give_no_pairs(spark):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id bigint, text string")
    assert contaminated(table(spark, []), bench).collect() == []
    assert contaminated(table(spark, [(1, "one two three four five six")]), bench.limit(0)).collect() == []


def test_tiles_do_not_overlap():
    same = [(p, q) for p in range(6) for q in range(3)]  # one word, over and over
    assert tiles(same, 5) == [(0, 0, 7)]


def test_items_shorter_than_a_seed_are_found_as_a_whole(spark):
    bench = spark.createDataFrame([(1, "Forty-two."), (2, "Paris"), (3, "the blue whale swims"), (4, "one two three four five six"), (5, "...")], "item_id bigint, text string")
    docs = [(1, "It is forty two, FORTY two, always"), (2, "paris"), (3, "the blue whale dives"), (4, "So the blue   whale swims. Paris!"), (5, "two forty"), (6, "x one two three four five"), (7, None)]
    found = sorted((r.doc_id, r.item_id, r.covered_words, r.n_tiles, r.longest_tile, r.coverage) for r in contaminated(table(spark, docs).repartition(3), bench).collect())
    assert found == [(1, 1, 2, 1, 2, 1.0), (2, 2, 1, 1, 1, 1.0), (4, 2, 1, 1, 1, 1.0), (4, 3, 4, 1, 4, 1.0), (6, 4, 5, 1, 5, 5 / 6)]
    assert sorted(r.doc_id for r in decontaminated(table(spark, docs), bench).collect()) == [3, 5, 7]
