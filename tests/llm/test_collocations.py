"""Phrase collocations: against counting every phrase, in one round and in many, and against the SQL."""

import random
import re
from collections import Counter

import duckdb
import pytest

from palaver.llm import op11_collocations as op
from palaver.llm.op11_collocations import Words, collocations
from tests.llm.cases import lowered, texts

SF = "/root/testdata/sf0.01"


def plain(rows, least: int, top: int) -> set:
    """Every phrase counted, cut and held against all longer ones, as the definition says."""
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", lowered(text)):
            words = [w.decode() for w in re.split(rb"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 5):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    found = set()
    for lang, f in counts.items():
        scored = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for q in {p[i : i + k] for k in range(2, len(p)) for i in range(len(p) - k + 1)}:
                inside[q] = max(inside[q], a)
        for p, a in candidates.items():
            if 100 * inside[p] < 80 * a:
                score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return found


def rows_of(seed: int) -> list[tuple[str | None, str | None]]:
    r = random.Random(seed)
    words = ["Ab", "ab", "c", "d", "E", "é", "Éa", "f\tg", "h  i", "j.k", "l;", "m\n", "\x0b", "\xa0x", "n,o"]
    passages = [[r.choice(words) for _ in range(r.randint(2, 7))] for _ in range(12)]
    found = [(t, r.choice(["en", "de", None, "und", ""])) for _, t in texts()]
    for _ in range(250):
        parts = [r.choice(passages) if r.random() < 0.5 else [r.choice(words)] for _ in range(r.randint(0, 12))]
        found.append((" ".join(w for p in parts for w in p), r.choice(["en", "en", "en", "de", None])))
    return found


@pytest.mark.parametrize("least, top, first, factor", [(30, 2000, 4, 8), (5, 12, 1, 3)])
def test_the_best_phrases_are_found_whatever_is_expanded_first(spark, monkeypatch, least, top, first, factor):
    monkeypatch.setattr(op, "FACTOR", factor)
    rows = rows_of(least)
    docs = spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, a1 int, phrase string").repartition(3)
    found = collocations(docs, least, top, first).collect()
    expected = plain(rows, least, top)
    assert len(expected) > 20
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_languages_stop_when_their_best_are_settled(spark, monkeypatch):
    expanded = []
    around = op.around
    monkeypatch.setattr(op, "around", lambda docs, pairs, frontier, least: (expanded.append(frontier.count()), around(docs, pairs, frontier, least))[1])
    monkeypatch.setattr(op, "FACTOR", 2)
    rows = rows_of(8)
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = collocations(docs, 8, 3, 1)
    assert {tuple(r) for r in found.collect()} == plain(rows, 8, 3)
    whole = collocations(docs, 8, 10**6, 1).count()
    assert 0 < sum(expanded[:-1]) < expanded[-1] and whole > found.count()


def test_nothing_to_count_gives_no_rows(spark):
    for rows in ([], [(None, None), ("", "en"), ("one two three", "en")]):
        found = collocations(spark.createDataFrame(rows, "text string, lang string"))
        assert found.collect() == [] and found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_words_do_not_depend_on_blocks_or_neighbours(monkeypatch):
    rows = [t or "" for _, t in texts()]
    together = Words(rows, ["en"] * len(rows))
    monkeypatch.setattr(op, "BLOCK", 64)
    parts = Words(rows, ["en"] * len(rows))
    alone = [w for t in rows for w in zip(*Words([t], ["en"]).prints)]
    assert list(zip(*together.prints)) == list(zip(*parts.prints)) == alone
    assert len({*zip(*Words(["a b a"], ["en"]).prints), *zip(*Words(["a"], ["de"]).prints)}) == 3


def test_the_query_equals_its_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    expected = db.sql(op.ORACLE)
    found = op.op11_phrase_collocations(spark, SF).select(*expected.columns).collect()
    assert sorted(map(tuple, found)) == sorted(expected.fetchall())
