"""Personal data: base spans against plain regular expressions, added spans on known cases."""

import random
import re

import pytest

from palaver.llm.op5_pii import KINDS, _passes_luhn, fit, personal_data
from tests.llm.cases import table, texts

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(digits) <= 19 and _passes_luhn(digits), "phone": 10 <= len(digits) <= 15}
            if good[kind]:
                found.append((m.start(), order, m.end(), kind))
    return sorted(found)


@pytest.fixture(scope="module")
def model(spark):
    return fit(spark)


def test_base_spans_are_those_of_the_patterns(spark, model):
    r = random.Random(2)
    parts = ["a@b.c", "x.9@", "@", "+1 (017) 555-7713", "+", "1", "4111111111111111", " ", "-", ".", "192.168.1.1", "300.1.1.1.1", "é", "\n", "(", "a", "_", "%", "12"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 12)))) for i in range(1500)]
    rows += [(9000, "1" * 30_000), (9001, "a" * 200_000), (9002, "a@" + ".".join("b" * 9000)), (9003, "+" + "1 " * 9000)]
    by_id = dict(rows)
    found = personal_data(table(spark, rows), model).collect()
    assert len(found) == len(rows)
    for row in found:
        base = [tuple(s) for s in row.base]
        assert base == plain(by_id[row.doc_id])
        assert set(base) <= {tuple(s) for s in row.spans} and row.spans == sorted(row.spans)


def test_candidates_beyond_the_base(spark, model):
    rows = [(1, "two 4283648832092189 4539578763621486 cards"), (2, "call (168) 555-5254 now"), (3, "write jane.12 at mail dot org today"), (4, "number 4283648832092188 is none")]
    found = {r.doc_id: [(s.kind, rows[r.doc_id - 1][1][s.start : s.stop]) for s in r.spans] for r in personal_data(table(spark, rows), model).collect()}
    assert found[1] == [("card", "4283648832092189"), ("card", "4539578763621486")]
    assert found[2] == [("phone", "(168) 555-5254")]
    assert found[4] == []
    assert [k for k, _ in found[3]] in (["email"], [])


def test_texts_without_personal_data_have_none(spark, model):
    found = personal_data(table(spark, texts()), model).collect()
    assert len(found) == len(texts()) and all(r.spans == [] and r.base == [] for r in found)
    assert personal_data(table(spark, []), model).collect() == []
    assert len(model.thresholds) == len(KINDS)
