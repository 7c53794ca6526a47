"""Exact deduplication: against grouping by whole contents, and with tables so small that they spill again and again."""

import hashlib
from collections import Counter, defaultdict

import pytest

from palaver.llm.op8_exact import OpenTable, exact_groups, grace
from tests.llm.cases import lowered, table, texts


@pytest.mark.parametrize("limit", [1, 400, 48_000_000])
def test_groups_equal_contents_whatever_the_table_holds(spark, limit):
    rows = texts()
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    expected, kept = Counter(), Counter()
    for content, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept[keep] += 1
        expected.update((i, keep, len(ids), hashlib.sha256(content).digest()) for i in ids)
    found = exact_groups(table(spark, rows).repartition(3), limit).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in found) == expected
    assert Counter(r.doc_id for r in found if r.kept) == kept


def test_an_empty_table_gives_no_rows(spark):
    assert exact_groups(table(spark, [])).collect() == []


def test_equal_hashes_do_not_make_contents_equal():
    records = [(7, b"a", 1, 1, 1, 1), (7, b"b", 2, 2, 2, 1), (7, b"a", 3, 3, 3, 1), (7, b"c", 4, 4, 4, 1)]
    found = sorted(x[:4] for part in grace(iter(records), 1) for x in part)
    assert found == [(1, 3, 3, 2), (2, 2, 2, 1), (3, 3, 3, 2), (4, 4, 4, 1)]


def test_a_full_table_still_finds_what_it_has():
    open_table = OpenTable(250)
    assert [open_table.find(i, b"x" * 20 + bytes([i])) for i in range(3)] == [0, 1, None]
    assert open_table.find(1, b"x" * 20 + bytes([1])) == 1
