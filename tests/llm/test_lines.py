"""Line deduplication: against comparing every line with every earlier one."""

import random

from palaver.llm.op2_lines import without_repeated_lines
from tests.llm.cases import table


def within_one(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, near_from=16):
    order = sorted({i: t for i, t in rows}.items(), key=lambda x: (x[0] is not None, x[0] or 0))
    seen, found = [], {}
    for i, t in order:
        stay = []
        for line in (t or "").split("\n"):
            x = line.strip(" ")
            gone = x and any(x == y or min(len(x), len(y)) >= near_from and within_one(x, y) for y in seen)
            if x:
                seen.append(x)
            if not gone:
                stay.append(line)
        found[i] = ((t or "").count("\n") + 1, len(stay), "\n".join(stay))
    return found


def rows(seed=3):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdeé ") for _ in range(n)).strip() for n in (3, 15, 16, 17, 30, 31, 64, 65, 150, 900)]
    found = []
    for i in range(60):
        picked = []
        for _ in range(r.randint(1, 6)):
            line = r.choice(base)
            for _ in range(r.choice([0, 1, 1, 2])):
                at = r.randrange(len(line) + 1)
                line = r.choice([line[:at] + line[at + 1 :], line[:at] + "z" + line[at:], line[:at] + "y" + line[at + 1 :]])
            picked.append(r.choice(["", " "]) + line)
        found.append((i, "\n".join(picked)))
    return found + [(100, None), (101, ""), (102, "\n \n"), (None, "a line of nobody in particular\n\nb"), (103, base[-1] + "\n" + base[-1])]


def test_lines_that_stay_are_those_of_all_comparisons(spark):
    docs = table(spark, rows()).withColumnRenamed("row", "n_kept")
    found = without_repeated_lines(docs.repartition(3))
    assert found.columns == [*docs.columns, "n_lines"]
    assert {r.doc_id: (r.n_lines, r.n_kept, r.text) for r in found.collect()} == brute(rows())


def test_few_blocks_give_the_same_lines(spark):
    found = without_repeated_lines(table(spark, rows(8)), blocks=3).collect()
    assert {r.doc_id: (r.n_lines, r.n_kept, r.text) for r in found} == brute(rows(8))


def test_repeated_rows_keep_the_same_lines_and_an_empty_table_none(spark):
    found = without_repeated_lines(table(spark, [(1, "x\ny"), (1, "x\ny"), (2, "y")])).collect()
    assert sorted((r.doc_id, r.text) for r in found) == [(1, "x\ny"), (1, "x\ny"), (2, "")]
    assert without_repeated_lines(table(spark, [])).collect() == []
