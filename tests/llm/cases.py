"""Small tables with every case that an operator has to define, and plain Python versions of the operators."""

import random

from pyspark.sql import DataFrame, SparkSession


def prose(r: random.Random, n: int) -> list[str]:
    return [r.choice("the of and to in").lower() if r.random() < 0.2 else "".join(r.choice("aeinorstlh") for _ in range(r.randint(2, 8))) for _ in range(n)]


def texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Null, empty, blank, short and long texts; copies, near copies, repeated rows and a null doc_id."""
    r = random.Random(seed)
    base = prose(r, 120)
    found: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (3, " \n\t "), (4, "One."), (5, "one."), (6, "a b c d"), (7, "A B C D")]
    found += [(10 + i, " ".join(prose(r, r.randint(1, 60)))) for i in range(12)]
    for i in range(12):  # near copies of one text, of which some are within the bounds of each other
        words = list(base)
        for _ in range(i // 2):
            words[r.randrange(len(words))] = "x" + str(r.randrange(1000))
        found.append((40 + i, "\n".join(" ".join(words[k : k + 20]) for k in range(0, 120, 20))))
    found += [(60, " ".join(base)), (61, " ".join(base).upper()), (62, " ".join(base) + " end")]
    found += [(70, "word " * 30_000), (71, "a" * 50_000), (72, "é" * 3000 + "\n" + "é" * 3000)]
    found += [(60, " ".join(base)), (None, "nobody knows whose text this is at all"), (None, "nobody knows whose text this is at all")]
    return found


def table(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    """The rows with further columns whose names operators could use themselves."""
    full = [(i, t, "x", 1.5, "y") for i, t in rows]
    return spark.createDataFrame(full, "doc_id bigint, text string, class string, row double, seed string")


def lowered(text: str | None) -> bytes:
    return (text or "").encode().lower()


def shingles(text: str | None) -> frozenset:
    w = lowered(text).split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
