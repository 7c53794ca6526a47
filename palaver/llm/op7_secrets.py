"""Operator 7: secrets by one combined deterministic automaton.

The rules' regular expressions are compiled together, by subset construction and minimisation, into one transition
array. A text is read once, byte by byte, whatever the number of rules; the array says at each byte whether some rule
has matched. Only in a line where one has (no rule matches across lines) the limits of the matches are worked out, with
the automaton of that rule alone: leftmost, longest, not overlapping.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.automaton import Automaton, compiled
from palaver.llm.tables import in_slices, read, texts_of


def either_case(words: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in words)


VALUE = "[A-Za-z0-9+/_.=-]"
HEAD = f"({either_case('password|passwd|secret|token|api_?key')})[\"']?\\x20*[:=]\\x20*[\"']?"


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds a match, which counts if what follows ``head`` in it has at least ``least`` bytes.

    A pattern that matches very often without counting may ask for ``least`` itself; that changes no match.
    """

    kind: str
    pattern: str
    least: int
    head: str = ""


BASE = (
    Rule("assign", f"{HEAD}{VALUE}+", 12, HEAD),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]{16,}", 16),
)
#: Tokens with a form of their own, found in addition to the base.
ADDED = (
    Rule("github", "gh[opsru]_[A-Za-z0-9]+", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]+", 24),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 40),
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", 27),
)
RULES = BASE + ADDED


class Scanner:
    """All rules as one automaton for the pass over the bytes, and each alone for the limits of its matches."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.all = compiled([r.pattern for r in rules], anywhere=True)
        self.single = [compiled([r.pattern], anywhere=False) for r in rules]
        self.heads = [compiled([r.head], anywhere=False) if r.head else None for r in rules]

    def lines_with_matches(self, data: bytes) -> Iterator[tuple[int, int, set[int]]]:
        """The lines (start, stop) in which rules match, with the numbers of these rules."""
        table, accepting, rules = self.all.table, self.all.accepting, self.all.rules
        state = self.all.start
        found: set[int] = set()
        before = -1
        for at, byte in enumerate(data):
            state = table[state << 8 | byte]
            if state >= accepting and state != before:
                found.update((at, rule) for rule in rules[state])
                before = state
            elif byte == 10:
                before = -1
        by_line: dict[int, tuple[int, set[int]]] = {}
        for at, rule in found:
            start = data.rfind(b"\n", 0, at + 1) + 1
            if start not in by_line:
                stop = data.find(b"\n", at)
                by_line[start] = (len(data) if stop < 0 else stop, set())
            by_line[start][1].add(rule)
        for start, (stop, numbers) in sorted(by_line.items()):
            yield start, stop, numbers

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, stop) of every match that counts, in bytes, by start and then rule."""
        found = []
        for start, stop, numbers in self.lines_with_matches(data):
            for number in numbers:
                rule, at, failed = self.rules[number], start, set()
                while at < stop:
                    end = longest(self.single[number], data, at, stop, failed)
                    if end < 0:
                        at += 1
                        continue
                    head = longest(self.heads[number], data, at, end) if self.heads[number] else at
                    if end - head >= rule.least:
                        found.append((at, number, end))
                    at = end
        return sorted(found)


def longest(automaton: Automaton, data: bytes, at: int, stop: int, failed: set[int] | None = None) -> int:
    """Where the longest match that begins at ``at`` ends, or -1.

    ``failed`` collects, at every sixteenth byte, the states from which no end is reached before ``stop``. Another start that
    comes to one of them gives up there, so each byte is read a bounded number of times, however many starts fail.
    """
    table, accepting, dead, state, end = automaton.table, automaton.accepting, automaton.dead, automaton.start, -1
    passed = []
    for i in range(at, stop):
        state = table[state << 8 | data[i]]
        if state == dead:
            break
        if state >= accepting:
            end = i + 1
            passed.clear()
        elif failed is not None and not i & 15:
            place = i * len(table) + state
            if place in failed:
                break
            passed.append(place)
    if passed:
        failed.update(passed)
    return end


@cache
def scanner() -> Scanner:
    return Scanner()


def in_code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans with limits in code points; the text between the limits is counted once."""
    places, last, chars = {}, 0, 0
    for at in sorted({x for start, _, stop in spans for x in (start, stop)}):
        chars += len(data[last:at].decode())
        places[at] = chars
        last = at
    return [(places[start], rule, places[stop]) for start, rule, stop in spans]


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``spans`` (array of ``kind``, ``start``, ``stop``) of every row of ``docs`` (``doc_id``, ``text``).

    Limits are in code points, ``stop`` is exclusive; spans go by start, then in the order of the rules. A null or empty
    text has none. Repeated rows come back as often, a null doc_id as null, an empty table gives no rows, other
    columns are ignored.
    """
    ready = scanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for part in in_slices(batches):
            rows = []
            for text in part.column("text").to_pylist():
                data = text.encode()
                found = in_code_points(data, ready.spans(data))
                rows.append([{"kind": ready.rules[rule].kind, "start": start, "stop": stop} for start, rule, stop in found])
            yield pa.record_batch([part.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    return texts_of(docs).mapInArrow(run, "doc_id bigint, spans array<struct<kind:string,start:bigint,stop:bigint>>")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document, counted and as text."""
    base = [r.kind for r in BASE]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    found = secrets(read(spark, sf_dir, "documents"))
    counts = [count(kind) for kind in base]
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *counts, F.sha2(joined(of_base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
