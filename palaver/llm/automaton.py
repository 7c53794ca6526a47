"""Regular expressions over bytes as one minimal deterministic automaton in a transition array.

Understood are literals, ``\\xHH`` and other escaped signs, classes, groups, ``|``, ``?``, ``*``, ``+`` and ``{n,}``.
"""

from dataclasses import dataclass
from itertools import count

import numpy as np


class _Builder:
    """Thompson's construction: a state has edges (set of bytes, state) and empty moves."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, pattern: str, start: int) -> int:
        """Add the pattern from ``start`` on and return its last state."""
        self.text, self.at = pattern, 0
        end = self._either(start)
        if self.at != len(pattern):
            raise ValueError(f"{pattern!r} at {self.at}")
        return end

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _either(self, start: int) -> int:
        ends = [self._sequence(start)]
        while self._peek() == "|":
            self.at += 1
            ends.append(self._sequence(start))
        end = self.state()
        for x in ends:
            self.empty[x].append(end)
        return end

    def _sequence(self, at: int) -> int:
        while self._peek() and self._peek() not in "|)":
            begins, first = self.at, self.state()
            self.empty[at].append(first)
            at = self._repeat(begins, first)
        return at

    def _repeat(self, begins: int, first: int) -> int:
        last = self._atom(first)
        sign = self._peek()
        if sign == "{":  # {n,}: the atom again for the first n - 1 times
            close = self.text.index(",}", self.at)
            number, after = int(self.text[self.at + 1 : close]), close + 2
            for _ in range(number - 1):
                self.at, first = begins, self.state()
                self.empty[last].append(first)
                last = self._atom(first)
            self.at, sign = after, "+"
        elif sign and sign in "?*+":
            self.at += 1
        else:
            return last
        end = self.state()
        self.empty[last].append(end)
        if sign in "*+":
            self.empty[last].append(first)
        if sign in "?*":
            self.empty[first].append(end)
        return end

    def _atom(self, start: int) -> int:
        sign = self._peek()
        if sign == "(":
            self.at += 1
            end = self._either(start)
            self.at += 1
            return end
        end = self.state()
        self.edges[start].append((self._class() if sign == "[" else frozenset([self._byte()]), end))
        return end

    def _byte(self) -> int:
        sign = self.text[self.at]
        self.at += 1
        if sign != "\\":
            return ord(sign)
        if self._peek() == "x":
            self.at += 3
            return int(self.text[self.at - 2 : self.at], 16)
        self.at += 1
        return ord(self.text[self.at - 1])

    def _class(self) -> frozenset[int]:
        self.at += 1
        found: set[int] = set()
        while self._peek() != "]":
            low = high = self._byte()
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                high = self._byte()
            found.update(range(low, high + 1))
        self.at += 1
        return frozenset(found)

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for x in self.empty[todo.pop()]:
                if x not in found:
                    found.add(x)
                    todo.append(x)
        return frozenset(found)


@dataclass
class Automaton:
    """``table[256 * state + byte]`` is the next state; states from ``accepting`` on accept; ``dead`` never will (or -1).

    State ``start`` is where reading begins, ``rules[state]`` are the numbers of the rules that accept there.
    """

    table: list[int]
    start: int
    accepting: int
    dead: int
    rules: list[tuple[int, ...]]


def compiled(patterns: list[str], anywhere: bool) -> Automaton:
    """The minimal automaton of all patterns; ``anywhere``: a match may begin at any byte, else at the first.

    Anywhere, the automaton tells that a pattern has matched, as soon as it has; it does not follow that match further.
    """
    nfa = _Builder()
    root = nfa.state()
    ends, owner = {}, {}
    for i, pattern in enumerate(patterns):
        first = nfa.state()
        nfa.empty[root].append(first)
        ends[nfa.add(pattern, first)] = i
        owner |= dict.fromkeys(range(first, len(nfa.edges)), i)
    opening = nfa.closure([root])
    if anywhere:
        nfa.edges[root].append((frozenset(range(256)), root))

    def reached(states: frozenset[int]) -> frozenset[int]:
        whole = nfa.closure(states)
        matched = {ends[s] for s in whole if s in ends} if anywhere else ()
        return frozenset(s for s in whole if s in ends or s in opening or owner.get(s) not in matched) if matched else whole

    # subset construction
    names = {opening: 0}
    todo, rows, accepts = [*names], [], []
    for states in todo:
        moves: list[set[int]] = [set() for _ in range(256)]
        for s in states:
            for signs, to in nfa.edges[s]:
                for b in signs:
                    moves[b].add(to)
        closed: dict[frozenset[int], int] = {}
        row = []
        for to in map(frozenset, moves):
            if to not in closed:
                whole = reached(to)
                if whole not in names:
                    names[whole] = len(names)
                    todo.append(whole)
                closed[to] = names[whole]
            row.append(closed[to])
        rows.append(row)
        accepts.append(tuple(sorted(ends[s] for s in states if s in ends)))

    # minimisation: split the states by what they accept, then by the parts that their moves lead to
    table = np.array(rows)
    kinds = {x: i for i, x in enumerate(sorted(set(accepts)))}
    part = np.array([kinds[x] for x in accepts])
    while True:
        _, new = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)
        new = new.reshape(-1)
        if new.max() == part.max():
            break
        part = new
    states = sorted(range(len(accepts)), key=lambda s: bool(accepts[s]))
    numbers, counter = {}, count()
    for s in states:
        if part[s] not in numbers:
            numbers[part[s]] = next(counter)
    chosen = {numbers[part[s]]: s for s in states}
    final = [[numbers[part[to]] for to in table[chosen[i]]] for i in range(len(chosen))]
    rules = [accepts[chosen[i]] for i in range(len(chosen))]
    dead = next((i for i, row in enumerate(final) if not rules[i] and set(row) == {i}), -1)
    return Automaton([x for row in final for x in row], numbers[part[0]], next((i for i, r in enumerate(rules) if r), len(rules)), dead, rules)
