"""Word shingles of whole texts as 64-bit hashes, computed for many texts at once with numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A word's hash is a Karp-Rabin fingerprint of its bytes: the
difference of two prefix sums over a block of the slice, so that no Python code runs per word. The hash is the same in
whichever block a word is. Two different shingles share a hash with probability 2**-64.
"""

import numpy as np


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all bits (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


BASE = 0xD1342543DE82EF95
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Prefix sums and powers take 24 bytes for each byte of a block; only a longer word is a longer block.
BLOCK = 1 << 18
#: A worker keeps the powers to this many; more are made anew each time.
KEPT = 1 << 21
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse modulo 2**64, to the powers 0 to n - 1."""
    if len(_powers[0]) < n:
        made = []
        for base in (BASE, pow(BASE, -1, 2**64)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps, out=steps))
        if n > KEPT:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def words(texts: list[str], separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts, and where each text's words begin in them (with the end of the last).

    ``separators``: which of the 256 bytes are between words; a space must be one.
    """
    raw = [t.encode() for t in texts]
    data = np.frombuffer((b" " + b" ".join(raw) + b" ").lower(), np.uint8)
    begins = np.cumsum([1, *(len(r) + 1 for r in raw)])
    blank = separators[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2] + 1, edges[1::2] + 1
    found = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = starts[first] - 1
        last = max(first + 1, int(np.searchsorted(ends, low + BLOCK, side="right")))
        sums = VALUES[data[low : ends[last - 1]]]
        power, inverse = powers(len(sums))
        sums *= power
        np.add.accumulate(sums, out=sums)
        s, e = starts[first:last] - low, ends[first:last] - low
        found[first:last] = mix((sums[e - 1] - sums[s - 1]) * inverse[s] + np.uint64(0x9E3779B97F4A7C15) * (e - s).astype(np.uint64))
        first = last
    return found, np.searchsorted(starts, begins)


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of every run of ``length`` words, by the run's first word."""
    if len(hashes) < length:
        return np.empty(0, np.uint64)
    total = np.zeros(len(hashes) - length + 1, np.uint64)
    factor = 1
    for i in range(length):
        total += hashes[i : len(hashes) - length + 1 + i] * np.uint64(factor)
        factor = factor * BASE % 2**64
    return mix(total ^ np.uint64(length))


def shingle_sets(texts: list[str], length: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; with fewer words, one for the whole sequence."""
    hashes, begins = words(texts)
    found = runs(hashes, length)
    sets = []
    for start, stop in zip(begins[:-1], begins[1:]):
        n = stop - start
        sets.append(np.unique(found[start : stop - length + 1]) if n >= length else runs(hashes[start:stop], n) if n else np.empty(0, np.uint64))
    return sets
