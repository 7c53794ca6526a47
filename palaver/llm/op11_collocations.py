"""Operator 11: phrase collocation mining by best-first branch and bound.

Phrases grow to the right from their first two words. A prefix of count f bounds the score of itself and of all that
grows from it: what grows has a count a <= f, the part behind the first word occurs at least a times, and
a / (f(first word) + a) rises with a, so no score passes ``2000000 * f / (f(first word) + f)``. All pairs of frequent words
are counted once; the pairs are the frontier, and of each language those with the highest bounds are expanded first.
Expanding counts what grows from a pair up to four words, and the same phrases with one more word in front, so that it
is known which of them a longer phrase stands for. As soon as 2000 surviving phrases of a language score at least the
lowest bound expanded (ties included), no phrase that is left can come before them, and the language is settled. Every
round lowers the bound of the languages that are not, until none is or nothing is left.

A word is known by two 64-bit fingerprints of its language and bytes (128 bits), a phrase by those of its words; texts of
phrases are read from the corpus once they contend. Every pass sums counts inside slices of 1 MB before Spark's own
partial and final sums, so a hot word, pair or language reaches a reducer as one row per task. What goes to every
executor is a bitmap of 2 MB, whatever the number of its keys; it only saves work, exact joins and sums decide.
"""

from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palaver.llm.shingles import VALUES, mix, powers
from palaver.llm.tables import bitmap, in_slices, passes, read
from palaver.workspace import write_once

LEAST = 30
TOP = 2000
LONGEST = 4
UNIT = 2_000_000
#: A candidate goes if a longer phrase has at least so many hundredths of its count.
COVERED = 80
#: Pairs of each language that the first round expands, as a multiple of TOP; each later round expands so many times more.
FIRST, FACTOR = 4, 8
#: Bounds are grouped in steps of so much to find the next threshold.
STEP = 1000
#: Bytes that are fingerprinted at once.
BLOCK = 1 << 18
#: Bytes of text that are counted at once before Spark sums.
SLICE = 1_000_000

BREAKS = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
BETWEEN = BREAKS | np.isin(np.arange(256), [0x20, 0x09])
VALUES_2 = mix(VALUES + np.uint64(0x9E3779B97F4A7C15))
KEYS = [f"{word}{i}" for word in "abcd" for i in (1, 2)]


def keys(first: int, n: int) -> list[str]:
    """The columns of the fingerprints of ``n`` words from word ``first`` on."""
    return KEYS[2 * first : 2 * (first + n)]


class Words:
    """The words of some texts: fingerprints, where each begins and ends in ``data``, and the piece it stands in."""

    def __init__(self, texts: list[str], langs: list[str]):
        raw = [t.encode() for t in texts]
        self.data = np.frombuffer((b"\n" + b"\n".join(raw) + b"\n").lower(), np.uint8)
        between = BETWEEN[self.data]
        edges = np.flatnonzero(between[1:] != between[:-1])
        self.starts, self.ends = edges[::2] + 1, edges[1::2] + 1
        begins = np.searchsorted(self.starts, np.cumsum([1, *(len(r) + 1 for r in raw)]))
        self.piece = np.searchsorted(np.flatnonzero(BREAKS[self.data]), self.starts)
        self.text = np.repeat(np.arange(len(raw)), np.diff(begins))
        seeds = {lang: np.frombuffer(blake2b(lang.encode(), digest_size=16).digest(), np.uint64) for lang in set(langs)}
        of_text = np.array([seeds[lang] for lang in langs], np.uint64).reshape(-1, 2)
        self.prints = [mix(found ^ of_text[self.text, i]).view(np.int64) for i, found in enumerate(self._fingerprints())]

    def __len__(self) -> int:
        return len(self.starts)

    def _fingerprints(self) -> list[np.ndarray]:
        found = [np.empty(len(self), np.uint64) for _ in range(2)]
        at = 0
        while at < len(self):
            low = self.starts[at]
            stop = max(at + 1, int(np.searchsorted(self.ends, low + BLOCK, side="right")))
            starts, ends = self.starts[at:stop] - low, self.ends[at:stop] - low
            power, inverse = powers(int(ends[-1]))
            for values, into in zip((VALUES, VALUES_2), found):
                sums = np.append(np.uint64(0), np.cumsum(values[self.data[low : low + ends[-1]]] * power, dtype=np.uint64))
                into[at:stop] = (sums[ends] - sums[starts]) * inverse[starts] + np.uint64(0x9E3779B97F4A7C15) * (ends - starts).astype(np.uint64)
            at = stop
        return found

    def phrases(self, n: int) -> np.ndarray:
        """Whether a phrase of ``n`` words begins at each word."""
        whole = np.zeros(len(self), bool)
        if len(self) >= n:
            whole[: len(self) - n + 1] = self.piece[n - 1 :] == self.piece[: len(self) - n + 1]
        return whole

    def key(self, n: int) -> np.ndarray:
        """One long for the phrase of ``n`` words at each word, as ``phrase_key`` has it; it is used in bitmaps only."""
        found = self.prints[0].copy()
        for i in range(1, n):
            turned = self.prints[0].view(np.uint64)
            turned = (turned << np.uint64(17 * i)) | (turned >> np.uint64(64 - 17 * i))
            found[: max(0, len(found) - i)] ^= turned.view(np.int64)[i:]
        return found

    def counted(self, at: np.ndarray, n: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """The different phrases of ``n`` words at the places ``at``: their columns and count, and a place of each."""
        columns = [p[at + i] for i in range(n) for p in self.prints]
        order = np.argsort(reduce(lambda x, y: x * 31 + y, columns).view(np.uint64), kind="stable")
        columns = [c[order] for c in columns]
        new = np.ones(len(at), bool)
        if len(at):
            new[1:] = reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
        first = np.flatnonzero(new)
        named = {k: c[first] for k, c in zip(KEYS, columns)} | {k: np.zeros(len(first), np.int64) for k in KEYS[2 * n :]}
        return named | {"a": np.diff(np.append(first, len(at)))}, at[order[first]]

    def spelled(self, places: np.ndarray, n: int) -> pa.Array:
        """The phrases of ``n`` words at the places, joined by single blanks."""
        whole = self.data.tobytes()
        spans = zip(self.starts[places].tolist(), self.ends[places + n - 1].tolist())
        return pa.array([b" ".join(whole[s:e].split()).decode() for s, e in spans], pa.string())


def phrase_key(n: int = LONGEST) -> Column:
    """One long for a phrase; absent words count as 0."""
    turned = [F.expr(f"shiftleft({k}, {17 * i}) | shiftrightunsigned({k}, {64 - 17 * i})") for i, k in enumerate(KEYS[: 2 * n : 2]) if i]
    return reduce(lambda x, y: x.bitwiseXOR(y), turned, F.col(KEYS[0]))


def one_pass(docs: DataFrame, chosen: Callable[[Words], Iterator[tuple[int, np.ndarray]]], longest: int = LONGEST, spell: bool = False) -> DataFrame:
    """Counts of the phrases of up to ``longest`` words that ``chosen`` names by length and place, summed over the corpus."""
    columns = keys(0, longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, SLICE):
            found = Words(part.column("text").to_pylist(), part.column("lang").to_pylist())
            for n, at in chosen(found):
                named, places = found.counted(at, n)
                arrays = {k: pa.array(named[k], pa.int64()) for k in [*columns, "a"]}
                if spell:
                    arrays["phrase"] = found.spelled(places, n)
                yield pa.RecordBatch.from_pydict(arrays)

    schema = [*(f"{k} bigint" for k in [*columns, "a"]), *(["phrase string"] if spell else [])]
    return docs.mapInArrow(run, ", ".join(schema)).groupBy(*columns).agg(F.sum("a").alias("a"), *([F.min("phrase").alias("phrase")] if spell else []))


def word_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Words by language that occur ``least`` times, and the number of all word occurrences of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, SLICE):
            langs = part.column("lang").to_pylist()
            found = Words(part.column("text").to_pylist(), langs)
            columns, places = found.counted(np.arange(len(found)), 1)
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs], np.int64)[found.text]
            totals = np.bincount(number, minlength=len(names))
            lang = pa.array(names, pa.string()).take(pa.array(np.append(np.arange(len(names)), number[places])))
            ones, twos, a = (np.concatenate([np.zeros(len(names), np.int64) if k != "a" else totals, columns[k]]) for k in ("a1", "a2", "a"))
            yield pa.RecordBatch.from_arrays([lang, pa.array(ones), pa.array(twos), pa.array(a)], names=["lang", "a1", "a2", "a"])

    counted = docs.mapInArrow(run, "lang string, a1 bigint, a2 bigint, a bigint").groupBy("lang", "a1", "a2").agg(F.sum("a").alias("a"))
    total = (F.col("a1") == 0) & (F.col("a2") == 0)
    found = write_once(counted.where(total | (F.col("a") >= least)), "words")
    return found.where(~total), found.where(total).select("lang", F.col("a").alias("n"))


def pair_counts(docs: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """All pairs that occur ``least`` times: ``lang``, their words, ``a``, the counts of both words and the bound."""
    frequent = docs.sparkSession.sparkContext.broadcast(bitmap(words, "a1"))

    def chosen(found: Words) -> Iterator[tuple[int, np.ndarray]]:
        known = np.append(passes(frequent.value, found.prints[0]), False)
        yield 2, np.flatnonzero(found.phrases(2) & known[:-1] & known[1:])

    pairs = one_pass(docs, chosen, 2).where(F.col("a") >= least)
    left = words.select("lang", *keys(0, 1), F.col("a").alias("fa"))
    right = words.select(*(F.col(x).alias(y) for x, y in zip(keys(0, 1), keys(1, 1))), F.col("a").alias("fb"))
    found = pairs.join(left, keys(0, 1)).join(right, keys(1, 1))
    return write_once(found.withColumn("bound", score("a", "fa", "a")), "pairs")


def score(a: str, left: str, right: str) -> Column:
    """floor(2000000 * a / (left + right)), exactly."""
    return F.expr(f"(cast({a} AS decimal(20, 0)) * {UNIT}) div ({left} + {right})")


def around(docs: DataFrame, pairs: DataFrame, frontier: DataFrame, least: int) -> DataFrame:
    """Phrases of three and four words that occur ``least`` times, with a frontier pair at their first or second word."""
    context = docs.sparkSession.sparkContext
    frequent = context.broadcast(bitmap(pairs.select(phrase_key(2).alias("key")), "key"))
    expanded = context.broadcast(bitmap(frontier.select(phrase_key(2).alias("key")), "key"))

    def chosen(found: Words) -> Iterator[tuple[int, np.ndarray]]:
        key, pad = found.key(2), np.zeros(2, bool)
        known = np.append(found.phrases(2) & passes(frequent.value, key), pad)
        first = np.append(known[:-2] & passes(expanded.value, key), pad)
        here = (first[:-2] | first[1:-1]) & known[:-2] & known[1:-1]
        yield 3, np.flatnonzero(here)
        yield 4, np.flatnonzero(here & known[2:])

    return write_once(one_pass(docs, chosen).where(F.col("a") >= least), "around")


def renamed(df: DataFrame, first: int, n: int, **others: str) -> DataFrame:
    """Phrases of ``n`` words with their keys named as those of word ``first`` on, and other columns under new names."""
    return df.select(*(F.col(x).alias(y) for x, y in zip(keys(0, n), keys(first, n))), *(F.col(x).alias(y) for x, y in others.items()))


def longer(phrases: DataFrame, n: int) -> DataFrame:
    """For every phrase of ``n`` words inside one of ``phrases`` (of n + 1 words): the highest count of those."""
    ends = [phrases.select(*(F.col(x).alias(y) for x, y in zip(keys(i, n), keys(0, n))), "a") for i in (0, 1)]
    return ends[0].unionAll(ends[1]).groupBy(*keys(0, n)).agg(F.max("a").alias("covering"))


def uncovered(phrases: DataFrame, n: int, by: DataFrame) -> DataFrame:
    """The phrases that no phrase one word longer stands for.

    A phrase of more words that stands for one does so for all between the two as well, as counts only fall.
    """
    found = phrases.join(longer(by, n), keys(0, n), "left")
    return found.where(F.col("covering").isNull() | (100 * F.col("covering") < COVERED * F.col("a"))).drop("covering")


def grown(pairs: DataFrame, frontier: DataFrame, counted: DataFrame) -> DataFrame:
    """The surviving phrases that begin with a frontier pair: ``lang``, keys, ``n_words``, ``a`` and the counts of the parts.

    ``l1`` .. ``l3`` and ``r1`` .. ``r3`` are the counts left and right of the cut after so many words; ``r1`` of a phrase of
    four words is not known yet and null, so ``most`` is the score of those phrases if it is as low as can be.
    """
    threes = counted.where((F.col("c1") != 0) & (F.col("d1") == 0)).select(*keys(0, 3), "a")
    fours = counted.where(F.col("d1") != 0).select(*keys(0, 4), "a")
    two = uncovered(frontier.select("lang", *keys(0, 2), "a", F.col("fa").alias("l1"), F.col("fb").alias("r1")), 2, threes)
    three = threes.join(renamed(frontier, 0, 2, lang="lang", a="l2", fa="l1"), keys(0, 2))
    three = three.join(renamed(pairs, 1, 2, a="r1", fb="r2"), keys(1, 2))
    four = fours.join(renamed(three, 0, 3, lang="lang", a="l3", l1="l1", l2="l2"), keys(0, 3))
    four = four.join(renamed(pairs, 2, 2, a="r2", fb="r3"), keys(2, 2))
    found = [(uncovered(x, n, by) if by else x).withColumn("n_words", F.lit(n)) for n, x, by in ((2, two, None), (3, three, fours), (4, four, None))]
    found = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), found)
    columns = ["lang", "n_words", "a", "l1", "l2", "l3", "r1", "r2", "r3"]
    found = found.withColumns({k: F.coalesce(k, F.lit(0)) for k in KEYS}).select(*KEYS, *columns)
    return found.withColumn("most", F.least(cut(1, "a"), cut(2), cut(3)).getField("score"))


def cut(k: int, unknown: str | None = None) -> Column:
    """The score, cut and counts of the cut after ``k`` words; null for shorter phrases and while a count is not known."""
    right = f"coalesce(r{k}, {unknown})" if unknown else f"r{k}"
    made = F.struct(score("a", f"l{k}", right).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.expr(right).alias("r"))
    return F.when((F.col("n_words") > k) & F.expr(right).isNotNull(), made)


def thresholds(pairs: DataFrame, unsettled: DataFrame, goal: int) -> DataFrame:
    """``lang``, ``low``, ``high``: the highest threshold that at least ``goal`` pairs reach, else 0, and that of the last round.

    A language has no more groups of bounds than the scale has steps, so this is a small table.
    """
    groups = pairs.join(unsettled, "lang", "left_semi").groupBy("lang", F.expr(f"bound div {STEP}").alias("step")).count()
    reaching = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("step")))
    reached = groups.withColumn("reaching", reaching).where(F.col("reaching") >= goal).groupBy("lang").agg((F.max("step") * STEP).alias("low"))
    low = F.greatest(F.lit(0), F.least(F.coalesce("low", F.lit(0)), F.col("high") - STEP))
    return unsettled.join(reached, "lang", "left").select("lang", low.alias("low"), "high")


def resolved(docs: DataFrame, contending: DataFrame) -> DataFrame:
    """The phrases with their texts and scores, both read from the corpus with the counts that are still missing."""
    behind = contending.where("n_words = 4").select(*(F.col(x).alias(y) for x, y in zip(keys(1, 3), keys(0, 3))), *(F.lit(0).cast("bigint").alias(k) for k in keys(3, 1)))
    wanted = write_once(contending.select(*KEYS).unionAll(behind).distinct(), "wanted")
    looked_for = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select(phrase_key().alias("key")), "key"))

    def chosen(found: Words) -> Iterator[tuple[int, np.ndarray]]:
        for n in range(2, LONGEST + 1):
            yield n, np.flatnonzero(found.phrases(n) & passes(looked_for.value, found.key(n)))

    counted = write_once(one_pass(docs, chosen, spell=True).join(wanted, KEYS, "left_semi"), "spelled")
    threes = counted.where((F.col("c1") != 0) & (F.col("d1") == 0))
    found = contending.drop("r1").join(counted.select(*KEYS, "phrase"), KEYS)
    found = found.join(renamed(threes, 1, 3, a="behind"), keys(1, 3), "left")
    found = found.join(contending.select(*KEYS, F.col("r1").alias("before")), KEYS)
    found = found.withColumn("r1", F.when(F.col("n_words") == 4, F.col("behind")).otherwise(F.col("before")))
    return found.select("lang", "phrase", "a", F.least(cut(1), cut(2), cut(3)).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, first: int = FIRST) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    ``docs`` has ``text`` and ``lang``; other columns are ignored. A null text is empty, a null lang is ``und``. Candidates are
    phrases of two to four words of a piece that occur at least ``least`` times; overlapping occurrences and repeated rows
    count each. A language without candidates and an empty table give no rows; a word or a text may be of any length.
    ``first``: how many times ``top`` pairs the first round expands at least; results do not depend on it.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words, totals = word_counts(docs, least)
    pairs = pair_counts(docs, words, least)
    unsettled = pairs.select("lang", F.lit(UNIT).cast("bigint").alias("high")).distinct()
    goal, phrases, known, settled = first * top, [], [], []
    while True:
        between = write_once(thresholds(pairs, unsettled, goal), "thresholds")
        if between.isEmpty():
            break
        frontier = write_once(pairs.join(between, "lang").where("bound >= low AND bound < high").drop("low", "high"), "frontier")
        phrases.append(write_once(grown(pairs, frontier, around(docs, pairs, frontier, least)), "phrases"))
        contending = reduce(DataFrame.unionAll, phrases).join(between, "lang").where("most >= low AND most < high").drop("low", "high", "most")
        known.append(write_once(resolved(docs, write_once(contending, "contending")), "resolved"))
        surviving = reduce(DataFrame.unionAll, known).join(between, "lang").where("score >= low").groupBy("lang").agg(F.count("*").alias("surviving"))
        state = write_once(between.join(surviving, "lang", "left").withColumn("done", (F.col("low") == 0) | (F.coalesce("surviving", F.lit(0)) >= top)), "state")
        settled.append(state.where("done").select("lang", "low"))
        unsettled = state.where("NOT done").select("lang", F.col("low").alias("high"))
        goal *= FACTOR
    if not known:
        return pairs.select("lang", F.lit(1).cast("bigint").alias("rank"), F.lit("").alias("phrase"), "a", F.col("a").alias("l"), F.col("a").alias("r"), F.col("a").alias("n"), F.col("a").alias("score")).limit(0)
    best = reduce(DataFrame.unionAll, known).join(reduce(DataFrame.unionAll, settled), "lang").where("score >= low")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = best.withColumn("rank", rank).where(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language of ``documents``."""
    return collocations(read(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?
-
]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS ws FROM pieces),
placed AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM worded),
spans AS (SELECT lang, k, ws[i : i + k - 1] AS p FROM placed, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k, p, count(*) AS a FROM spans GROUP BY ALL HAVING count(*) >= {LEAST}),
totals AS (SELECT lang, sum(len(ws)) AS n FROM worded GROUP BY lang),
cuts AS (SELECT lang, k, p, a, unnest(range(1, k)) AS c FROM f WHERE k > 1),
scored AS (
  SELECT cuts.lang, cuts.k, cuts.p, cuts.a, x.a AS l, y.a AS r,
    CAST((2000000::HUGEINT * cuts.a) // (x.a + y.a) AS BIGINT) AS score, c
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.p = cuts.p[1 : c] JOIN f y ON y.lang = cuts.lang AND y.p = cuts.p[c + 1 : cuts.k]),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
inner_spans AS (
  SELECT f.lang, p[i : i + m - 1] AS q, a
  FROM f, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i) WHERE m < f.k AND i + m - 1 <= f.k),
covering AS (SELECT lang, q, max(a) AS a FROM inner_spans GROUP BY ALL),
kept AS (
  SELECT lowest.*, array_to_string(p, ' ') AS phrase FROM lowest LEFT JOIN covering ON covering.lang = lowest.lang AND covering.q = lowest.p
  WHERE covering.a IS NULL OR 100 * covering.a < {COVERED} * lowest.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
