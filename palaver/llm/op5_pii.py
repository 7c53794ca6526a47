"""Operator 5: personal data by boosted trees over overlapping candidates; DataFrame functions only.

Patterns of high recall propose spans of each kind: the four base patterns, and looser ones (numbers of card length that
stand next to each other, phone numbers without a plus, addresses that are written out). Boosted trees look at the
format of a candidate and at what stands around it; a candidate is taken if its log odds reach its kind's threshold,
calibrated on examples that the trees were not grown on. Matches of the base patterns that pass their checks always are.

There are no labelled spans, so the trees learn from examples made by a rule (``examples``): numbers, addresses and look-
alikes in the middle of words, a fixed number of them. Their features come from the same expressions as those of the
documents. The trees become nested ``CASE`` expressions. Nothing is shuffled: each text is looked at in its own row.
"""

import random
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.boosting import Node, boost, log_odds
from palaver.llm.tables import read, texts_of

KINDS = ["email", "ip", "card", "phone"]
CONTEXT = 24
EXAMPLES = 3000
PRECISION = 0.99

# The base patterns, written without backtracking into repeated groups. A match can begin in the middle of a run of its
# first characters only where the match before it ended (\G), or else it would have begun earlier.
LOCAL, HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = (
    ("email", rf"(?<!{LOCAL})[A-Za-z0-9][A-Za-z0-9._%+-]{{1,63}}\x20?[\[(]?(?:@|\x20at\x20|\bat\b)[\])]?\x20?{HOST}{{1,63}}(?:\x20?[\[(]?(?:\.|\x20dot\x20|\bdot\b)[\])]?\x20?{HOST}{{2,63}}){{1,4}}"),
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20.-][0-9]{4}){3}(?![0-9])"),
    ("phone", r"(?<![0-9+])(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[\x20./-]{1,2}[0-9]{2,5}){1,4}(?![0-9])"),
)
#: Words before a span that speak for a kind.
WORDS = {"email": "mail|contact|write", "ip": r"\bip\b|host|server", "card": "card|visa|credit|payment", "phone": "phone|tel|call|mobil|fax"}


def matches(text: Column, pattern: str) -> Column:
    """All matches: ``start``, ``stop`` (code points), ``match``, and up to ``CONTEXT`` characters on both sides."""
    none = F.array().cast("array<struct<start:bigint,stop:bigint,match:string,before:string,after:string>>")
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.arrays_zip(between.alias("gap"), F.concat(found, F.array(F.lit(None).cast("string"))).alias("match"))

    def add(state: Column, step: Column) -> Column:
        gap, match, open_ = step["gap"], step["match"], state["open"]
        start = state["at"] + F.length(gap)
        closed = F.when(
            open_.isNotNull(),
            F.array_append(state["found"], F.struct(open_["start"].alias("start"), open_["stop"].alias("stop"), open_["match"].alias("match"), open_["before"].alias("before"), F.left(gap, F.lit(CONTEXT)).alias("after"))),
        ).otherwise(state["found"])
        stop = start + F.length(match)
        opened = F.when(match.isNotNull(), F.struct(start.alias("start"), stop.alias("stop"), match.alias("match"), F.right(gap, F.lit(CONTEXT)).alias("before")))
        return F.struct(F.coalesce(stop, start).alias("at"), opened.alias("open"), closed.alias("found"))

    nothing = F.lit(None).cast("struct<start:bigint,stop:bigint,match:string,before:string>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), nothing.alias("open"), none.alias("found"))
    return F.aggregate(steps, start, add)["found"]


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check: from the right, every second digit is doubled."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(number, i, F.lit(1)).cast("int")
        twice = (F.length(number) - i) % 2 == 1
        return total + F.when(twice, digit * 2 - F.when(digit > 4, 9).otherwise(0)).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add)
    return F.when(F.length(number) > 0, total % 10 == 0).otherwise(False)


def passes_base(kind: str, match: Column) -> Column:
    n = F.length(digits(match))
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: F.coalesce(part.try_cast("int"), F.lit(999)) <= 255)
    if kind == "card":
        return n.between(14, 19) & F.when(n.between(14, 19), luhn(digits(match))).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def number(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def described(kind: str, m: Column) -> Column:
    """A candidate with its features."""
    match, only = m["match"], digits(m["match"])
    short = F.when(F.length(only) <= 19, only).otherwise(F.lit(""))
    features = [
        F.lit(KINDS.index(kind)).alias("kind_number"),
        F.length(match).alias("length"),
        F.length(only).alias("n_digits"),
        number(luhn(short)).alias("luhn"),
        number(F.startswith(match, F.lit("+"))).alias("plus"),
        number(F.contains(match, F.lit("("))).alias("parens"),
        number(F.contains(match, F.lit("@"))).alias("at_sign"),
        F.regexp_count(match, F.lit(r"[\x20./-]++")).alias("breaks"),
        F.length(F.regexp_extract(match, r"([A-Za-z]*)$", 1)).alias("last_letters"),
        F.length(F.regexp_extract(match, r"^[^0-9]*([0-9]*)", 1)).alias("first_digits"),
        F.length(F.regexp_extract(match, r"([0-9]*)$", 1)).alias("last_digits"),
        number(passes_base("ip", match)).alias("octets"),
        number(m["before"].rlike(r"[\w.+-]$")).alias("joined_before"),
        number(m["after"].rlike(r"^(?:[\w@-]|[.,][0-9])")).alias("joined_after"),
        number(m["after"].rlike(r"^[/-]?[0-9]")).alias("number_after"),
        number(m["before"].rlike(r"\+[0-9]{1,3}[\x20.-]?$")).alias("plus_before"),
    ]
    features += [number(F.lower(m["before"]).rlike(words)).alias(f"says_{name}") for name, words in WORDS.items()]
    return F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["stop"].alias("stop"), match.alias("match"), *features)


FEATURES = (
    "kind_number length n_digits luhn plus parens at_sign breaks last_letters first_digits last_digits octets "
    "joined_before joined_after number_after plus_before says_email says_ip says_card says_phone"
).split()


def with_candidates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` (spans that always count) and ``more`` (described candidates of the looser patterns)."""
    # a text without a digit, an at sign or a written-out one has no candidate
    text = F.when(F.col("text").rlike(r"[0-9@]|\bat\b"), F.col("text")).otherwise(F.lit(""))
    docs = docs.select("doc_id", text.alias("text"))

    def base(kind: str) -> Column:
        good = F.filter(matches(F.col("text"), BASE[kind]), lambda m: passes_base(kind, m["match"]))
        return F.transform(good, lambda m: F.struct(m["start"], F.lit(KINDS.index(kind)).alias("order"), m["stop"], F.lit(kind).alias("kind")))

    def loose(kind: str, pattern: str) -> Column:
        return F.transform(matches(F.col("text"), pattern), lambda m: described(kind, m))

    more = [loose(kind, pattern) for kind, pattern in (*LOOSE, ("phone", BASE["phone"]))]
    found = F.struct(F.concat(*(base(kind) for kind in KINDS)).alias("base"), F.concat(*more).alias("more"))
    return docs.select("doc_id", F.explode(F.array(found)).alias("found")).select("doc_id", "found.base", "found.more")


def examples(seed: int = 11) -> list[tuple[int, str, list[tuple[str, str]]]]:
    """(number, text, [(kind, span)]): texts with personal data and look-alikes, made by a rule."""
    r = random.Random(seed)

    def word() -> str:
        return "".join(r.choice("aeiounrstlmd") for _ in range(r.randint(2, 9)))

    def figures(n: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(n))

    def card(good: bool) -> str:
        body = r.choice("23456") + figures(r.choice([12, 13, 14, 14, 14, 14, 15, 17]))
        total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(body)))
        check = -total % 10
        return body + str(check if good else (check + r.randint(1, 9)) % 10)

    def grouped(x: str) -> str:
        return r.choice([" ", "-"]).join(x[i : i + 4] for i in range(0, len(x), 4)) if len(x) == 16 and r.random() < 0.3 else x

    def phone() -> str:
        area, a, b = figures(3), figures(3), figures(4)
        return r.choice([f"({area}) {a}-{b}", f"{area}-{a}-{b}", f"{area} {a} {b}", f"{area}.{a}.{b}", f"+{r.randint(1, 99)} ({area}) {a}-{b}", f"+{r.randint(1, 99)} {area} {a} {b}"])

    def email() -> str:
        at, dot = r.choice([("@", "."), (" at ", " dot "), ("[at]", "[dot]"), ("(at)", "."), (" at ", ".")])
        return f"{word()}.{r.randint(1, 99)}{at}{word()}{dot}{r.choice(['com', 'org', 'net', 'de', 'example'])}"

    made = []
    for i in range(EXAMPLES):
        good = r.random() < 0.5
        kind = r.choice(["card", "phone", "email", "two", "number", "date", "plain"])
        text, spans = "", []
        if kind == "card":
            text = grouped(card(good))
            spans = [("card", text)] if good else []
        elif kind == "two":
            pair = [card(r.random() < 0.5), card(r.random() < 0.5)]
            text, spans = " ".join(pair), []
            spans = [("card", x) for x in pair if _passes_luhn(x)]
        elif kind == "phone":
            text = phone()
            spans = [("phone", text)]
        elif kind == "email":
            text = email() if good else r.choice([f"{word()} at {word()}", f"{word()} at {word()} dot", f"{word()}@{word()}", f"look at {word()}. {word().title()}", f"{word()} at {word()}.{word().title()}"])
            spans = [("email", text)] if good else []
        elif kind == "number":
            text = r.choice([figures(r.randint(5, 12)), f"{figures(2)}.{figures(2)}.{figures(2)}", f"{figures(3)} {figures(3)}", f"{figures(1)}.{figures(1)}", f"{figures(5)}-{figures(4)}", f"{figures(4)} {figures(4)} {figures(4)} {figures(4)} {figures(4)}", f"{figures(8)}-{figures(4)}-{figures(4)}-{figures(4)}-{figures(12)}", f"{figures(2)} {figures(2)} {figures(2)}"])
        elif kind == "date":
            text = r.choice([f"20{figures(2)}-0{r.randint(1, 9)}-{r.randint(10, 28)}", f"{r.randint(10, 28)}.0{r.randint(1, 9)}.20{figures(2)}", f"20{figures(2)}/{r.randint(10, 12)}/{r.randint(10, 28)}", f"{r.randint(10, 23)}.{figures(2)}", f"19{figures(2)}-20{figures(2)}"])
        says = r.choice(["card", "phone", "call", "mail", "host", "order", "version", "from", "", "", "", "", ""])
        made.append((i, f"{word()} {word()} {says} {text}{r.choice(['', '', ',', '.', '!!', ';'])} {word()} {word()}".replace("  ", " "), spans))
    return made


def _passes_luhn(x: str) -> bool:
    return sum(d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(int(c) for c in reversed(x))) % 10 == 0


@dataclass(frozen=True)
class Model:
    """Trees, and by the number of a kind the log odds from which a candidate is taken."""

    trees: list[Node]
    thresholds: list[float]


def fit(spark: SparkSession) -> Model:
    """Grow the trees on two thirds of the examples and calibrate the thresholds on the rest."""
    made = examples()
    truth = {i: set(spans) for i, _, spans in made}
    table = spark.createDataFrame([(i, text) for i, text, _ in made], "doc_id bigint, text string")
    rows = with_candidates(table).select("doc_id", F.explode("more").alias("c")).select("doc_id", "c.*").collect()
    rows.sort(key=lambda row: (row["doc_id"], row["start"], row["stop"], row["kind"]))
    x = np.array([[row[f] for f in FEATURES] for row in rows], float)
    y = np.array([(row["kind"], row["match"]) in truth[row["doc_id"]] for row in rows], float)
    grown = np.array([row["doc_id"] % 3 > 0 for row in rows])
    trees = boost(x[grown], y[grown], FEATURES)
    odds = sum(tree.values(x[~grown], FEATURES) for tree in trees)
    thresholds = [threshold(odds[x[~grown, 0] == k], y[~grown][x[~grown, 0] == k]) for k in range(len(KINDS))]
    return Model(trees, thresholds)


def threshold(odds: np.ndarray, y: np.ndarray) -> float:
    """The smallest log odds, 0 at least, from which the share of true candidates is ``PRECISION``; else infinity."""
    order = np.argsort(-odds, kind="stable")
    share = np.cumsum(y[order]) / np.arange(1, len(order) + 1)
    last = np.append(odds[order][1:] < odds[order][:-1], True) if len(order) else np.zeros(0, bool)
    good = np.flatnonzero((share >= PRECISION) & last & (odds[order] >= 0))
    return float(odds[order][good[-1]]) if len(good) else float("inf")


def personal_data(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``base``, ``spans`` of every row of ``docs`` (``doc_id``, ``text``).

    Both are arrays of ``start``, ``order``, ``stop`` (code points, exclusive), ``kind``, sorted; ``spans`` holds the base and the
    candidates taken that overlap none of it. A null or empty text has none. Repeated rows come back as often, a null
    doc_id as null, an empty table gives no rows, other columns are ignored.
    """
    limit = F.array(*(F.lit(x) for x in model.thresholds))
    found = with_candidates(texts_of(docs))
    taken = F.filter("more", lambda c: log_odds(model.trees, c) >= F.get(limit, c["kind_number"]))
    free = F.filter(taken, lambda c: ~F.exists("base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))
    added = F.transform(free, lambda c: F.struct(c["start"], c["kind_number"].alias("order"), c["stop"], c["kind"]))
    return found.select("doc_id", F.array_sort("base").alias("base"), F.array_sort(F.array_distinct(F.concat("base", added))).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op5_pii_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document: base counts and digest, and all spans."""
    found = personal_data(read(spark, sf_dir, "documents"), fit(spark))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
