"""Operator 2: removal of repeated lines, near copies included, with a deletion-neighbourhood join; SQL functions only.

Two lines are within edit distance 1 exactly if, for the shorter length ``m``, cutting the same one of ``T`` blocks of
``m`` characters out of both (counted from the left for what is before the block, from the right for what is after it)
can leave equal rests. Each line emits such variants as hashed keys for ``m`` equal to its length and one less, and only
lines that share a key are compared. With ``T = m`` these are the classical variants that lack one character.

The neighbourhood is joined twice. ``T = 2`` costs four keys a line and leaves only lines that have half of another
line; these emit variants of up to ``BLOCKS`` blocks. Copies of a line are one row before any of this. In a bucket
of equal keys every line is first compared with the earliest; only those it does not decide are compared with the
others that are earlier.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palaver.llm.tables import read, texts_of
from palaver.workspace import write_once

NEAR_FROM = 16
BLOCKS = 64
FILTER_BITS = 24

ID = ["id1", "id2"]


def line_rows(docs: DataFrame) -> DataFrame:
    """Every line that is not blank: its document, number, trimmed text, and 128-bit identity."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.select("doc_id", "line_no", F.trim("line").alias("line")).where("line <> ''")
    return lines.withColumns({"id1": F.xxhash64(F.lit(1), "line"), "id2": F.xxhash64(F.lit(2), "line")})


def half_keys(near_from: int) -> Column:
    """The keys of the variants that lack one of two blocks."""

    def keys(m: str) -> str:
        left = f"xxhash64({m}, 0, left(line, {m} div 2))"
        right = f"xxhash64({m}, 1, right(line, {m} div 2))"
        return f"if({m} >= {near_from}, array({left}, {right}), array())"

    return F.expr(f"concat({keys('length(line)')}, {keys('(length(line) - 1)')})")


def block_keys(near_from: int, blocks: int) -> Column:
    """The keys of the variants that lack one of up to ``blocks`` blocks."""

    def keys(m: str) -> str:
        size = f"least({m}, {blocks})"
        before = f"cast(cast(t as bigint) * {m} div {size} as int)"
        after = f"cast({m} - cast(t + 1 as bigint) * {m} div {size} as int)"
        key = f"xxhash64({m}, t, left(line, {before}), right(line, {after}))"
        return f"if({m} >= {near_from}, transform(sequence(0, {size} - 1), t -> {key}), array())"

    return F.expr(f"concat({keys('length(line)')}, {keys('(length(line) - 1)')})")


def in_filter(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose ``id1`` may be among the wanted: a bitmap of fixed size, 2**18 words of 64 bits, is broadcast."""
    bit = f"shiftrightunsigned(id1, {64 - FILTER_BITS})"
    word, mask = f"cast(shiftright({bit}, 6) as int)", f"shiftleft(1L, cast({bit} % 64 as int))"
    words = wanted.selectExpr(f"{word} AS word", f"{mask} AS mask").groupBy("word").agg(F.bit_or("mask").alias("masks"))
    return rows.join(F.broadcast(words), F.expr(f"word = {word} AND (masks & {mask}) <> 0"), "left_semi")


def sharing(keys: DataFrame) -> DataFrame:
    """The ids of the rows (``key``, ids) that have a key in common with another."""
    by_key = Window.partitionBy("key").orderBy(*ID)
    rows = keys.withColumns({"before": F.lag("id1").over(by_key), "after": F.lead("id1").over(by_key)})
    return rows.where("before is not null or after is not null").select(*ID).distinct()


def near_copies(distinct: DataFrame, docs: DataFrame, near_from: int, blocks: int) -> DataFrame:
    """The ids of the lines that have an earlier line within edit distance 1."""
    halves = distinct.select(*ID, F.explode("halves").alias("key"))
    wanted = write_once(sharing(halves), "half-copies")
    texts = in_filter(line_rows(docs).select(*ID, "line"), wanted).join(wanted, ID, "left_semi").dropDuplicates(ID)
    texts = write_once(texts.join(distinct.select(*ID, "first"), ID), "near-lines")

    variants = texts.select(*ID, "first", F.explode(block_keys(near_from, blocks)).alias("key"))
    by_key = Window.partitionBy("key").orderBy("first")
    leader = F.first(F.struct(*ID)).over(by_key)
    rows = variants.withColumns({"leader": leader, "after": F.lead("id1").over(by_key), "place": F.row_number().over(by_key)})
    buckets = write_once(rows.where("place > 1 or after is not null"), "line-buckets")

    def within(pairs: DataFrame) -> DataFrame:
        """The later lines of the pairs (ids, ``id1_e``, ``id2_e``) that are within the bound."""
        one = texts.select(*ID, "line")
        two = texts.select(F.col("id1").alias("id1_e"), F.col("id2").alias("id2_e"), F.col("line").alias("earlier"))
        compared = pairs.distinct().join(one, ID).join(two, ["id1_e", "id2_e"])
        return compared.where(F.levenshtein("line", "earlier", 1) >= 0).select(*ID).distinct()

    stars = buckets.where("place > 1").select(*ID, F.col("leader.id1").alias("id1_e"), F.col("leader.id2").alias("id2_e"))
    decided = write_once(within(stars), "near-copies")
    open_rows = buckets.where("place > 2").join(decided, ID, "left_anti")
    earlier = buckets.where("place > 1").select("key", F.col("first").alias("first_e"), F.col("id1").alias("id1_e"), F.col("id2").alias("id2_e"))
    others = open_rows.join(earlier, "key").where("first_e < first").select(*ID, "id1_e", "id2_e")
    return decided.unionAll(within(others))


def kept_lines(docs: DataFrame, near_from: int = NEAR_FROM, blocks: int = BLOCKS) -> DataFrame:
    """``doc_id``, ``kept``: the numbers of the lines that stay, of every document that keeps a line that is not blank."""
    rows = line_rows(docs).withColumn("halves", half_keys(near_from))
    distinct = rows.groupBy(*ID).agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.first("halves").alias("halves"))
    distinct = write_once(distinct, "lines")
    stay = distinct.join(near_copies(distinct, docs, near_from, blocks), ID, "left_anti")
    return stay.groupBy("first.doc_id").agg(F.sort_array(F.collect_list("first.line_no")).alias("kept"))


def without_repeated_lines(docs: DataFrame, near_from: int = NEAR_FROM, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) with ``text`` lacking the lines that go, and ``n_lines`` and ``n_kept`` added.

    Lines end at \\n and are compared without spaces at their ends. Of equal lines the earliest stays, by doc_id (null
    first) and line number. A line also goes if an earlier line, which itself may have gone, is within edit distance 1
    and both have ``near_from`` characters or more. Blank lines always stay. A null or empty text is one blank line and
    gives an empty text. Rows that repeat a doc_id count as copies of one document and all keep the lines that it keeps.
    An empty table gives no rows. Other columns come back as they are, but for earlier ones named ``n_lines`` or
    ``n_kept``. ``blocks`` does not change the result.
    """
    texts = texts_of(docs)
    kept = kept_lines(texts, near_from, blocks).withColumnRenamed("doc_id", "_kept_id").withColumnRenamed("kept", "_kept")
    names = [c for c in docs.columns if c not in ("text", "n_lines", "n_kept")]
    row = F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row")
    lines = docs.select(row, F.split(F.coalesce("text", F.lit("")), "\n").alias("_lines"))
    joined = lines.join(kept, F.col("_row.doc_id").cast("bigint").eqNullSafe(F.col("_kept_id")), "left")
    blank = "filter(transform(_lines, (x, i) -> if(trim(x) = '', i, -1)), i -> i >= 0)"
    stay = f"array_sort(concat(coalesce(_kept, array()), {blank}))"
    found = joined.select(
        *(F.col(f"_row.`{c}`").alias(c) for c in names),
        F.expr("cast(size(_lines) as bigint)").alias("n_lines"),
        F.expr(f"cast(size({blank}) + coalesce(size(_kept), 0) as bigint)").alias("n_kept"),
        F.expr(f"array_join(transform({stay}, i -> get(_lines, i)), '\\n')").alias("text"),
    )
    return found.select(*docs.columns, *(c for c in ("n_lines", "n_kept") if c not in docs.columns))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines that stay, as a digest."""
    found = without_repeated_lines(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_kept", F.length("text").cast("bigint").alias("n_chars_kept"), F.sha2("text", 256).alias("text_sha256"))


ORACLE = """
WITH raw AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS no
    FROM documents
), lines AS (
    SELECT doc_id, no, line, trim(line, ' ') AS t, row_number() OVER (ORDER BY doc_id NULLS FIRST, no) AS place FROM raw
), firsts AS (
    SELECT t, min(place) AS place, length(t) AS n FROM lines WHERE t <> '' GROUP BY t
), long AS (
    SELECT * FROM firsts WHERE n >= 16
), pairs AS (
    SELECT a.t AS s, b.t AS l, a.place AS ps, b.place AS pl, a.n AS n FROM long a JOIN long b
        ON left(a.t, a.n // 2) = left(b.t, a.n // 2) AND b.n = a.n WHERE a.place < b.place
    UNION SELECT a.t, b.t, a.place, b.place, a.n FROM long a JOIN long b
        ON right(a.t, a.n // 2) = right(b.t, a.n // 2) AND b.n = a.n WHERE a.place < b.place
    UNION SELECT a.t, b.t, a.place, b.place, a.n FROM long a JOIN long b
        ON left(a.t, a.n // 2) = left(b.t, a.n // 2) AND b.n = a.n + 1
    UNION SELECT a.t, b.t, a.place, b.place, a.n FROM long a JOIN long b
        ON right(a.t, a.n // 2) = right(b.t, a.n // 2) AND b.n = a.n + 1
), near AS (
    SELECT DISTINCT greatest(ps, pl) AS place FROM pairs
    WHERE len(list_filter(range(1, n + 2), lambda i:
        CASE WHEN length(l) = n THEN i <= n AND left(s, i - 1) = left(l, i - 1) AND right(s, n - i) = right(l, n - i)
             ELSE left(s, i - 1) = left(l, i - 1) AND right(s, n - i + 1) = right(l, n - i + 1) END)) > 0
), flagged AS (
    SELECT doc_id, no, line,
           t = '' OR place IN (SELECT place FROM firsts WHERE place NOT IN (SELECT place FROM near)) AS stays
    FROM lines
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE stays) AS n_kept,
       length(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE stays), '')) AS n_chars_kept,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE stays), '')) AS text_sha256
FROM flagged GROUP BY doc_id
"""
