import random

from pyspark.sql import functions as F

from palaver.functions.keys import max_id, number_rows
from palaver.functions.rounding import half_even_quotient, hundredths
from tests.helpers import rows


def numbered(df, order, **options):
    return [tuple(r) for r in number_rows(df, order, "id", **options).select(*order, "id").orderBy("id").collect()]


def test_equals_row_number_over_many_ranges(spark, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    setting("spark.sql.shuffle.partitions", "13")
    draw = random.Random(5)
    keys = sorted({f"agent{draw.randrange(10**6):06d}" for _ in range(20_000)})
    df = spark.createDataFrame([(k,) for k in draw.sample(keys, len(keys))], "k string")
    assert numbered(df, ["k"]) == [(k, i) for i, k in enumerate(keys, 1)]


def test_skewed_prefixes_and_several_columns(spark, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pairs = [("hot", f"{i:05d}") for i in range(3000)] + [(f"k{i:03d}", "x") for i in range(500)]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert numbered(df, ["a", "b"], after=100) == [(*p, i) for i, p in enumerate(sorted(pairs), 101)]


def test_null_keys_come_first_and_empty_input_is_empty(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    assert numbered(df, ["k"]) == [(None, 1), ("a", 2), ("b", 3)]
    assert numbered(df.filter("k = 'z'"), ["k"]) == []


def test_numbering_follows_the_highest_old_id(spark):
    old = spark.createDataFrame([(7,), (3,)], "id bigint")
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert numbered(df, ["k"], after=max_id(old, "id")) == [("a", 8), ("b", 9)]
    assert numbered(df, ["k"], after=max_id(old.filter("id > 9"), "id")) == [("a", 1), ("b", 2)]


def test_identical_rows_get_different_ids(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert numbered(df, ["k"]) == [("a", 1), ("a", 2), ("b", 3)]


def test_half_even_quotient_is_exact(spark):
    draw = random.Random(3)
    cases = [(draw.randrange(-10**12, 10**12), draw.randrange(1, 999)) for _ in range(2000)]
    cases += [(5, 2), (7, 2), (-5, 2), (-7, 2), (0, 3), (10**15 + 1, 2)]
    df = spark.createDataFrame(cases, "s bigint, n bigint").select("s", "n", half_even_quotient(F.col("s"), F.col("n")).alias("q"))
    from fractions import Fraction

    for s, n, q in df.collect():
        assert q == round(Fraction(s, n))


def test_half_even_quotient_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None, 0), (None, 2)], "s bigint, n bigint")
    assert set(rows(df.select(half_even_quotient(F.col("s"), F.col("n"))))) == {(None,)}


def test_hundredths(spark):
    df = spark.createDataFrame([(0.29,), (1.15,), (12.0,), (None,)], "v double")
    assert [r[0] for r in df.select(hundredths(F.col("v"))).collect()] == [29, 115, 1200, None]
