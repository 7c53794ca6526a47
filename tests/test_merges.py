import random

import pytest

from palaver.operators import merges
from tests.helpers import bag, rows, table

DAY = "2024-01-02"


def daily(spark, name, *rows_):
    """A daily fact: Date is text, AverageDuration a number."""
    df = table(spark, name)
    ddl = ", ".join(
        f"{f.name} " + ("string" if f.name == "Date" else "double" if f.name == "AverageDuration" else f.dataType.simpleString())
        for f in df.schema
    )
    return spark.createDataFrame(list(rows_), ddl)


def test_slice_is_replaced_and_late_rows_are_added(spark):
    old = table(spark, "f_message_content", (DAY, 1, 1, 1, 5, 5, 10), ("2024-01-01", 1, 1, 1, 1, 1, 2), (None, 1, 1, 1, 9, 9, 18))
    new = daily(spark, "f_message_content", (DAY, 1, 1, 1, 2, 1, 3), ("2024-01-01", 1, 1, 1, 1, 0, 1), ("junk", 1, 1, 1, 4, 0, 4))
    assert rows(merges.replace_date_slice(old, new, DAY)) == bag(
        ("2024-01-01", 1, 1, 1, 1, 1, 2), (DAY, 1, 1, 1, 2, 1, 3), ("2024-01-01", 1, 1, 1, 1, 0, 1), (None, 1, 1, 1, 4, 0, 4)
    )
    assert rows(merges.merge_message_content(old, new, DAY)) == bag(
        ("2024-01-01", 1, 1, 1, 2, 1, 3), (DAY, 1, 1, 1, 2, 1, 3), (None, 1, 1, 1, 4, 0, 4)
    )


def test_columns_are_matched_by_name(spark):
    old = table(spark, "f_message_content", ("2024-01-01", 1, 2, 3, 4, 5, 9))
    new = daily(spark, "f_message_content", (DAY, 1, 2, 3, 4, 5, 9)).select(*reversed(old.columns))
    assert rows(merges.merge_message_content(old, new, DAY)) == bag(
        ("2024-01-01", 1, 2, 3, 4, 5, 9), (DAY, 1, 2, 3, 4, 5, 9)
    )


def test_a_rerun_adds_late_rows_again(spark):
    """Only the file's own date is replaced; the one-job backfill is the way to repeat runs."""
    new = daily(spark, "f_message_conversation", (DAY, 1, 1, "1", 1, 1, 2), ("2024-01-01", 1, 1, "1", 1, 1, 2))
    once = merges.merge_message_conversation(table(spark, "f_message_conversation"), new, DAY)
    twice = merges.merge_message_conversation(once, new, DAY)
    assert rows(twice) == bag((DAY, 1, 1, "1", 1, 1, 2), ("2024-01-01", 1, 1, "1", 2, 2, 4))


def test_empty_day_drops_the_slice(spark):
    old = table(spark, "f_message_conversation", (DAY, 1, 1, "1", 1, 1, 2), ("2024-01-01", 1, 1, "1", 1, None, None))
    new = daily(spark, "f_message_conversation")
    assert rows(merges.merge_message_conversation(old, new, DAY)) == bag(("2024-01-01", 1, 1, "1", 1, None, None))


def test_mean_of_means_with_decimal_commas(spark):
    old = table(spark, "f_conversations_and_sm", ("2024-01-01", 1, 1, "1", "10,25", 1, 0, 0), ("2024-01-01", 1, 2, "1", None, 1, 0, 0))
    new = daily(
        spark,
        "f_conversations_and_sm",
        ("2024-01-01", 1, 1, "1", 12.0, 1, 0, 0),
        ("2024-01-01", 1, 1, "1", 2.5, 0, 1, 0),
        (DAY, 1, 1, "1", 0.01, 1, 0, 0),
        (DAY, 1, 1, "1", 0.02, 0, 0, 1),
        (DAY, 1, 1, "2", 12.0, 1, 0, 0),
        (DAY, 1, 9, "2", 12345678.25, 1, 0, 0),
    )
    assert rows(merges.merge_conversations_and_sm(old, new, DAY)) == bag(
        ("2024-01-01", 1, 1, "1", "8,25", 2, 1, 0),
        ("2024-01-01", 1, 2, "1", None, 1, 0, 0),
        (DAY, 1, 1, "1", "0,02", 1, 0, 1),  # 0.015: tie to even
        (DAY, 1, 1, "2", "12,0", 1, 0, 0),
        (DAY, 1, 9, "2", "1,234567825E7", 1, 0, 0),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_merging_touched_dates_only_is_the_full_merge(spark, seed):
    draw = random.Random(seed)

    def random_rows(n, with_null):
        days = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"] + [None] * with_null
        return [
            (draw.choice(days[: draw.choice([2, 5])]), draw.choice([1, None]), draw.randrange(3), str(draw.randrange(1, 3)),
             draw.randrange(10_000) / 100, draw.randrange(9), draw.randrange(9), draw.randrange(9))
            for _ in range(n)
        ]

    name = "f_conversations_and_sm"
    before = daily(spark, name, *random_rows(60, True))
    old = merges.merge_conversations_and_sm(table(spark, name), before, "2024-01-09")
    new = daily(spark, name, *random_rows(6, True))
    full = merges.merge_conversations_and_sm(old, new, DAY)
    assert rows(merges.merge_touched_dates(old, new, DAY, merges.merge_conversations_and_sm)) == rows(full)
