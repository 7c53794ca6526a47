from pyspark.sql import functions as F

from palaver.operators import facts
from tests.helpers import activity, bag, contents, events, natcos, rows, table


def content(spark, df, agents=((1, None, "bot"),)):
    types = contents(spark, (3, "text_message", "Text"))
    return rows(facts.daily_message_content(df, natcos(spark), types, table(spark, "d_agent", *agents)))


def test_directions_in_any_case_and_none(spark):
    df = activity(spark, {"direction": "mt"}, {"direction": "MT"}, {"direction": "Mo"}, {"direction": None}, {"direction": "X"})
    assert content(spark, df) == bag(("2024-01-02", 1, 3, 1, 2, 1, 5))


def test_what_no_lookup_knows_keeps_its_row_with_null_keys(spark):
    df = activity(spark, {"type": None}, {"agent_id": "new@h"}, {"run": ("2024-01-02", "tp")}, {"agent_id": None}, {"time": None})
    assert content(spark, df) == bag(
        ("2024-01-02", 1, None, 1, 1, 0, 1),
        ("2024-01-02", 1, 3, None, 1, 0, 1),
        ("2024-01-02", None, 3, 1, 1, 0, 1),
        ("2024-01-02", 1, 3, None, 1, 0, 1),
        (None, 1, 3, 1, 1, 0, 1),
    )


def test_an_agent_name_with_two_rows_fans_out(spark):
    df = activity(spark, {"agent_id": "bot@h1"}, {"agent_id": "bot@h2"})
    assert content(spark, df, ((1, 5, "bot"), (2, 6, "bot"))) == bag(
        ("2024-01-02", 1, 3, 1, 2, 0, 2), ("2024-01-02", 1, 3, 2, 2, 0, 2)
    )


def test_conversation_sums(spark):
    df = events(
        spark,
        {"mo_messages": 1, "mt_messages": None},
        {"mo_messages": 2, "mt_messages": None},
        {"type": "p2a_conversation", "mo_messages": None, "mt_messages": 4},
        {"type": "p2a_conversation", "mo_messages": 3, "mt_messages": 4},
        {"type": "single_message"},
        {"type": None},
    )
    found = facts.daily_message_conversation(df, natcos(spark), table(spark, "d_agent", (1, None, "bot")))
    assert rows(found) == bag(("2024-01-02", 1, 1, "1", 3, None, None), ("2024-01-02", 1, 1, "2", 3, 8, 11))


def test_conversations_and_single_messages(spark):
    df = events(
        spark,
        {"duration": None},
        {"duration": 5},
        {"duration": 5},
        {"type": "p2a_conversation", "duration": 7},
        {"type": "single_message", "duration": 1},
        {"type": "basic_message", "duration": 2},
        {"type": "other", "duration": 3},
        {"type": None, "duration": 4},
    )
    found = facts.daily_conversations_and_sm(df, natcos(spark), table(spark, "d_agent", (1, None, "bot")))
    day = ("2024-01-02", 1, 1)
    assert rows(found) == bag(
        (*day, "1", 3.33, 3, 0, 0),
        (*day, "2", 7.0, 1, 0, 0),
        (*day, "1", 1.0, 0, 1, 0),
        (*day, "1", 2.0, 0, 0, 1),
        (*day, "1", 3.0, 0, 0, 0),
        (*day, "1", 4.0, 0, 0, 0),
    )


def test_average_rounds_half_to_even(spark):
    halves = [{"duration": 1}] + [{"duration": 0}] * 7  # 0.125
    df = events(spark, *halves)
    found = facts.daily_conversations_and_sm(df, natcos(spark), table(spark, "d_agent"))
    assert [r["AverageDuration"] for r in found.collect()] == [0.12]


def test_digests_give_the_same_facts(spark):
    a = activity(spark, {"agent_id": "bot@h1"}, {"agent_id": "bot@h2", "direction": "MO"}, {"type": None}, {"direction": None})
    e = events(spark, {"agent_owner": "a"}, {"agent_owner": "b", "duration": None}, {"mt_messages": None}, {"type": "single_message"})
    dims = natcos(spark), table(spark, "d_agent", (1, None, "bot"))
    types = contents(spark, (3, "text_message", "Text"))
    messages, billed = facts.digest_activity(a), facts.digest_events(e)
    assert rows(facts.message_content(facts.content_tally(messages), dims[0], types, dims[1])) == rows(
        facts.daily_message_content(a, dims[0], types, dims[1])
    )
    assert rows(facts.message_conversation(facts.conversation_tally(billed), *dims)) == rows(
        facts.daily_message_conversation(e, *dims)
    )
    assert rows(facts.conversations_and_sm(facts.single_message_tally(billed), *dims)) == rows(
        facts.daily_conversations_and_sm(e, *dims)
    )
    assert messages.agg(F.sum("MTMO_MessagesByType")).first()[0] == 4
