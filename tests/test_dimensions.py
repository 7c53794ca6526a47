import pytest

from palaver.operators import dimensions as d
from tests.helpers import activity, bag, contents, events, rows, table


def test_owner_ids_follow_names(spark):
    df = events(spark, {"agent_owner": "zed@x"}, {"agent_owner": "acme@y"}, {"agent_owner": "acme@z"}, {"agent_owner": None})
    assert rows(d.daily_agent_owners(df)) == bag((1, None), (2, "acme"), (3, "zed"))


def test_agent_without_separator_is_its_own_name(spark):
    a, e = activity(spark, {"agent_id": "plain"}), events(spark)
    owners = d.daily_agent_owners(e)
    assert rows(d.daily_agents(a, e, owners)) == bag((1, None, "plain"))


def test_agents_of_both_feeds_with_several_owners_and_hosts(spark):
    a = activity(spark, {"agent_id": "one@h1"}, {"agent_id": "one@h2"}, {"agent_id": None})
    e = events(spark, {"agent_id": "two@h", "agent_owner": "acme@x"}, {"agent_id": "two@h", "agent_owner": "zed@x"})
    owners = table(spark, "d_agent_owner", (1, "acme"), (2, "zed"))
    found = rows(d.daily_agents(a, e, owners))
    assert found == bag((1, None, None), (2, None, "one"), (3, None, "one"), (4, 1, "two"), (4, 2, "two"))


def test_two_owners_with_one_name_stay_two_rows(spark):
    e = events(spark, {"agent_owner": "acme@x"}, {"agent_owner": "acme@y"})
    agents = d.daily_agents(activity(spark), e, d.daily_agent_owners(e))
    assert rows(agents) == bag((1, 1, "bot"), (1, 1, "bot"))
    assert rows(d.merge_agents(table(spark, "d_agent"), agents)) == bag((1, 1, "bot"), (2, 1, "bot"))


SEEDS = [(4, "text_message", "Text"), (9, "spam", None), (2, "unseen", "Unseen")]


def test_unmapped_types_get_one_id_each(spark):
    a = activity(spark, {}, {"type": "spam"}, {"type": "new_b"}, {"type": "new_a"}, {"type": "new_a"}, {"type": None})
    types, mapping = d.daily_content_types(a, contents(spark, *SEEDS))
    new = [(10, None, "N/A"), (11, "new_a", "N/A"), (12, "new_b", "N/A")]
    assert rows(types) == bag((4, "text_message", "Text"), (9, "spam", None), *new)
    assert rows(mapping) == bag(*SEEDS, (9, "spam", "N/A"), *new)


def test_unmapped_types_per_activity(spark):
    a = activity(
        spark,
        {"activity_id": "b", "type": "new"},
        {"activity_id": "a", "type": "new"},
        {"activity_id": "a", "type": "new"},
        {"activity_id": "c", "type": None},
        {"activity_id": "d"},
    )
    types, mapping = d.daily_content_types(a, contents(spark, *SEEDS), per="activity")
    assert rows(types) == bag((4, "text_message", "Text"), (10, None, None), (11, None, None), (12, None, None))
    assert rows(mapping) == bag(*SEEDS, (10, "new", "N/A"), (11, "new", "N/A"), (12, None, "N/A"))


def test_types_found_the_day_before_are_mapped(spark):
    a = activity(spark, {"type": "new"}, {"type": None})
    first, mapping = d.daily_content_types(a, contents(spark, *SEEDS))
    second, again = d.daily_content_types(a, mapping)
    assert rows(second) == rows(first)
    assert rows(again) == rows(mapping)
    assert rows(d.merge_content_types(first, second)) == rows(first)


def test_empty_mapping_starts_at_one(spark):
    types, mapping = d.daily_content_types(activity(spark, {}), contents(spark))
    assert rows(types) == rows(mapping) == bag((1, "text_message", "N/A"))


def test_unknown_grain_is_refused(spark):
    with pytest.raises(ValueError):
        d.daily_content_types(activity(spark), contents(spark), per="day")


def test_merge_keeps_old_ids_and_ignores_an_owner_change(spark):
    old = table(spark, "d_agent", (5, 1, "one"), (2, None, "two"))
    new = table(spark, "d_agent", (1, 7, "one"), (3, 7, "zed"), (2, 7, "abc"))
    assert rows(d.merge_agents(old, new)) == bag((5, 1, "one"), (2, None, "two"), (6, 7, "abc"), (7, 7, "zed"))


def test_merge_into_nothing_and_of_nothing(spark):
    none, some = table(spark, "d_agent_owner"), table(spark, "d_agent_owner", (8, "b"), (9, "a"))
    assert rows(d.merge_agent_owners(none, some)) == bag((1, "a"), (2, "b"))
    assert rows(d.merge_agent_owners(some, none)) == rows(some)


def test_null_names_are_known_unless_asked_otherwise(spark):
    old, new = table(spark, "d_agent_owner", (1, None)), table(spark, "d_agent_owner", (1, None), (2, "a"))
    assert rows(d.merge_agent_owners(old, new)) == bag((1, None), (2, "a"))
    assert rows(d.merge_agent_owners(old, new, null_safe=False)) == bag((1, None), (2, None), (3, "a"))


def test_content_types_merge_by_id(spark):
    old = contents(spark, (1, "a", "A"), (2, None, None), (3, "c", "C"), (3, None, None))
    new = contents(spark, (1, "other", "O"), (2, "b", "B"), (3, "c2", "C2"), (4, "d", "D"), (4, "d", "D"))
    assert rows(d.merge_content_types(old, new)) == bag(
        (1, "a", "A"), (2, None, None), (2, "b", "B"), (3, "c", "C"), (3, None, None), (3, "c2", "C2"), (4, "d", "D")
    )
