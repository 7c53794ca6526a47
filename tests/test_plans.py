"""What the physical plans must look like, and that a hot key changes no result."""

import re

import pytest
from pyspark.sql import functions as F

from checks.catalog import QUERIES
from checks.fixtures import Feeds
from palaver.operators import facts, users
from palaver.operators.staging import roll_user_accumulator
from palaver.sources import lookups
from palaver.workspace import working_folder, write_once
from tests.helpers import rows, table

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "fact_message_content_daily",
        "merge_conversation_sm",
        "scd_agent",
        "dim_content_type_per_activity",
        "uau_cross_natco",
        "backfill_dims",
        "backfill_average_duration",
        "backfill_users",
    ],
)
def test_no_cross_join_and_no_window_over_one_task(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    # The only single-task window numbers ranges: its input is one row per range.
    for window in re.findall(r"Window \[.*", text):
        assert "row_number" not in window or "_key_range" in window, window


def test_feed_scans_read_only_the_columns_they_need(spark):
    feed = Feeds(spark, SMALL).base_activity
    stored = write_once(feed, "feed")
    text = plan(facts.digest_activity(stored.filter(F.col("FileDate") == F.lit("2024-01-15").cast("date"))))
    (schema,) = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert set(re.findall(r"(\w+):", schema)) == {"agent_id", "direction", "time", "type", "NatCo", "FileDate"}
    assert "PushedFilters: [IsNotNull(FileDate), EqualTo(FileDate,2024-01-15)]" in text


def test_a_fact_is_one_aggregation_with_partial_sums(spark):
    f = Feeds(spark, SMALL)
    agents = write_once(table(spark, "d_agent", (1, None, "agent1")), "agents")
    fact = facts.daily_message_content(f.base_activity, lookups.natcos(spark), lookups.content_mapping(spark), agents)
    text = plan(fact)
    assert text.count("hashpartitioning") == 1
    assert "partial_count" in text and text.count("BroadcastHashJoin") == 3


def test_the_feed_is_not_shuffled_to_a_small_agent_dimension(spark):
    f = Feeds(spark, SMALL)
    agents = write_once(table(spark, "d_agent", (1, None, "agent1")), "agents")
    rolled = roll_user_accumulator(table(spark, "acc_users_daily"), f.base_activity, "2024-01-15", agents)
    assert "hashpartitioning" not in plan(rolled) and "BroadcastHashJoin" in plan(rolled)


def test_a_dimension_too_big_to_broadcast_is_joined_by_shuffle(spark, setting):
    f = Feeds(spark, SMALL)
    agents = write_once(table(spark, "d_agent", (1, None, "agent1")), "agents")
    empty = table(spark, "acc_users_daily")
    small = rows(roll_user_accumulator(empty, f.base_activity, "2024-01-15", agents))
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    big = roll_user_accumulator(empty, f.base_activity, "2024-01-15", agents)
    assert "BroadcastHashJoin" not in plan(big)
    assert rows(big) == small


def test_a_hot_agent_is_spread_over_the_reducers(spark, setting):
    """A third of all rows in one (Date, NatCo, Agent): the distinct users are shuffled by user, not by agent."""
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    hot = spark.range(4000).selectExpr(
        "DATE'2024-01-02' AS FileDate", "DATE'2024-01-02' AS Date", "'mt' AS NatCo",
        "IF(id % 3 = 0, 1L, id) AS AgentID", "concat('u', id) AS user_id",
    )
    months = users.user_months(hot, lookups.natcos(spark))
    sizes = [r["count"] for r in months.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * 4000 / 4
    assert rows(users.uau_daily(months).filter("AgentID = 1"), "UAU_daily") == {(1335,): 1}


def test_working_tables_are_in_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert working_folder(spark) == configured.rstrip("/")
    stored = write_once(spark.range(3), "probe")
    assert all(f"{working_folder(spark)}/palaver/" in path for path in stored.inputFiles())
