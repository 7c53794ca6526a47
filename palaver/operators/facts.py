"""Daily facts: message content, message conversations, conversations and single messages.

Each fact is one aggregation with map-side partial sums, so a hot agent or type reaches its reducer as one row per
map task. Keys are looked up after the aggregation, on the few rows that are left.

``digest_activity`` and ``digest_events`` aggregate a feed once to the finest grain any fact or dimension needs. A run
computes everything but the users from the digests and scans each feed once.
"""

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from palaver.functions.text import day_part, name_part

# Fixed values of the feeds and of the conversation-type lookup.
A2P = "a2p_conversation"
P2A = "p2a_conversation"
SINGLE = "single_message"
BASIC = "basic_message"
A2P_ID = "1"
P2A_ID = "2"
MOBILE_TERMINATED = "MT"
MOBILE_ORIGINATED = "MO"


# --- tallies over the raw feeds ---------------------------------------------------------------------------------


def _dated_activity(activity: DataFrame) -> DataFrame:
    return activity.withColumn("Date", day_part("time")).withColumn("Agent", name_part("agent_id"))


def _dated_events(events: DataFrame) -> DataFrame:
    return (
        events.withColumn("Date", day_part("start_time"))
        .withColumn("Agent", name_part("agent_id"))
        .withColumn("duration", F.coalesce("duration", F.lit(0).cast("bigint")))
    )


def _count_messages(groups: GroupedData) -> DataFrame:
    direction = F.upper("direction")
    return groups.agg(
        F.count_if(direction == MOBILE_TERMINATED).alias("MT_MessagesByType"),
        F.count_if(direction == MOBILE_ORIGINATED).alias("MO_MessagesByType"),
        F.count(F.lit(1)).alias("MTMO_MessagesByType"),
    )


def digest_activity(activity: DataFrame) -> DataFrame:
    """Message counts per (FileDate, NatCo, Date, agent_id, type)."""
    return _count_messages(_dated_activity(activity).groupBy("FileDate", "NatCo", "Date", "agent_id", "type"))


def digest_events(events: DataFrame) -> DataFrame:
    """Event sums per (FileDate, NatCo, Date, agent_id, agent_owner, type)."""
    return (
        _dated_events(events)
        .groupBy("FileDate", "NatCo", "Date", "agent_id", "agent_owner", "type")
        .agg(
            F.sum("mo_messages").alias("mo_messages"),
            F.sum("mt_messages").alias("mt_messages"),
            F.sum("duration").alias("duration"),
            F.count(F.lit(1)).alias("n_events"),
        )
    )


# --- tallies over digests, to any set of run columns ------------------------------------------------------------


def content_tally(digest: DataFrame, *run: str) -> DataFrame:
    counts = ["MT_MessagesByType", "MO_MessagesByType", "MTMO_MessagesByType"]
    return (
        digest.withColumn("Agent", name_part("agent_id"))
        .groupBy(*run, "Date", "NatCo", "Agent", "type")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )


def conversation_tally(digest: DataFrame, *run: str) -> DataFrame:
    return _sum_conversations(
        digest.withColumn("Agent", name_part("agent_id"))
        .filter(F.col("type").isin(A2P, P2A))
        .groupBy(*run, "Date", "NatCo", "Agent", "type")
    )


def single_message_tally(digest: DataFrame, *run: str) -> DataFrame:
    return (
        digest.withColumn("Agent", name_part("agent_id"))
        .groupBy(*run, "Date", "NatCo", "Agent", "type")
        .agg(F.sum("duration").alias("duration"), F.sum("n_events").alias("n_events"))
        .transform(_describe_conversations)
    )


def _sum_conversations(groups: GroupedData) -> DataFrame:
    return groups.agg(
        F.sum("mo_messages").alias("MO_messages"), F.sum("mt_messages").alias("MT_messages")
    ).withColumn("MTMO_messages", F.col("MO_messages") + F.col("MT_messages"))


def _describe_conversations(sums: DataFrame) -> DataFrame:
    """Average and counts. ``type`` is a grouping column, so every count is all of the group or nothing."""

    def events_of(*types: str) -> Column:
        return F.when(F.col("type").isin(*types), F.col("n_events")).otherwise(F.lit(0).cast("bigint"))

    return sums.select(
        "*",
        F.bround(F.col("duration") / F.col("n_events"), 2).alias("AverageDuration"),
        events_of(A2P, P2A).alias("NoOfConv"),
        events_of(SINGLE).alias("NoOfSM"),
        events_of(BASIC).alias("NoOfBM"),
    ).drop("duration", "n_events")


# --- key lookup -------------------------------------------------------------------------------------------------


def conversation_type_id() -> Column:
    """P2A conversations are type 2; every other event, conversation or not, is type 1."""
    return F.when(F.col("type") == P2A, P2A_ID).otherwise(A2P_ID)


def with_natco(df: DataFrame, d_natco: DataFrame) -> DataFrame:
    return df.join(d_natco.select("NatCo", "NatCoID"), "NatCo", "left")


def with_agent(df: DataFrame, d_agent: DataFrame) -> DataFrame:
    return df.join(d_agent.select("Agent", "AgentID"), "Agent", "left")


def with_content(df: DataFrame, d_content_type: DataFrame) -> DataFrame:
    contents = d_content_type.select("ContentID", "OriginalContent")
    return df.join(contents, df["type"] == contents["OriginalContent"], "left")


# --- the facts --------------------------------------------------------------------------------------------------


def message_content(tally: DataFrame, d_natco: DataFrame, d_content_type: DataFrame, d_agent: DataFrame) -> DataFrame:
    keyed = with_natco(with_agent(with_content(tally, d_content_type), d_agent), d_natco)
    return keyed.select(
        "Date", "NatCoID", "ContentID", "AgentID", "MT_MessagesByType", "MO_MessagesByType", "MTMO_MessagesByType"
    )


def message_conversation(tally: DataFrame, d_natco: DataFrame, d_agent: DataFrame) -> DataFrame:
    keyed = with_natco(with_agent(tally, d_agent), d_natco).withColumn("TypeOfConvID", conversation_type_id())
    return keyed.select("Date", "NatCoID", "AgentID", "TypeOfConvID", "MO_messages", "MT_messages", "MTMO_messages")


def conversations_and_sm(tally: DataFrame, d_natco: DataFrame, d_agent: DataFrame) -> DataFrame:
    keyed = with_natco(with_agent(tally, d_agent), d_natco).withColumn("TypeOfConvID", conversation_type_id())
    return keyed.select(
        "Date", "NatCoID", "AgentID", "TypeOfConvID", "AverageDuration", "NoOfConv", "NoOfSM", "NoOfBM"
    )


def daily_message_content(
    activity: DataFrame, d_natco: DataFrame, d_content_type: DataFrame, d_agent: DataFrame
) -> DataFrame:
    """Messages per Date, NatCo, content type and agent: terminated, originated and all. Date is text."""
    tally = _count_messages(_dated_activity(activity).groupBy("Date", "NatCo", "Agent", "type"))
    return message_content(tally, d_natco, d_content_type, d_agent)


def daily_message_conversation(events: DataFrame, d_natco: DataFrame, d_agent: DataFrame) -> DataFrame:
    """Messages in A2P and P2A conversations; the total is null when either sum is."""
    conversations = _dated_events(events).filter(F.col("type").isin(A2P, P2A))
    tally = _sum_conversations(conversations.groupBy("Date", "NatCo", "Agent", "type"))
    return message_conversation(tally, d_natco, d_agent)


def daily_conversations_and_sm(events: DataFrame, d_natco: DataFrame, d_agent: DataFrame) -> DataFrame:
    """Mean duration (a missing one counts as 0) and numbers of conversations, single and basic messages."""
    sums = (
        _dated_events(events)
        .groupBy("Date", "NatCo", "Agent", "type")
        .agg(F.sum("duration").alias("duration"), F.count(F.lit(1)).alias("n_events"))
    )
    return conversations_and_sm(_describe_conversations(sums), d_natco, d_agent)
