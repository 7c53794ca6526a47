"""Dimensions: daily agent owners, agents and content types, and their insert-only merges.

Ids once given never change. Rows are only ever appended: an owner change of a known agent is ignored.
"""

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.functions.keys import max_id, number_rows
from palaver.functions.text import name_part

UNKNOWN_CONTENT = "N/A"


def owner_names(events: DataFrame) -> DataFrame:
    return events.select(name_part("agent_owner").alias("AgentOwner")).distinct()


def agent_ids(activity: DataFrame, events: DataFrame) -> DataFrame:
    return activity.select("agent_id").unionByName(events.select("agent_id")).distinct()


def with_owner(agents: DataFrame, events: DataFrame, d_agent_owner: DataFrame) -> DataFrame:
    """Add Agent and, from the owners the events name, AgentOwnerID. Several owners of an agent give several rows."""
    owned = events.select("agent_id", "agent_owner").distinct().withColumn("AgentOwner", name_part("agent_owner"))
    return (
        agents.join(owned, "agent_id", "left")
        .join(d_agent_owner, "AgentOwner", "left")
        .select(*agents.columns, "AgentOwnerID", name_part("agent_id").alias("Agent"))
    )


def daily_agent_owners(events: DataFrame) -> DataFrame:
    """Distinct owner names, numbered in name order."""
    return number_rows(owner_names(events), ["AgentOwner"], "AgentOwnerID").select("AgentOwnerID", "AgentOwner")


def daily_agents(activity: DataFrame, events: DataFrame, d_agent_owner: DataFrame) -> DataFrame:
    """Distinct agent ids of both feeds, numbered in id order, with the owners the events name.

    Only agent_id and agent_owner are read: digests of the feeds, or their distinct pairs, serve as well as the feeds.
    """
    numbered = number_rows(agent_ids(activity, events), ["agent_id"], "AgentID")
    return with_owner(numbered, events, d_agent_owner).select("AgentID", "AgentOwnerID", "Agent")


def daily_content_types(
    activity: DataFrame, mapping: DataFrame, per: Literal["type", "activity"] = "type"
) -> tuple[DataFrame, DataFrame]:
    """Content types of the feed, and the mapping extended by what it lacked.

    ``per="type"`` gives each unmapped type one new ContentID, named at once, so that facts find it. ``per="activity"``
    keeps the historical output: one nameless content type per distinct (activity_id, type), named in the mapping only.
    """
    if per == "type":
        seen = activity.select("type").distinct()
        order = ["type"]
    elif per == "activity":
        seen = activity.select("activity_id", "type").distinct()
        order = ["activity_id", "type"]
    else:
        raise ValueError(f"per must be 'type' or 'activity', not {per!r}")

    unmapped = seen.join(mapping, _same(seen["type"], mapping["OriginalContent"], per == "type"), "left_anti")
    # The mapping's rows whose type occurs: the same rows as the feed joined to the mapping, from distinct types only.
    types = seen.select(F.col("type").alias("_type")).distinct()
    mapped = (
        mapping.join(types, _same(mapping["OriginalContent"], F.col("_type"), per == "type"), "left_semi")
        .select("ContentID", "OriginalContent", "Content")
        .distinct()
    )

    new = number_rows(unmapped, order, "ContentID", after=max_id(mapping, "ContentID")).select(
        "ContentID",
        F.col("type").alias("OriginalContent"),
        F.lit(UNKNOWN_CONTENT).alias("Content"),
    )
    extended = (
        mapping.select("ContentID", "OriginalContent", "Content")
        .unionByName(mapped.withColumn("Content", F.coalesce("Content", F.lit(UNKNOWN_CONTENT))))
        .distinct()
        .unionByName(new)
    )
    nothing = F.lit(None).cast("string")
    listed = new if per == "type" else new.select("ContentID", nothing.alias("OriginalContent"), nothing.alias("Content"))
    return mapped.unionByName(listed), extended


def _same(left: Column, right: Column, null_safe: bool) -> Column:
    return left.eqNullSafe(right) if null_safe else left == right


def insert_new(
    old: DataFrame, new: DataFrame, natural_key: str, id_column: str, order: list[str], null_safe: bool = True
) -> DataFrame:
    """Append the rows of ``new`` whose natural key ``old`` lacks, with ids following the highest old one.

    ``null_safe=False`` treats a null key as never known, so that it is appended again on every run.
    """
    unknown = new.join(
        old.select(F.col(natural_key).alias("_known")), _same(new[natural_key], F.col("_known"), null_safe), "left_anti"
    )
    numbered = number_rows(unknown, order, "_id", after=max_id(old, id_column))
    return old.unionByName(numbered.withColumn(id_column, F.col("_id")).select(*old.columns))


def merge_agent_owners(old: DataFrame, new: DataFrame, null_safe: bool = True) -> DataFrame:
    """Append unknown owners in name order. Ids that ``new`` may have are not used."""
    return insert_new(old, new, "AgentOwner", "AgentOwnerID", ["AgentOwner"], null_safe)


def merge_agents(old: DataFrame, new: DataFrame, null_safe: bool = True) -> DataFrame:
    """Append the rows of unknown agents, in the order of their daily AgentID, or of agent_id where not yet numbered."""
    order = "AgentID" if "AgentID" in new.columns else "agent_id"
    return insert_new(old, new, "Agent", "AgentID", [order, "AgentOwnerID"], null_safe)


def merge_content_types(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append content types by ContentID. A stored id without a name accepts the named row beside it."""
    closed = old.groupBy("ContentID").agg(F.bool_and(F.col("OriginalContent").isNotNull()).alias("_named")).filter("_named")
    columns = ["ContentID", "OriginalContent", "Content"]
    return old.select(*columns).unionByName(new.join(closed, "ContentID", "left_anti").select(*columns)).distinct()
