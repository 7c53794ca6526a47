"""Staging: run tags, lookups, the user accumulator, run selection."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palaver.functions.text import day_part, name_part, to_date
from palaver.schemas import USER_ACCUMULATOR


def _value(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def tag_activity(activity: DataFrame, natco: str | Column) -> DataFrame:
    """Add the NatCo the feed came from: a constant, or a column when many feeds are read at once."""
    return activity.withColumn("NatCo", _value(natco))


def tag_events(events: DataFrame, natco: str | Column, file_date: str | Column) -> DataFrame:
    """Add NatCo and FileDate."""
    return events.withColumn("NatCo", _value(natco)).withColumn("FileDate", to_date(_value(file_date)))


def conform(table: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """Pass a lookup or stored table through under its declared column order and types.

    Text that is no number or date becomes null where text is read; ``strict``, for what is published, makes it an error.
    """
    columns = [F.col(f.name) for f in schema]
    return table.select(*[(c.cast(f.dataType) if strict else c.try_cast(f.dataType)).alias(f.name) for c, f in zip(columns, schema)])


def roll_user_accumulator(
    accumulator: DataFrame,
    activity: DataFrame,
    file_date: str,
    d_agent: DataFrame,
    natco: str | None = None,
) -> DataFrame:
    """Replace the accumulator's rows of ``file_date`` by one row per activity of that file.

    ``d_agent`` is the dimension as it stood before the run, so users of an agent first seen in this file get a null
    AgentID. The feed is joined unaggregated: with ``d_agent`` read from a written table Spark broadcasts it when it
    is small enough, and otherwise AQE splits a hot agent's partition.

    No row is sorted here. Stored partitioned by FileDate, a rerun touches one partition; order is made on publish.
    """
    today = activity.select(
        F.lit(file_date).cast("date").alias("FileDate"),
        to_date(day_part("time")).alias("Date"),
        (F.lit(natco) if natco is not None else F.col("NatCo")).alias("NatCo"),
        name_part("agent_id").alias("Agent"),
        "user_id",
    )
    today = today.join(d_agent.select("Agent", "AgentID"), "Agent", "left")
    kept = conform(accumulator, USER_ACCUMULATOR).filter(F.col("FileDate") != F.lit(file_date).cast("date"))
    return kept.unionByName(conform(today, USER_ACCUMULATOR))


def feeds_are_empty(activity: DataFrame, events: DataFrame) -> bool:
    """True when there is nothing to process. Reads at most one row of each feed."""
    return activity.isEmpty() and events.isEmpty()


def run_sizes(requested: DataFrame, activity: DataFrame, events: DataFrame) -> DataFrame:
    """The same guard for many runs at once: rows of either feed per requested (FileDate, NatCo), and whether any."""
    run = ["FileDate", "NatCo"]
    activities = activity.groupBy(*run).agg(F.count(F.lit(1)).alias("activity_rows"))
    billed = events.groupBy(*run).agg(F.count(F.lit(1)).alias("event_rows"))
    sizes = requested.join(activities, run, "left").join(billed, run, "left").fillna(0, ["activity_rows", "event_rows"])
    return sizes.withColumn("has_data", F.col("activity_rows") + F.col("event_rows") > 0)


def run_slice(df: DataFrame, file_dates: str | Iterable[str], natcos: str | Iterable[str]) -> DataFrame:
    """The rows of some runs; on a table partitioned by FileDate and NatCo only those partitions are read."""
    dates = [file_dates] if isinstance(file_dates, str) else list(file_dates)
    names = [natcos] if isinstance(natcos, str) else list(natcos)
    return df.filter(
        F.col("FileDate").isin([F.lit(d).cast("date") for d in dates]) & F.col("NatCo").isin(names)
    )
