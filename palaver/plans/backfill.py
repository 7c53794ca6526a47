"""Many runs as one job: every file date and NatCo at once, with the result the runs would give one after another.

Run after run, a date's facts are replaced when the file of that date arrives, and first-seen agents, owners and
content types get the next free ids. Both have a closed form:

* A contribution to date d from the file of date f survives if no file of date d was processed for that NatCo, or if
  f >= d. A contribution without a date survives only from the NatCo's last file.
* A dimension row's id is its rank by (run in which its natural key was first seen, natural key).

Only the average duration depends on the order of all files that touch a date; it is folded over them.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.functions.keys import max_id, number_rows
from palaver.functions.rounding import from_hundredths, hundredths
from palaver.functions.text import day_part, name_part, to_date, to_decimal_comma
from palaver.operators import facts, users
from palaver.operators.dimensions import UNKNOWN_CONTENT, merge_content_types
from palaver.operators.merges import (
    CONTENT_KEYS,
    CONTENT_SUMS,
    CONVERSATION_KEYS,
    CONVERSATION_SUMS,
    SM_SUMS,
    in_hundredths,
    mean_over_files,
)
from palaver.plans.daily import Lookups
from palaver.workspace import concurrently, write_once

# Fixed value: the order in which the NatCos of one date are processed.
NATCO_ORDER = ("tc", "tp", "cg", "cr", "mk", "mt", "st")


def run_number(natco_order: Sequence[str] = NATCO_ORDER) -> Column:
    """A number that grows from run to run: by date, then by the NatCo's place in the order, others last."""
    place = F.array_position(F.array(*[F.lit(n) for n in natco_order]), F.col("NatCo"))
    place = F.when(place > 0, place).otherwise(len(natco_order) + 1)
    return F.unix_date("FileDate").cast("bigint") * (len(natco_order) + 2) + place


def runs_of(messages: DataFrame, billed: DataFrame) -> DataFrame:
    """The runs the feeds hold rows of. Pass ``runs`` to the functions below to add runs with empty files."""
    return messages.select("FileDate", "NatCo").unionByName(billed.select("FileDate", "NatCo")).distinct()


# --- dimensions -------------------------------------------------------------------------------------------------


def agent_owners(billed: DataFrame, natco_order: Sequence[str] = NATCO_ORDER, stored: DataFrame | None = None) -> DataFrame:
    """The stored owners, and those that they lack with ids after theirs."""
    first = billed.groupBy(name_part("agent_owner").alias("AgentOwner")).agg(F.min(run_number(natco_order)).alias("_run"))
    if stored is not None:
        first = _unknown(first, stored, "AgentOwner")
    after = 0 if stored is None else max_id(stored, "AgentOwnerID")
    new = number_rows(first, ["_run", "AgentOwner"], "AgentOwnerID", after).select("AgentOwnerID", "AgentOwner")
    return new if stored is None else stored.select(*new.columns).unionByName(new)


def _unknown(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    known = stored.select(F.col(key).alias("_known")).distinct()
    return rows.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")


def agents_by_first_run(
    messages: DataFrame,
    billed: DataFrame,
    d_agent_owner: DataFrame,
    natco_order: Sequence[str] = NATCO_ORDER,
    stored: DataFrame | None = None,
) -> DataFrame:
    """d_agent with the run each row appeared in, null for the stored ones. Later ids and owners of a known agent name
    are ignored."""
    seen = messages.select("FileDate", "NatCo", "agent_id").unionByName(billed.select("FileDate", "NatCo", "agent_id"))
    ids = seen.groupBy("agent_id").agg(F.min(run_number(natco_order)).alias("_run"))
    ids = ids.withColumn("Agent", name_part("agent_id"))
    if stored is not None:
        ids = _unknown(ids, stored, "Agent")
    first = ids.groupBy("Agent").agg(F.min("_run").alias("_first"))
    fresh = ids.join(first, ids["Agent"].eqNullSafe(first["Agent"]) & (ids["_run"] == first["_first"]), "left_semi")

    owned = (
        billed.groupBy("agent_id", "agent_owner")
        .agg(F.min(run_number(natco_order)).alias("_run"))
        .withColumn("AgentOwner", name_part("agent_owner"))
    )
    rows = (
        fresh.join(owned, ["agent_id", "_run"], "left")
        .join(d_agent_owner, "AgentOwner", "left")
        .select("_run", "agent_id", "AgentOwnerID", "Agent")
    )
    after = 0 if stored is None else max_id(stored, "AgentID")
    new = number_rows(rows, ["_run", "agent_id", "AgentOwnerID"], "AgentID", after).select("_run", "AgentID", "AgentOwnerID", "Agent")
    return new if stored is None else stored.withColumn("_run", F.lit(None).cast("bigint")).select(*new.columns).unionByName(new)


def content_types(
    messages: DataFrame, mapping: DataFrame, natco_order: Sequence[str] = NATCO_ORDER
) -> tuple[DataFrame, DataFrame]:
    """Content types of all feeds, and the mapping extended by the unmapped types in the order they were first seen."""
    seen = messages.groupBy("type").agg(F.min(run_number(natco_order)).alias("_run"))
    same = seen["type"].eqNullSafe(mapping["OriginalContent"])
    mapped = mapping.join(seen, same, "left_semi").select("ContentID", "OriginalContent", "Content").distinct()
    new = number_rows(
        seen.join(mapping, same, "left_anti"), ["_run", "type"], "ContentID", after=max_id(mapping, "ContentID")
    ).select("ContentID", F.col("type").alias("OriginalContent"), F.lit(UNKNOWN_CONTENT).alias("Content"))
    named = mapped.withColumn("Content", F.coalesce("Content", F.lit(UNKNOWN_CONTENT)))
    extended = mapping.select(*named.columns).unionByName(named).distinct().unionByName(new)
    return mapped.unionByName(new), extended


# --- facts ------------------------------------------------------------------------------------------------------


def surviving(tally: DataFrame, runs: DataFrame) -> DataFrame:
    """The contributions that no later run replaced, with Date as a date."""
    processed = runs.select("NatCo", F.col("FileDate").alias("Date"), F.lit(True).alias("_processed")).distinct()
    last = runs.groupBy("NatCo").agg(F.max("FileDate").alias("_last"))
    rows = tally.withColumn("Date", to_date("Date"))
    rows = rows.join(processed, ["NatCo", "Date"], "left").join(last, "NatCo", "left")
    dated = F.col("_processed").isNull() | (F.col("FileDate") >= F.col("Date"))
    kept = F.when(F.col("Date").isNull(), F.col("FileDate") == F.col("_last")).otherwise(dated)
    return rows.filter(kept).drop("_processed", "_last")


def surviving_stored(fact: DataFrame, runs: DataFrame) -> DataFrame:
    """The stored rows (with NatCo) whose date no run replaces. A run of the NatCo also drops those without a date."""
    fact = fact.withColumn("Date", to_date("Date"))
    replaced = runs.select("NatCo", F.col("FileDate").alias("Date")).distinct()
    return fact.filter(F.col("Date").isNotNull()).join(replaced, ["NatCo", "Date"], "left_anti")


def _with_stored(rows: DataFrame, fact: DataFrame | None, runs: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    rows = rows.select("NatCo", *keys, *sums)
    return rows if fact is None else rows.unionByName(_text_type(surviving_stored(fact, runs)).select(*rows.columns))


def _text_type(fact: DataFrame) -> DataFrame:
    return fact.withColumn("TypeOfConvID", F.col("TypeOfConvID").cast("string")) if "TypeOfConvID" in fact.columns else fact


def message_content(
    messages: DataFrame,
    runs: DataFrame,
    d_natco: DataFrame,
    d_content_type: DataFrame,
    d_agent: DataFrame,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Counts add up, so the digest's rows are filtered and keyed map-side and summed in one aggregation."""
    rows = surviving(messages.withColumn("Agent", name_part("agent_id")), runs)
    rows = facts.with_natco(facts.with_agent(facts.with_content(rows, d_content_type), d_agent), d_natco)
    rows = _with_stored(rows, stored, runs, CONTENT_KEYS, CONTENT_SUMS)
    return rows.groupBy("NatCo", *CONTENT_KEYS).agg(*[F.sum(c).alias(c) for c in CONTENT_SUMS])


def message_conversation(
    billed: DataFrame, runs: DataFrame, d_natco: DataFrame, d_agent: DataFrame, stored: DataFrame | None = None
) -> DataFrame:
    rows = surviving(facts.conversation_tally(billed, "FileDate"), runs)
    rows = facts.with_natco(facts.with_agent(rows, d_agent), d_natco)
    rows = rows.withColumn("TypeOfConvID", facts.conversation_type_id())
    rows = _with_stored(rows, stored, runs, CONVERSATION_KEYS, CONVERSATION_SUMS)
    return rows.groupBy("NatCo", *CONVERSATION_KEYS).agg(*[F.sum(c).alias(c) for c in CONVERSATION_SUMS])


def conversations_and_sm(
    billed: DataFrame, runs: DataFrame, d_natco: DataFrame, d_agent: DataFrame, stored: DataFrame | None = None
) -> DataFrame:
    """Each file's means are averaged with the mean stored before it, and rounded again.

    A key's list holds one entry per file that touched its date, so at most one per processed date. Both groupings
    work on one partitioning by key.
    """
    rows = surviving(facts.single_message_tally(billed, "FileDate"), runs)
    rows = facts.with_natco(facts.with_agent(rows, d_agent), d_natco)
    rows = rows.withColumn("TypeOfConvID", facts.conversation_type_id())
    keys = ["NatCo", *CONVERSATION_KEYS]
    per_file = rows.repartition(*keys).groupBy(*keys, "FileDate").agg(
        F.sum(hundredths(F.col("AverageDuration"))).alias("total"),
        F.count("AverageDuration").alias("n"),
        *[F.sum(c).alias(c) for c in SM_SUMS],
    )
    if stored is not None:
        # A stored mean is the first of its key's files, with a date before any.
        before = _text_type(surviving_stored(in_hundredths(stored), runs)).select(
            *keys,
            F.lit(None).cast("date").alias("FileDate"),
            F.col("AverageDuration").alias("total"),
            F.when(F.col("AverageDuration").isNotNull(), 1).otherwise(0).cast("bigint").alias("n"),
            *SM_SUMS,
        )
        per_file = per_file.unionByName(before)
    return (
        per_file.groupBy(*keys)
        .agg(F.collect_list(F.struct("FileDate", "total", "n")).alias("files"), *[F.sum(c).alias(c) for c in SM_SUMS])
        .withColumn("AverageDuration", to_decimal_comma(from_hundredths(mean_over_files(F.col("files")))))
        .select(*keys, "AverageDuration", *SM_SUMS)
    )


# --- users ------------------------------------------------------------------------------------------------------


def user_accumulator(
    activity: DataFrame, d_agent_by_run: DataFrame, natco_order: Sequence[str] = NATCO_ORDER
) -> DataFrame:
    """One row per activity. A run looks agents up in the dimension as it stood before, so an agent's first run and
    whatever precedes it has no AgentID."""
    rows = activity.select(
        "FileDate",
        to_date(day_part("time")).alias("Date"),
        "NatCo",
        name_part("agent_id").alias("Agent"),
        "user_id",
        run_number(natco_order).alias("_now"),
    )
    agents = d_agent_by_run.select(F.col("Agent").alias("_agent"), "AgentID", "_run")
    known = (rows["Agent"] == agents["_agent"]) & (F.coalesce(agents["_run"], F.lit(-(2**62))) < rows["_now"])
    return rows.join(agents, known, "left").select("FileDate", "Date", "NatCo", "AgentID", "user_id")


def kept_slices(accumulator: DataFrame, runs: DataFrame) -> DataFrame:
    """The stored rows that no run replaces."""
    rows = accumulator.filter(F.col("FileDate").isNotNull())
    return rows.join(runs.select("FileDate", "NatCo").distinct(), ["FileDate", "NatCo"], "left_anti")


# --- everything -------------------------------------------------------------------------------------------------


def backfill(
    activity: DataFrame,
    events: DataFrame,
    lookup: Lookups,
    natco_order: Sequence[str] = NATCO_ORDER,
    runs: DataFrame | None = None,
    state: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """All 14 tables after every run of the feeds, from the stored ``state`` or an empty one.

    ``activity`` and ``events`` carry FileDate and NatCo. Tables a run keeps per NatCo have NatCo as first column.
    ``runs`` (FileDate, NatCo) names the processed runs when some of them had empty files. ``state`` has the tables of
    STATE_SCHEMAS, those kept per NatCo with a NatCo column and for the NatCos of the runs. Stored ids stay, stored
    rows of dates that no run of their NatCo replaces stay. Of the accumulator the result has the runs' rows only.
    """
    state = state or {}
    messages, billed = concurrently(
        lambda: write_once(facts.digest_activity(activity), "messages"),
        lambda: write_once(facts.digest_events(events), "billed"),
    )
    processed = runs_of(messages, billed) if runs is None else runs.select("FileDate", "NatCo")

    def agent_dimensions() -> tuple[DataFrame, DataFrame]:
        owners = write_once(agent_owners(billed, natco_order, state.get("d_agent_owner")), "owners")
        return owners, write_once(agents_by_first_run(messages, billed, owners, natco_order, state.get("d_agent")), "agents")

    def content_dimension() -> tuple[DataFrame, DataFrame]:
        contents, mapping = content_types(messages, lookup.contents, natco_order)
        if "d_content_type" in state:
            contents = merge_content_types(state["d_content_type"], contents)
        return write_once(contents, "contents"), mapping

    runs, (owners, by_run), (contents, mapping) = concurrently(
        lambda: write_once(processed, "runs"), agent_dimensions, content_dimension
    )
    agents = by_run.select("AgentID", "AgentOwnerID", "Agent")
    accumulator = user_accumulator(activity, by_run, natco_order)
    counted = accumulator
    if "acc_users_daily" in state:
        counted = counted.unionByName(kept_slices(state["acc_users_daily"], runs).select(*accumulator.columns))
    months = write_once(users.user_months(counted, lookup.natcos, ["NatCo"]), "user_months")

    return {
        "d_natco": lookup.natcos,
        "d_content_type": contents,
        "d_conversation_type": lookup.conversation_types,
        "d_agent": agents,
        "d_agent_owner": owners,
        "f_message_content": message_content(messages, runs, lookup.natcos, contents, agents, state.get("f_message_content")),
        "f_conversations_and_sm": conversations_and_sm(
            billed, runs, lookup.natcos, agents, state.get("f_conversations_and_sm")
        ),
        "f_message_conversation": message_conversation(
            billed, runs, lookup.natcos, agents, state.get("f_message_conversation")
        ),
        "f_uau_daily": users.uau_daily(months, ["NatCo"]),
        "f_uau_monthly": users.uau_monthly(months, ["NatCo"]),
        "f_uau_yearly": users.uau_yearly(months, ["NatCo"]),
        "f_uau_total": users.uau_total(months, ["NatCo"]),
        "acc_users_daily": accumulator,
        "ContentDescriptionMapping": mapping,
    }
