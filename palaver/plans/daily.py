"""One run: a NatCo's feeds of one file date, the lookups and the stored state give the new state of all 14 tables."""

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver import schemas
from palaver.operators import contributions, dimensions, facts, merges, user_months, users
from palaver.operators.staging import roll_user_accumulator
from palaver.sources import lookups
from palaver.workspace import concurrently, literal_table, matching, write_once


@dataclass(frozen=True)
class Lookups:
    natcos: DataFrame
    conversation_types: DataFrame
    contents: DataFrame


@dataclass(frozen=True)
class State:
    """What a run takes over from the runs before it. Facts and the accumulator are those of the run's NatCo."""

    d_agent_owner: DataFrame
    d_agent: DataFrame
    d_content_type: DataFrame
    f_message_content: DataFrame
    f_message_conversation: DataFrame
    f_conversations_and_sm: DataFrame
    acc_users_daily: DataFrame


STATE_SCHEMAS = {
    "d_agent_owner": schemas.AGENT_OWNER,
    "d_agent": schemas.AGENT,
    "d_content_type": schemas.CONTENT_TYPE,
    "f_message_content": schemas.MESSAGE_CONTENT,
    "f_message_conversation": schemas.MESSAGE_CONVERSATION,
    "f_conversations_and_sm": schemas.CONVERSATIONS_AND_SM,
    "acc_users_daily": schemas.USER_ACCUMULATOR,
}


def seed_lookups(spark: SparkSession, folder: str | None = None) -> Lookups:
    """The lookups from the ``;``-separated files of ``folder``, and the built-in rows for files that are not there."""

    def place(name: str) -> str | None:
        return folder if folder and matching(spark, f"{folder.rstrip('/')}/{name}") else None

    return Lookups(
        lookups.natcos(spark, place(lookups.NATCO_FILE)),
        lookups.conversation_types(spark, place(lookups.CONVERSATION_TYPE_FILE)),
        lookups.content_mapping(spark, place(lookups.CONTENT_FILE)),
    )


def empty_state(spark: SparkSession) -> State:
    return State(**{name: literal_table(spark, [], schema) for name, schema in STATE_SCHEMAS.items()})


def day_digests(activity: DataFrame, events: DataFrame, file_date: str, natco: str) -> tuple[DataFrame, DataFrame]:
    """Both feeds of a run, each aggregated once and written. They depend on the feeds only, not on the stored state."""
    tags = {"NatCo": F.lit(natco), "FileDate": F.lit(file_date).cast("date")}
    messages, billed = concurrently(
        lambda: write_once(facts.digest_activity(activity.withColumns(tags)), "messages"),
        lambda: write_once(facts.digest_events(events.withColumns(tags)), "billed"),
    )
    return messages, billed


def run_day(
    activity: DataFrame,
    events: DataFrame,
    lookup: Lookups,
    state: State,
    file_date: str,
    natco: str,
    per: str = "type",
    digests: tuple[DataFrame, DataFrame] | None = None,
    stored_users: user_months.StoredUsers | None = None,
    stored_files: contributions.StoredFiles | None = None,
) -> dict[str, DataFrame]:
    """The result tables of one run, 14 by name. ``activity`` and ``events`` hold the run's rows only.

    Each feed is aggregated once, into a digest that every dimension and fact is derived from. ``activity`` is read a
    second time for the accumulator, which keeps a row per activity, and for the distinct users that are counted.
    ``digests`` are those of ``day_digests``, where they are there already.

    With ``stored_users`` users are not counted from the whole accumulator: the results by day, month and year hold the
    touched months and their years only, and ``acc_user_months`` and ``acc_user_years`` are two more tables, for the next run.

    With ``stored_files`` the accumulating facts are summed from what each file adds, and hold the touched dates only; what
    this file adds to each are three more tables.
    """
    messages, billed = digests or day_digests(activity, events, file_date, natco)
    activity = activity.withColumns({"NatCo": F.lit(natco), "FileDate": F.lit(file_date).cast("date")})
    accumulator = roll_user_accumulator(state.acc_users_daily, activity, file_date, state.d_agent)

    def agent_dimensions() -> tuple[DataFrame, DataFrame]:
        # Unnumbered: the merges number only what is new.
        owners = dimensions.merge_agent_owners(state.d_agent_owner, dimensions.owner_names(billed))
        owners = write_once(owners, "owners")
        todays = dimensions.with_owner(dimensions.agent_ids(messages, billed), billed, owners)
        return owners, write_once(dimensions.merge_agents(state.d_agent, todays), "agents")

    def content_dimension() -> tuple[DataFrame, DataFrame]:
        typed = messages if per == "type" else activity
        new, mapping = dimensions.daily_content_types(typed, lookup.contents, per)
        return write_once(dimensions.merge_content_types(state.d_content_type, new), "contents"), mapping

    def counted_users() -> dict[str, DataFrame]:
        if stored_users is None:
            months = write_once(users.user_months(accumulator, lookup.natcos), "user_months")
            return _user_facts(months, months, months)
        today = accumulator.filter(F.col("FileDate") == F.lit(file_date).cast("date"))
        by_file = user_months.replace_file(stored_users.months, user_months.file_months(today), file_date)
        by_file = write_once(by_file, "user_months_by_file")
        months, years = concurrently(
            lambda: write_once(user_months.over_files(by_file, lookup.natcos), "user_months"),
            lambda: write_once(user_months.replace_months(stored_users.years, by_file, stored_users.touched), "user_years"),
        )
        all_years = years.unionByName(stored_users.other_years)
        counts = _user_facts(months, *[user_months.as_months(x, lookup.natcos) for x in (years, all_years)])
        return {**counts, "acc_user_months": by_file, "acc_user_years": years}

    (owners, agents), (contents, mapping), counts, touched = concurrently(
        agent_dimensions,
        content_dimension,
        counted_users,
        lambda: merges.touched_dates(file_date, messages, billed),
    )

    new_content = facts.message_content(facts.content_tally(messages), lookup.natcos, contents, agents)
    new_conversation = facts.message_conversation(facts.conversation_tally(billed), lookup.natcos, agents)
    new_sm = facts.conversations_and_sm(facts.single_message_tally(billed), lookup.natcos, agents)

    def merged(name: str, new: DataFrame, merge) -> DataFrame:
        if stored_files is not None:
            return contributions.fact_of_files(name, added[contributions.BY_FILE[name]], stored_files)
        return merges.merge_touched_dates(getattr(state, name), new, file_date, merge, touched)

    added = {}
    if stored_files is not None:
        todays = {"f_message_content": new_content, "f_message_conversation": new_conversation, "f_conversations_and_sm": new_sm}
        steps = [partial(write_once, contributions.by_file(new, name, file_date), name) for name, new in todays.items()]
        added = dict(zip((contributions.BY_FILE[name] for name in todays), concurrently(*steps)))

    return {
        "d_natco": lookup.natcos,
        "d_content_type": contents,
        "d_conversation_type": lookup.conversation_types,
        "d_agent": agents,
        "d_agent_owner": owners,
        "f_message_content": merged("f_message_content", new_content, merges.merge_message_content),
        "f_conversations_and_sm": merged("f_conversations_and_sm", new_sm, merges.merge_conversations_and_sm),
        "f_message_conversation": merged(
            "f_message_conversation", new_conversation, merges.merge_message_conversation
        ),
        **counts,
        **added,
        "acc_users_daily": accumulator,
        "ContentDescriptionMapping": mapping,
    }


def _user_facts(months: DataFrame, by_year: DataFrame, by_any: DataFrame) -> dict[str, DataFrame]:
    return {
        "f_uau_daily": users.uau_daily(months),
        "f_uau_monthly": users.uau_monthly(months),
        "f_uau_yearly": users.uau_yearly(by_year),
        "f_uau_total": users.uau_total(by_any),
    }
