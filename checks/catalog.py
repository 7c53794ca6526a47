"""Every registered query: an operator of the library over the whole test tables."""

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.fixtures import ACTIVITY_DAY, EVENTS_DAY, Feeds
from palaver import schemas
from palaver.functions.text import day_part, name_part
from palaver.operators import dimensions, facts, merges, staging, users
from palaver.plans import backfill, compact, daily, jobs, publish
from palaver.sources import delimited, feeds, lookups
from palaver.workspace import concurrently, literal_table, new_path, write_once

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BEFORE_ALL = "1900-01-01"
NATCO = "mt"


def query(function: Callable[[Feeds], DataFrame]) -> Callable[[Feeds], DataFrame]:
    QUERIES[function.__name__] = lambda spark, sf_dir: function(Feeds(spark, sf_dir))
    return function


# --- dimensions the fact queries join ---------------------------------------------------------------------------


def owned_agents(events: DataFrame) -> DataFrame:
    """All a dimension reads of the events, in one scan."""
    return write_once(events.select("agent_id", "agent_owner").distinct(), "owned")


def agents_of(activity: DataFrame, events: DataFrame) -> DataFrame:
    owned = owned_agents(events)
    return dimensions.daily_agents(activity, owned, dimensions.daily_agent_owners(owned))


def base_agents(f: Feeds) -> DataFrame:
    return write_once(agents_of(f.base_activity, f.base_events), "agents")


def contents_of(activity: DataFrame) -> DataFrame:
    return dimensions.daily_content_types(activity, lookups.content_mapping(activity.sparkSession))[0]


def content_keys(f: Feeds) -> tuple[DataFrame, DataFrame]:
    agents, contents = concurrently(
        lambda: base_agents(f), lambda: write_once(contents_of(f.base_activity), "contents")
    )
    return agents, contents


def on_day(df: DataFrame, day: str) -> DataFrame:
    return df.filter(F.col("FileDate") == F.lit(day).cast("date"))


def off_day(df: DataFrame, day: str) -> DataFrame:
    return df.filter(F.col("FileDate") != F.lit(day).cast("date"))


def accumulator_of(f: Feeds) -> DataFrame:
    agents = base_agents(f)
    rows = f.base_activity.withColumns({"Agent": name_part("agent_id"), "Date": day_part("time")})
    return staging.conform(rows.join(agents, "Agent", "left"), schemas.USER_ACCUMULATOR)


# --- sources and sinks ------------------------------------------------------------------------------------------


@query
def src_delimited_roundtrip(f: Feeds) -> DataFrame:
    """Whole documents, with their line breaks, quotes and delimiters, through delimited text and back."""
    documents = f.table("documents")
    dialect = delimited.Dialect(delimiter=";", multiLine=True)
    path = new_path(f.spark, "documents")
    delimited.write_delimited(documents, path, dialect)
    return delimited.read_delimited(f.spark, path, documents.schema, dialect)


@query
def src_multifile(f: Feeds) -> DataFrame:
    rows = f.base_activity.select(*schemas.ACTIVITY.names, F.concat(F.lit("activity_"), "NatCo").alias("file"))
    path = new_path(f.spark, "multifile")
    rows.hint("rebalance", "file").write.partitionBy("file").options(**delimited.TABS.options()).csv(path)
    names = [f"file=activity_{n}" for n in ("mt", "cg", "st", "cr", "tc", "tp")]
    return delimited.read_many(f.spark, path, names, schemas.ACTIVITY, delimited.TABS)


@query
def src_glob_partitions(f: Feeds) -> DataFrame:
    rows = accumulator_of(f).withColumn("file", F.format_string(feeds.ACCUMULATOR_NAME.format(natco="%s"), "NatCo"))
    path = new_path(f.spark, "accumulators")
    rows.hint("rebalance", "file").write.partitionBy("file").options(**delimited.SEMICOLONS.options()).csv(path)
    return feeds.read_accumulators(f.spark, path, prefix="file=")


@query
def src_feed_by_filename(f: Feeds) -> DataFrame:
    """The activity feed written as gzip TSV under its file names, one per run, and read back in one scan."""
    name = F.format_string(feeds.feed_file("activity", "%s", "%s"), F.col("FileDate").cast("string"), "NatCo")
    rows = f.base_activity.select(*schemas.ACTIVITY.names, name.alias("file"))
    path = new_path(f.spark, "feed")
    writer = rows.hint("rebalance", "file").write.partitionBy("file").options(**delimited.TABS.options())
    writer.option("compression", "gzip").csv(path)
    return feeds.read_feed(f.spark, path, "activity", prefix="file=")


@query
def src_malformed_policy(f: Feeds) -> DataFrame:
    """Lines with a wrong type, a field too many and a field too few are set apart; all others are kept."""
    wrong = F.col("activity_id").cast("bigint") % 50
    size = F.when(wrong == 7, "bad").otherwise(F.col("size_bytes").cast("string"))
    fields = F.concat_ws("\t", "activity_id", "agent_id", "user_id", "type", size)
    line = F.when(wrong == 11, F.concat(fields, F.lit("\textra")))
    line = line.when(wrong == 13, F.concat_ws("\t", "activity_id", "agent_id")).otherwise(fields)
    path, quarantine = new_path(f.spark, "lines"), new_path(f.spark, "quarantine")
    f.base_activity.select(line).write.text(path)

    schema = StructType.fromDDL("activity_id string, agent_id string, user_id string, type string, size_bytes bigint")
    dialect = delimited.Dialect(header=False, delimiter="\t")
    kept = delimited.read_delimited(f.spark, path, schema, dialect, bad_records_path=quarantine)
    bad = f.spark.read.parquet(quarantine)
    return kept.select("activity_id", "size_bytes", F.lit("kept").alias("status")).unionByName(
        bad.select("activity_id", "size_bytes", F.lit("quarantined").alias("status"))
    )


@query
def sink_csv_roundtrip(f: Feeds) -> DataFrame:
    """A stored fact with decimal commas, sorted, through ``;``-separated text and back."""
    fact = facts.daily_conversations_and_sm(
        f.base_events, lookups.natcos(f.spark), base_agents(f)
    )
    fact = merges.merge_conversations_and_sm(_empty(f, "f_conversations_and_sm"), fact, BEFORE_ALL)
    path = new_path(f.spark, "fact")
    delimited.write_delimited(fact, path, delimited.SEMICOLONS, sort_by=merges.CONVERSATION_KEYS)
    return delimited.read_delimited(f.spark, path, schemas.CONVERSATIONS_AND_SM, delimited.SEMICOLONS)


@query
def sink_publish_skip_empty(f: Feeds) -> DataFrame:
    """Two versions; the second has an empty fact, so the first version of that fact stays current."""
    agents, contents = content_keys(f)
    content = facts.daily_message_content(f.base_activity, lookups.natcos(f.spark), contents, agents)
    results = {"d_natco": lookups.natcos(f.spark), "d_agent": agents, "f_message_content": content}
    root = new_path(f.spark, "published")
    publish.publish(results, f"{root}/lookup", f"{root}/output", "v1", NATCO, ACTIVITY_DAY)
    results["f_message_content"] = content.filter(F.lit(False))
    publish.publish(results, f"{root}/lookup", f"{root}/output", "v2", NATCO, ACTIVITY_DAY)
    return publish.published(f.spark, f"{root}/output").select("name", "version")


def concurrent_runs(f: Feeds) -> list[daily.State]:
    """The stored states of two runs that both loaded before either was published. Some agents are in both files."""
    root = new_path(f.spark, "concurrent")
    activity, events = f.activity(early=True), f.events(joint=True)
    folders = f"{root}/lookup", f"{root}/output"
    files = ("mt", F.col("agent_id") >= "agent15"), ("cg", F.col("agent_id") < "agent3")
    runs = [jobs.DayRun(activity.filter(held), events.filter(held), *folders, ACTIVITY_DAY, natco) for natco, held in files]
    for run in runs:
        run.publish()
    return [publish.load(f.spark, folders[1], natco)[1] for natco, _ in files]


@query
def publish_concurrent(f: Feeds) -> DataFrame:
    first, second = concurrent_runs(f)
    return first.f_message_content.unionByName(second.f_message_content)


@query
def publish_concurrent_agents(f: Feeds) -> DataFrame:
    return concurrent_runs(f)[0].d_agent


@query
def merge_slices_state(f: Feeds) -> DataFrame:
    """A fact kept in date slices: all other files, then that of one date, which reads and writes the dates it touches."""
    root = new_path(f.spark, "slices")
    folders = f"{root}/lookup", f"{root}/output"
    today = F.col("FileDate") == F.lit(ACTIVITY_DAY).cast("date")
    for file_date, held in ((BEFORE_ALL, ~today), (ACTIVITY_DAY, today)):
        activity, events = f.activity(early=True).filter(held), f.events(joint=True).filter(held)
        jobs.DayRun(activity, events, *folders, file_date, NATCO).publish()
    return publish.load(f.spark, folders[1], NATCO)[1].f_message_content


def rerun_by_file(f: Feeds) -> daily.State:
    """Facts kept by file: all other files, a wrong file of one date, that date's right file, and the others once more."""
    root = new_path(f.spark, "by_file")
    folders = f"{root}/lookup", f"{root}/output"
    activity, events = f.activity(early=True), f.events(joint=True)
    today = F.col("FileDate") == F.lit(ACTIVITY_DAY).cast("date")
    wrong = ~today & (F.col("agent_id") < "agent3")
    for file_date, seen in ((BEFORE_ALL, ~today), (ACTIVITY_DAY, wrong), (ACTIVITY_DAY, today), (BEFORE_ALL, ~today)):
        jobs.DayRun(activity.filter(seen), events.filter(seen), *folders, file_date, NATCO, by_file=True).publish()
    return publish.load(f.spark, folders[1], NATCO)[1]


@query
def facts_rerun(f: Feeds) -> DataFrame:
    return rerun_by_file(f).f_message_content


@query
def facts_rerun_conversations(f: Feeds) -> DataFrame:
    return rerun_by_file(f).f_message_conversation


@query
def uau_incremental(f: Feeds) -> DataFrame:
    """Users counted from stored months: all other files, a wrong file of one date, and that date's right file after it."""
    root = new_path(f.spark, "user_months")
    folders = f"{root}/lookup", f"{root}/output"
    activity, events = f.activity(early=True), f.events(joint=True)
    today = F.col("FileDate") == F.lit(ACTIVITY_DAY).cast("date")
    wrong = ~today & (F.col("agent_id") < "agent3")
    for file_date, seen, billed in ((BEFORE_ALL, ~today, ~today), (ACTIVITY_DAY, wrong, F.lit(False)), (ACTIVITY_DAY, today, today)):
        jobs.DayRun(activity.filter(seen), events.filter(billed), *folders, file_date, NATCO).publish()
    counts = []
    for grain, period in (("daily", "Date"), ("monthly", "YearMonth"), ("yearly", "Year"), ("total", None)):
        counted = publish.current_table(f.spark, folders[1], f"f_uau_{grain}", NATCO)
        name = F.col(period).cast("string") if period else F.lit(None).cast("string")
        counts.append(counted.select(F.lit(grain).alias("grain"), name.alias("period"), "NatCoID", "AgentID", F.col(f"UAU_{grain}").alias("users")))
    return reduce(DataFrame.unionByName, counts)


# --- staging ----------------------------------------------------------------------------------------------------


@query
def stage_activity(f: Feeds) -> DataFrame:
    raw = f.base_activity.withColumnRenamed("NatCo", "source")
    return staging.tag_activity(raw, F.col("source")).select(*schemas.ACTIVITY.names, "NatCo")


@query
def stage_events(f: Feeds) -> DataFrame:
    raw = f.base_events.withColumnsRenamed({"NatCo": "source", "FileDate": "arrived"})
    return staging.tag_events(raw, F.col("source"), F.col("arrived")).drop("source", "arrived")


@query
def stage_lookups(f: Feeds) -> DataFrame:
    """The three lookups under their declared schemas, with the feed rows each of their rows applies to."""
    spark = f.spark
    natcos = staging.conform(lookups.natcos(spark), schemas.NATCO)
    contents = staging.conform(lookups.content_mapping(spark), schemas.CONTENT_MAPPING)
    kinds = staging.conform(lookups.conversation_types(spark), schemas.CONVERSATION_TYPE)
    by_natco = f.base_activity.groupBy("NatCo").count()
    by_type = f.base_activity.groupBy(F.col("type").alias("OriginalContent")).count()
    by_kind = f.base_events.groupBy(facts.conversation_type_id().cast("int").alias("TypeOfConvID")).count()

    def rows(lookup: str, table: DataFrame, counts: DataFrame, key: str, id_: str, text: str) -> DataFrame:
        return table.join(counts, key, "left").select(
            F.lit(lookup).alias("lookup"),
            F.col(id_).cast("bigint").alias("id"),
            F.col(text).alias("text"),
            F.coalesce("count", F.lit(0).cast("bigint")).alias("feed_rows"),
        )

    return (
        rows("natco", natcos, by_natco, "NatCo", "NatCoID", "NatCo")
        .unionByName(rows("content", contents, by_type, "OriginalContent", "ContentID", "Content"))
        .unionByName(rows("conversation_type", kinds, by_kind, "TypeOfConvID", "TypeOfConvID", "Description"))
    )


@query
def acc_users_daily_roll(f: Feeds) -> DataFrame:
    """A rerun of one file date over the accumulator of all. The dimension so far holds agents with P2A events only."""
    activity, p2a = f.activity(wide=True), f.events(wide=True).filter(F.col("type") == facts.P2A)
    known = write_once(agents_of(activity.filter(F.lit(False)), p2a), "agents")
    rows = activity.withColumns({"Agent": name_part("agent_id"), "Date": day_part("time")})
    old = staging.conform(rows.join(known, "Agent", "left"), schemas.USER_ACCUMULATOR)
    return staging.roll_user_accumulator(old, on_day(activity, ACTIVITY_DAY), ACTIVITY_DAY, known)


@query
def acc_users_daily_compacted(f: Feeds) -> DataFrame:
    """The same rerun, of one NatCo, over slices that were gathered by month, and then gathered again."""
    root = new_path(f.spark, "compacted")
    folders = f"{root}/lookup", f"{root}/output"
    activity, p2a = f.activity(wide=True), f.events(wide=True).filter(F.col("type") == facts.P2A)
    known = write_once(agents_of(activity.filter(F.lit(False)), p2a), "agents")
    activity = activity.filter(F.col("NatCo") == NATCO)
    rows = activity.withColumns({"Agent": name_part("agent_id"), "Date": day_part("time")})
    old = staging.conform(rows.join(known, "Agent", "left"), schemas.USER_ACCUMULATOR)
    runs = sorted((str(r["FileDate"]), NATCO) for r in activity.select("FileDate").distinct().collect())
    publish.publish_backfill({publish.ACCUMULATOR: old}, *folders, "v1", runs)
    compact.compact(f.spark, *folders, "v2", NATCO)
    stored = publish.load(f.spark, folders[1], NATCO)[1].acc_users_daily
    rolled = staging.roll_user_accumulator(stored, on_day(activity, ACTIVITY_DAY), ACTIVITY_DAY, known)
    publish.publish({publish.ACCUMULATOR: rolled}, *folders, "v3", NATCO, ACTIVITY_DAY)
    compact.compact(f.spark, *folders, "v4", NATCO)
    return publish.load(f.spark, folders[1], NATCO)[1].acc_users_daily


@query
def guard_empty_inputs(f: Feeds) -> DataFrame:
    """Which of the requested runs have data: every date of the feeds for every NatCo, one of which has no feed."""
    activity, events = f.base_activity, f.events(joint=True)
    natcos = F.explode(F.array(*[F.lit(n) for n in backfill.NATCO_ORDER]))
    dates = activity.select("FileDate").unionByName(events.select("FileDate")).distinct()
    return staging.run_sizes(dates.select("FileDate", natcos.alias("NatCo")), activity, events)


@query
def stage_run_slice(f: Feeds) -> DataFrame:
    """The whole feed landed by date and NatCo, then one run read from it."""
    landed = feeds.land_feed(f.base_activity, new_path(f.spark, "landed"))
    return staging.run_slice(landed, ACTIVITY_DAY, NATCO)


# --- dimensions -------------------------------------------------------------------------------------------------


@query
def d_natco(f: Feeds) -> DataFrame:
    """The static NatCo dimension with the activity each row stands for."""
    counts = f.base_activity.groupBy("NatCo").agg(F.count(F.lit(1)).alias("activity_rows"))
    return lookups.natcos(f.spark).join(counts, "NatCo", "left").select("NatCo", "NatCoID", "activity_rows")


@query
def d_conversation_type(f: Feeds) -> DataFrame:
    """The static conversation-type dimension with the billable events each row stands for."""
    kinds = f.base_events.groupBy(facts.conversation_type_id().cast("int").alias("TypeOfConvID"))
    counts = kinds.agg(F.count(F.lit(1)).alias("event_rows"))
    table = lookups.conversation_types(f.spark).join(counts, "TypeOfConvID", "left")
    return table.select("TypeOfConvID", "TypeOfConv", "Description", "event_rows")


@query
def dim_agent_owner_daily(f: Feeds) -> DataFrame:
    return dimensions.daily_agent_owners(f.events(wide=True))


@query
def dim_agent_daily(f: Feeds) -> DataFrame:
    return agents_of(f.activity(wide=True), f.events(wide=True))


@query
def dim_content_type_daily(f: Feeds) -> DataFrame:
    return contents_of(f.base_activity)


@query
def content_mapping_extend(f: Feeds) -> DataFrame:
    return dimensions.daily_content_types(f.base_activity, lookups.content_mapping(f.spark))[1]


@query
def dim_content_type_per_activity(f: Feeds) -> DataFrame:
    return dimensions.daily_content_types(f.base_activity, lookups.content_mapping(f.spark), per="activity")[0]


@query
def content_mapping_extend_per_activity(f: Feeds) -> DataFrame:
    return dimensions.daily_content_types(f.base_activity, lookups.content_mapping(f.spark), per="activity")[1]


def early_and_late(f: Feeds) -> tuple[DataFrame, DataFrame]:
    events = f.events(wide=True)
    split = F.lit("1995-07-01").cast("date")
    return events.filter(F.col("FileDate") < split), events.filter(F.col("FileDate") >= split)


@query
def scd_agent_owner(f: Feeds) -> DataFrame:
    early, late = early_and_late(f)
    return dimensions.merge_agent_owners(dimensions.daily_agent_owners(early), dimensions.daily_agent_owners(late))


@query
def scd_agent(f: Feeds) -> DataFrame:
    """Agents of the early events, then those of all activity and the late events, which only the merges number."""
    early, late = map(owned_agents, early_and_late(f))
    owners = write_once(dimensions.daily_agent_owners(early), "owners")
    old = dimensions.daily_agents(f.activity(wide=True).filter(F.lit(False)), early, owners)
    merged = write_once(dimensions.merge_agent_owners(owners, dimensions.owner_names(late)), "owners")
    new = dimensions.with_owner(dimensions.agent_ids(f.activity(wide=True), late), late, merged)
    return dimensions.merge_agents(write_once(old, "agents"), new)


@query
def scd_content_type(f: Feeds) -> DataFrame:
    """The nameless ids a first run gave per activity, named by a second run over the extended mapping."""
    seeds = lookups.content_mapping(f.spark)
    old, mapping = dimensions.daily_content_types(f.base_activity, seeds, per="activity")
    new, _ = dimensions.daily_content_types(f.base_activity, write_once(mapping, "mapping"), per="activity")
    return dimensions.merge_content_types(old, new)


# --- daily facts ------------------------------------------------------------------------------------------------


def content_fact(f: Feeds, activity: DataFrame, agents: DataFrame, contents: DataFrame) -> DataFrame:
    return facts.daily_message_content(activity, lookups.natcos(f.spark), contents, agents)


@query
def fact_message_content_daily(f: Feeds) -> DataFrame:
    agents, contents = content_keys(f)
    return content_fact(f, f.base_activity, agents, contents)


@query
def fact_message_conversation_daily(f: Feeds) -> DataFrame:
    agents = base_agents(f)
    return facts.daily_message_conversation(f.base_events, lookups.natcos(f.spark), agents)


@query
def fact_conversation_sm_daily(f: Feeds) -> DataFrame:
    agents = base_agents(f)
    return facts.daily_conversations_and_sm(f.base_events, lookups.natcos(f.spark), agents)


# --- merges: the file of one date arrives after those of all other dates -----------------------------------------


def _empty(f: Feeds, table: str) -> DataFrame:
    return literal_table(f.spark, [], publish.SCHEMAS[table])


def old_and_new_content(f: Feeds) -> tuple[DataFrame, DataFrame]:
    agents, contents = content_keys(f)
    others = content_fact(f, off_day(f.base_activity, ACTIVITY_DAY), agents, contents)
    new = content_fact(f, on_day(f.base_activity, ACTIVITY_DAY), agents, contents)
    return merges.merge_message_content(_empty(f, "f_message_content"), others, BEFORE_ALL), new


@query
def merge_date_slice(f: Feeds) -> DataFrame:
    old, new = old_and_new_content(f)
    return merges.replace_date_slice(old, new, ACTIVITY_DAY)


@query
def merge_message_content(f: Feeds) -> DataFrame:
    old, new = old_and_new_content(f)
    return merges.merge_message_content(old, new, ACTIVITY_DAY)


@query
def merge_touched_dates(f: Feeds) -> DataFrame:
    """The same merge, aggregating the touched dates only."""
    old, new = old_and_new_content(f)
    return merges.merge_touched_dates(write_once(old, "fact"), new, ACTIVITY_DAY, merges.merge_message_content)


@query
def merge_message_conversation(f: Feeds) -> DataFrame:
    agents = base_agents(f)

    def fact(events: DataFrame) -> DataFrame:
        return facts.daily_message_conversation(events, lookups.natcos(f.spark), agents)

    empty = _empty(f, "f_message_conversation")
    old = merges.merge_message_conversation(empty, fact(off_day(f.base_events, EVENTS_DAY)), BEFORE_ALL)
    return merges.merge_message_conversation(old, fact(on_day(f.base_events, EVENTS_DAY)), EVENTS_DAY)


@query
def merge_conversation_sm(f: Feeds) -> DataFrame:
    agents = base_agents(f)

    def fact(events: DataFrame) -> DataFrame:
        return facts.daily_conversations_and_sm(events, lookups.natcos(f.spark), agents)

    empty = _empty(f, "f_conversations_and_sm")
    old = merges.merge_conversations_and_sm(empty, fact(off_day(f.base_events, EVENTS_DAY)), BEFORE_ALL)
    return merges.merge_conversations_and_sm(old, fact(on_day(f.base_events, EVENTS_DAY)), EVENTS_DAY)


# --- unique active users ----------------------------------------------------------------------------------------


def months_of(f: Feeds) -> DataFrame:
    return users.user_months(accumulator_of(f), lookups.natcos(f.spark))


@query
def uau_daily(f: Feeds) -> DataFrame:
    return users.uau_daily(months_of(f))


@query
def uau_monthly(f: Feeds) -> DataFrame:
    return users.uau_monthly(months_of(f))


@query
def uau_yearly(f: Feeds) -> DataFrame:
    return users.uau_yearly(months_of(f))


@query
def uau_total(f: Feeds) -> DataFrame:
    return users.uau_total(months_of(f))


def months_of_years(f: Feeds) -> DataFrame:
    return users.user_months(f.years(), lookups.natcos(f.spark))


@query
def uau_daily_years(f: Feeds) -> DataFrame:
    return users.uau_daily(months_of_years(f))


@query
def uau_monthly_years(f: Feeds) -> DataFrame:
    return users.uau_monthly(months_of_years(f))


@query
def uau_yearly_years(f: Feeds) -> DataFrame:
    return users.uau_yearly(months_of_years(f))


@query
def uau_total_years(f: Feeds) -> DataFrame:
    return users.uau_total(months_of_years(f))


@query
def uau_cross_natco(f: Feeds) -> DataFrame:
    return users.users_across_natcos(accumulator_of(f), lookups.natcos(f.spark))


# --- whole runs -------------------------------------------------------------------------------------------------


@query
def run_daily_all(f: Feeds) -> DataFrame:
    """One run over the state that all other runs left, reported as rows and a total per table."""
    activity, events = f.activity(early=True), f.events(joint=True)
    this_run = (F.col("FileDate") == F.lit(ACTIVITY_DAY).cast("date")) & (F.col("NatCo") == NATCO)
    lookup = daily.seed_lookups(f.spark)
    before = backfill.backfill(activity.filter(~this_run), events.filter(~this_run), lookup)

    def stored(table: str) -> DataFrame:
        df = before[table]
        return df.filter(F.col("NatCo") == NATCO) if table in publish.PER_NATCO else df

    names = list(daily.STATE_SCHEMAS)
    written = concurrently(
        *[partial(write_once, staging.conform(stored(t), daily.STATE_SCHEMAS[t]), t) for t in names],
        partial(write_once, before["ContentDescriptionMapping"], "mapping"),
    )
    state, contents = daily.State(**dict(zip(names, written))), written[-1]
    lookup = daily.Lookups(lookup.natcos, lookup.conversation_types, contents)
    results = daily.run_day(activity.filter(this_run), events.filter(this_run), lookup, state, ACTIVITY_DAY, NATCO)

    total = {
        "f_message_content": "MTMO_MessagesByType",
        "f_conversations_and_sm": "NoOfConv",
        "f_message_conversation": "MTMO_messages",
        "f_uau_daily": "UAU_daily",
        "f_uau_monthly": "UAU_monthly",
        "f_uau_yearly": "UAU_yearly",
        "f_uau_total": "UAU_total",
        "acc_users_daily": "AgentID",
        "d_agent": "AgentID",
        "d_agent_owner": "AgentOwnerID",
        "d_natco": "NatCoID",
        "d_conversation_type": "TypeOfConvID",
        "d_content_type": "ContentID",
        "ContentDescriptionMapping": "ContentID",
    }
    report = None
    for table, df in results.items():
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(total[table]).cast("bigint").alias("total"))
        row = row.select(F.lit(table).alias("table_name"), "n_rows", "total")
        report = row if report is None else report.unionByName(row)
    return report


def digests(f: Feeds, wide: bool = False) -> tuple[DataFrame, DataFrame]:
    activity, events = f.activity(early=True, wide=wide), f.events(joint=True, wide=wide)
    messages, billed = concurrently(
        lambda: write_once(facts.digest_activity(activity), "messages"),
        lambda: write_once(facts.digest_events(events), "billed"),
    )
    return messages, billed


def backfilled_dims(messages: DataFrame, billed: DataFrame) -> tuple[DataFrame, DataFrame]:
    owners = write_once(backfill.agent_owners(billed), "owners")
    return owners, write_once(backfill.agents_by_first_run(messages, billed, owners), "agents")


@query
def backfill_dims(f: Feeds) -> DataFrame:
    _, agents = backfilled_dims(*digests(f, wide=True))
    return agents.select("AgentID", "AgentOwnerID", "Agent")


@query
def backfill_dims_owner(f: Feeds) -> DataFrame:
    return backfill.agent_owners(digests(f, wide=True)[1])


@query
def backfill_dims_content(f: Feeds) -> DataFrame:
    return backfill.content_types(digests(f)[0], lookups.content_mapping(f.spark))[0]


@query
def backfill_facts(f: Feeds) -> DataFrame:
    messages, billed = digests(f)
    (_, agents), contents, runs = concurrently(
        lambda: backfilled_dims(messages, billed),
        lambda: write_once(backfill.content_types(messages, lookups.content_mapping(f.spark))[0], "contents"),
        lambda: write_once(backfill.runs_of(messages, billed), "runs"),
    )
    return backfill.message_content(messages, runs, lookups.natcos(f.spark), contents, agents)


@query
def backfill_facts_conversation(f: Feeds) -> DataFrame:
    messages, billed = digests(f)
    (_, agents), runs = concurrently(
        lambda: backfilled_dims(messages, billed), lambda: write_once(backfill.runs_of(messages, billed), "runs")
    )
    return backfill.message_conversation(billed, runs, lookups.natcos(f.spark), agents)


@query
def backfill_average_duration(f: Feeds) -> DataFrame:
    messages, billed = digests(f)
    (_, agents), runs = concurrently(
        lambda: backfilled_dims(messages, billed), lambda: write_once(backfill.runs_of(messages, billed), "runs")
    )
    return backfill.conversations_and_sm(billed, runs, lookups.natcos(f.spark), agents)


@query
def backfill_users(f: Feeds) -> DataFrame:
    _, agents = backfilled_dims(*digests(f))
    accumulator = backfill.user_accumulator(f.activity(early=True), agents)
    return users.uau_daily(users.user_months(accumulator, lookups.natcos(f.spark), ["NatCo"]), ["NatCo"])


def onto_state(f: Feeds, table: str, wide: bool = False) -> DataFrame:
    """A table after a backfill of the dates up to one, and then of the later dates onto the state that it left."""
    activity, events = f.activity(early=True, wide=wide), f.events(joint=True, wide=wide)
    first = F.col("FileDate") <= F.lit(ACTIVITY_DAY).cast("date")
    lookup = daily.seed_lookups(f.spark)
    before = backfill.backfill(activity.filter(first), events.filter(first), lookup)
    names = list(daily.STATE_SCHEMAS)
    written = concurrently(
        *[partial(write_once, before[t], t) for t in names], partial(write_once, before["ContentDescriptionMapping"], "mapping")
    )
    lookup = daily.Lookups(lookup.natcos, lookup.conversation_types, written[-1])
    state = dict(zip(names, written))
    return backfill.backfill(activity.filter(~first), events.filter(~first), lookup, state=state)[table]


@query
def backfill_onto_state_facts(f: Feeds) -> DataFrame:
    return onto_state(f, "f_message_content")


@query
def backfill_onto_state_average_duration(f: Feeds) -> DataFrame:
    return onto_state(f, "f_conversations_and_sm")


@query
def backfill_onto_state_dims(f: Feeds) -> DataFrame:
    return onto_state(f, "d_agent", wide=True)


@query
def backfill_onto_state_users(f: Feeds) -> DataFrame:
    return onto_state(f, "f_uau_daily")
