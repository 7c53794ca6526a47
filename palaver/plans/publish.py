"""Publishing: results go to a new version, which becomes current by one final append to the list of published tables.

A run never writes a path it reads. A run that dies leaves no trace in the list, and can simply be repeated. An empty
result is not listed, so the table published before it stays current. The accumulator is listed by slices, one for each
file date of a NatCo: a run writes the slices it processed and lists them, also an empty one. The accumulating facts are
listed by slices as well, one for each date of a NatCo: a run reads and writes those of the dates its files touch. Users
are kept and counted in slices by month and by year.

Runs may be under way at the same time. An append is a file with the next number, which is put in place by a rename that
fails if another run was first (as HDFS does; object stores without such a rename need one run at a time). Before it, a run
compares what it read with what is current by then, and is done again on the new state if that has changed. Shared tables
are listed only if their rows have changed, so runs of several NatCos meet only where one of them has new keys.
"""

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import partial, reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from palaver import schemas
from palaver.operators.contributions import BY_FILE, StoredFiles, counts
from palaver.operators.staging import conform
from palaver.operators.user_months import UNDATED, StoredUsers, file_months, month_name, year_of
from palaver.plans.daily import STATE_SCHEMAS, Lookups, State, seed_lookups
from palaver.sources.delimited import SEMICOLONS, read_delimited, write_delimited
from palaver.workspace import concurrently, literal_table, matching, remove

# Which tables are kept per NatCo, and which belong to the lookups of the next run.
PER_NATCO = (
    "f_message_content",
    "f_conversations_and_sm",
    "f_message_conversation",
    "f_uau_daily",
    "f_uau_monthly",
    "f_uau_yearly",
    "f_uau_total",
    "acc_users_daily",
    "acc_user_months",
    "acc_user_years",
    *BY_FILE.values(),
)
LOOKUP_TABLES = ("acc_users_daily", "acc_user_months", "acc_user_years", "ContentDescriptionMapping")

SCHEMAS = {
    **STATE_SCHEMAS,
    "d_natco": schemas.NATCO,
    "d_conversation_type": schemas.CONVERSATION_TYPE,
    "f_uau_daily": schemas.UAU_DAILY,
    "f_uau_monthly": schemas.UAU_MONTHLY,
    "f_uau_yearly": schemas.UAU_YEARLY,
    "f_uau_total": schemas.UAU_TOTAL,
    "f_uau": schemas.UAU,
    "acc_user_months": schemas.USER_MONTHS,
    "acc_user_years": schemas.USER_YEARS,
    "ContentDescriptionMapping": schemas.CONTENT_MAPPING,
    "c_message_content": schemas.MESSAGE_CONTENT_BY_FILE,
    "c_message_conversation": schemas.MESSAGE_CONVERSATION_BY_FILE,
    "c_conversations_and_sm": schemas.CONVERSATIONS_AND_SM_BY_FILE,
}

ACCUMULATOR = "acc_users_daily"
# Facts in slices by Date. Rows without a date are a slice of their own, which every run replaces.
DATED = ("f_message_content", "f_conversations_and_sm", "f_message_conversation")
# Tables in slices by month and by year, likewise.
USER_MONTHS, USER_YEARS = "acc_user_months", "acc_user_years"
BY_MONTH = ("f_uau_daily", "f_uau_monthly", USER_MONTHS)
BY_YEAR = ("f_uau_yearly", USER_YEARS)
# Listed with the user months by a run that has brought them up to its own slice of the accumulator.
COVERED = "covered"
# Contributions are in slices named by file date and date. With them, entries of the files that were run so far and, under a
# name of their own, of the facts that were stored before.
_FILES, _RUN = "c_files", "run"
# The format of a slice whose path holds others too: its rows are told by the column that names the slice.
SHARED = "shared"
_LIST = "_published"
# slice: the file date of a slice of the accumulator, or the date, month or year of a slice of another table; null for a
# whole table. An empty slice has no path.
# commit: the number of the append, null in lists from before appends were numbered.
_LIST_SCHEMA = StructType(
    [*(StructField(c, StringType()) for c in ("name", "version", "path", "format", "slice")), StructField("commit", LongType())]
)


def table_name(table: str, natco: str) -> str:
    return f"{table}_{natco}" if table in PER_NATCO else table


def slice_column(table: str) -> Column:
    """The column whose text names a row's slice; null for the slice of rows without a date."""
    if table in BY_YEAR:
        return F.col("Year")
    if table in BY_MONTH:
        return F.col("YearMonth") if table == "f_uau_monthly" else month_name("Month" if table == USER_MONTHS else "Date")
    return F.col("FileDate" if table == ACCUMULATOR else "Date")


def _sort_columns(table: str) -> list[str]:
    """Columns in order, but a table kept by date starts with its date."""
    names = SCHEMAS[table].names
    lead = [c for c in ("FileDate", "Date") if c in names]
    return lead + [c for c in names if c not in lead]


def _write(df: DataFrame, table: str, path: str, as_csv: bool) -> bool:
    """Write one table and tell whether it has rows. The plan runs once: rows are looked for in what was written."""
    if as_csv:
        write_delimited(df, path, SEMICOLONS, sort_by=_sort_columns(table))
    else:
        df.write.mode("errorifexists").parquet(path)
    return not _read(df.sparkSession, table, path, "csv" if as_csv else "parquet").isEmpty()


class Superseded(Exception):
    """Something that a run has read was replaced before the run was published."""


@dataclass(frozen=True)
class Snapshot:
    """What is current at one moment."""

    entries: tuple[Row, ...]

    def read_by(self, natcos: Iterable[str]) -> set[tuple]:
        """The entries that runs of these NatCos read."""
        names = {table_name(table, natco) for natco in natcos for table in (*STATE_SCHEMAS, "ContentDescriptionMapping")}
        return {(row["name"], row["slice"], row["version"], row["path"]) for row in self.entries if row["name"] in names}

    def path(self, name: str) -> tuple[str, str] | None:
        """Path and format of a whole table."""
        return next(((row["path"], row["format"]) for row in self.entries if row["name"] == name and row["slice"] is None), None)


def snapshot(spark: SparkSession, output_path: str) -> Snapshot:
    return Snapshot(tuple(published(spark, output_path).collect()))


def _commit(
    spark: SparkSession, output_path: str, entries: list[tuple], since: Snapshot | None = None, natcos: Iterable[str] = ()
) -> list[str]:
    """Append to the list, unless what the runs of ``natcos`` read in ``since`` is no longer current.

    An entry may bring the number of an earlier append, as which it then counts.
    """
    folder, natcos = f"{output_path.rstrip('/')}/{_LIST}", set(natcos)
    while True:
        # The number comes first: an append that the comparison does not see has taken it.
        taken = [int(path.rpartition("-")[2].removesuffix(".json")) for path in matching(spark, f"{folder}/commit-*.json")]
        number = max(taken, default=0) + 1
        if since is not None and snapshot(spark, output_path).read_by(natcos) != since.read_by(natcos):
            raise Superseded
        numbered = [entry if len(entry) == len(_LIST_SCHEMA) else (*entry, number) for entry in entries]
        lines = [json.dumps(dict(zip(_LIST_SCHEMA.names, entry))) for entry in numbered]
        if _put_if_absent(spark, f"{folder}/commit-{number:09d}.json", "\n".join(lines)):
            return sorted({name for name, *_ in entries})


def _put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, and tell whether it was the first of its name."""
    hadoop, folder = spark._jvm.org.apache.hadoop.fs, path.rpartition("/")[0]
    draft, place = hadoop.Path(f"{folder}/.draft-{uuid.uuid4().hex}"), hadoop.Path(path)
    configuration = spark._jsc.hadoopConfiguration()
    files = draft.getFileSystem(configuration)
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(files.makeQualified(draft).toUri(), configuration).rename(
            files.makeQualified(draft), files.makeQualified(place), plain
        )
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False
    return True


def _same_rows(spark: SparkSession, table: str, *places: tuple[str, str]) -> bool:
    """Whether two stored tables have the same rows, by their number and the sum of their 64-bit hashes."""
    sums = [F.count(F.lit(1)), F.sum(F.xxhash64(*SCHEMAS[table].names).cast("decimal(38, 0)"))]
    found = [_read(spark, table, path, fmt).agg(*sums).first() for path, fmt in places]
    return found[0] == found[1]


def publish(
    results: dict[str, DataFrame],
    lookup_path: str,
    output_path: str,
    version: str,
    natco: str,
    file_date: str,
    as_csv: bool = False,
    since: Snapshot | None = None,
    dates: Iterable[str] | None = None,
    months: Iterable[str] | None = None,
    files: StoredFiles | None = None,
) -> list[str]:
    """Write the results of one run and make them current. Returns the names of the tables that were not empty.

    ``version`` is used once. As Parquet, of the accumulator only the slice of this run is written. As CSV every table is
    written whole, ``;``-separated and sorted. With ``since``, what was current when the run read its state, shared
    tables without a change are not listed again, and ``Superseded`` is raised if the state was replaced meanwhile; then
    nothing of the run is left. With ``dates``, the accumulating facts hold the rows of these dates only, and only their
    slices are written; so with ``files``, whose run lists what its file adds to each date as well. With ``months``, so do the users by month, and those by year hold the years of these.
    """
    spark = next(iter(results.values())).sparkSession
    unchanged = []
    touched: dict[str, list[str]] = {}
    if as_csv and files is not None:
        raise ValueError("facts kept by file are stored as Parquet")
    if files is not None:
        dates = [date for date in files.dates if date != UNDATED]
        touched |= {table: files.dates for table in BY_FILE.values()}
    if not as_csv and dates is not None:
        touched |= {table: [*dates, UNDATED] for table in DATED}
    if not as_csv and months is not None:
        touched |= {table: sorted({*months, UNDATED}) for table in BY_MONTH}
        touched |= {table: sorted({*map(year_of, months), UNDATED}) for table in BY_YEAR}

    def store(table: str) -> list[tuple]:
        root = (lookup_path if table in LOOKUP_TABLES else output_path).rstrip("/")
        name = table_name(table, natco)
        df = conform(results[table], SCHEMAS[table], strict=True)
        if table == ACCUMULATOR and not as_csv:
            today = df.filter(F.col("FileDate") == F.lit(file_date).cast("date"))
            path = f"{root}/{version}/{name}"
            today.write.mode("errorifexists").parquet(path)
            return [(name, version, path, "parquet", file_date)]
        if table in touched:
            entries = _store_slices(df, table, name, f"{root}/{version}/{name}", version, touched[table], since, f"{file_date}/" if table in BY_FILE.values() else "")
            return [*entries, (name, version, "", "parquet", COVERED)] if table == USER_MONTHS else entries
        path = f"{root}/{version}/{name}" + (".csv" if as_csv else "")
        filled, fmt = _write(df, table, path, as_csv), "csv" if as_csv else "parquet"
        before = since.path(name) if since and table not in PER_NATCO else None
        if filled and before and before[1] == fmt and _same_rows(spark, table, before, (path, fmt)):
            remove(spark, path)
            unchanged.append(name)
            return []
        return [(name, version, path, fmt, None)] if filled else []

    stored = concurrently(*[partial(store, table) for table in results])
    if files is not None:
        stored += [files.entries, [(f"{_FILES}_{natco}", version, _RUN, "parquet", file_date)]]
    try:
        names = _commit(spark, output_path, [entry for entries in stored for entry in entries], since, [natco])
    except Superseded:
        for root in {lookup_path.rstrip("/"), output_path.rstrip("/")}:
            remove(spark, f"{root}/{version}")
        raise
    apart = {f"{_FILES}_{natco}", *(f"before_{fact}_{natco}" for fact in BY_FILE)}
    return sorted({*names, *unchanged} - apart)


def _store_slices(
    df: DataFrame, table: str, name: str, path: str, version: str, touched: Iterable[str], since: Snapshot | None, prefix: str = ""
) -> list[tuple]:
    """Write slices of a table, one folder each, and return their entries; none if the whole table would be empty.

    The names of slices start with ``prefix``.
    """
    # Folders named by a copy of the column, so that the files hold all of them.
    named = df.withColumn("date_", slice_column(table).cast("string"))
    named.hint("rebalance", "date_").write.partitionBy("date_").parquet(path)
    stored = df.sparkSession.read.schema(SCHEMAS[table]).parquet(path)
    filled = {row["slice"] for row in stored.select(slice_column(table).cast("string").alias("slice")).distinct().collect()}
    places = {x: f"{path}/date_={x}" if x in filled else "" for x in touched}
    if None in filled:
        places[UNDATED] = f"{path}/date_=__HIVE_DEFAULT_PARTITION__"
    places = {f"{prefix}{x}": place for x, place in places.items()}
    others = [row for row in since.entries if row["name"] == name and row["slice"] not in places and row["path"]] if since else []
    if not filled and not others:
        return []
    return [(name, version, place, "parquet", x) for x, place in places.items()]


def publish_backfill(
    results: dict[str, DataFrame],
    lookup_path: str,
    output_path: str,
    version: str,
    runs: list[tuple[str, str]],
    since: Snapshot | None = None,
) -> list[str]:
    """Make the results of a backfill current for the NatCos of its ``runs`` (file date, NatCo), and for no other.

    With ``since``, ``Superseded`` is raised if what the backfill has read is no longer current.

    A table kept per NatCo is written in one job, one folder per NatCo; daily runs go on from there. Of the accumulator
    the slices of the runs are replaced.
    """
    spark = next(iter(results.values())).sparkSession
    natcos = sorted({natco for _, natco in runs})

    def store(table: str) -> list[tuple]:
        root = (lookup_path if table in LOOKUP_TABLES else output_path).rstrip("/")
        path = f"{root}/{version}/{table}"
        df = results[table]
        if table not in PER_NATCO:
            filled = _write(conform(df, SCHEMAS[table], strict=True), table, path, as_csv=False)
            return [(table, version, path, "parquet", None)] if filled else []
        if table == ACCUMULATOR:
            # Folders named by copies of the columns, so that the files hold all of them.
            named = conform(df, SCHEMAS[table], strict=True).withColumns({"natco_": F.col("NatCo"), "date_": F.col("FileDate")})
            named.hint("rebalance", "natco_", "date_").write.partitionBy("natco_", "date_").parquet(path)
            stored = spark.read.schema(SCHEMAS[table]).parquet(path)
            slices = stored.select(F.col("FileDate").cast("string").alias("date"), "NatCo").distinct()
            filled = {(r["date"], r["NatCo"]) for r in slices.collect()}
            return [
                (table_name(table, n), version, f"{path}/natco_={n}/date_={d}" if (d, n) in filled else "", "parquet", d)
                for d, n in runs
            ]
        typed = [F.col(c.name).cast(c.dataType).alias(c.name) for c in SCHEMAS[table]]
        df.select("NatCo", *typed).write.partitionBy("NatCo").parquet(path)
        written = spark.read.schema(df.select("NatCo").schema).parquet(path)
        filled = {r["NatCo"] for r in written.distinct().collect()}
        return [
            (table_name(table, natco), version, f"{path}/NatCo={natco}", "parquet", None)
            for natco in sorted(filled & set(natcos))
        ]

    stored = concurrently(*[partial(store, table) for table in results])
    return _commit(spark, output_path, [entry for entries in stored for entry in entries], since, natcos)


def publish_users(users: DataFrame, output_path: str, version: str) -> str:
    """Write the distinct users of all NatCos as text, sorted as they come, and make them current. Returns the path."""
    path = f"{output_path.rstrip('/')}/{version}/f_uau.csv"
    write_delimited(users, path, SEMICOLONS)
    _commit(users.sparkSession, output_path, [("f_uau", version, path, "csv", None)])
    return path


def published(spark: SparkSession, output_path: str) -> DataFrame:
    """The current version of every table and slice: name, version, path, format, slice, commit.

    A whole table that is newer than a slice of it takes the slice's place.
    """
    try:
        entries = spark.read.schema(_LIST_SCHEMA).json(f"{output_path.rstrip('/')}/{_LIST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        entries = literal_table(spark, [], _LIST_SCHEMA)
    entries = entries.withColumn("_at", F.struct(F.coalesce("commit", F.lit(0)).alias("commit"), "version"))
    latest = F.max_by(F.struct("version", "path", "format", "_at"), "_at").alias("latest")
    current = entries.groupBy("name", "slice").agg(latest).select("name", "latest.*", "slice", "latest._at.commit")
    whole = F.max(F.when(F.col("slice").isNull(), F.col("_at"))).over(Window.partitionBy("name"))
    current = current.withColumn("_whole", whole)
    return current.filter("slice is null or _whole is null or _at > _whole").drop("_whole", "_at")


def compact_list(spark: SparkSession, output_path: str) -> int:
    """Gather the list of published tables in one append that holds what is current, and return how many files went.

    For times when no run is under way.
    """
    folder = f"{output_path.rstrip('/')}/{_LIST}"
    gone = matching(spark, f"{folder}/commit-*.json")
    if len(gone) > 1:
        _commit(spark, output_path, [tuple(row[c] for c in _LIST_SCHEMA.names) for row in snapshot(spark, output_path).entries])
        for path in gone:
            remove(spark, path)
    return len(gone) if len(gone) > 1 else 0


def vacuum(spark: SparkSession, lookup_path: str, output_path: str) -> list[str]:
    """Delete what versions hold beside the current tables, and return the paths. For times when no run is under way."""

    def plain(path: str) -> str:
        return path.removeprefix("file:").rstrip("/").replace("///", "/")

    current = [plain(row["path"]) for row in published(spark, output_path).collect() if row["path"]]
    stored = [path for root in {lookup_path.rstrip("/"), output_path.rstrip("/")} for path in matching(spark, f"{root}/*/*")]
    stored = [path for path in stored if f"/{_LIST}/" not in path]
    unused = [path for path in stored if not any(f"{kept}/".startswith(f"{plain(path)}/") for kept in current)]
    versions = {row["version"] for row in published(spark, output_path).collect()}
    unused = [path for path in unused if path.split("/")[-2] <= max(versions, default="")]
    for path in unused:
        remove(spark, path)
    return sorted(unused)


def _read(spark: SparkSession, table: str, path: str | list[str], fmt: str) -> DataFrame:
    if fmt == "csv":
        return read_delimited(spark, path, SCHEMAS[table], SEMICOLONS)
    return spark.read.schema(SCHEMAS[table]).parquet(*([path] if isinstance(path, str) else path))


def load(
    spark: SparkSession,
    output_path: str,
    natco: str,
    seeds: Lookups | None = None,
    at: Snapshot | None = None,
    dates: Iterable[str] | None = None,
    files: Iterable[str] | None = None,
) -> tuple[Lookups, State]:
    """Lookups and state for the next run of ``natco``.

    A table that was never published is empty. The content mapping starts as that of ``seeds`` and is then the one the
    last run published. ``at``: what to take for current, else what is now. ``dates``: of the accumulating facts, the
    dates to read, else all. ``files``: of the accumulator, the file dates to read, else all.
    """
    listed = (at or snapshot(spark, output_path)).entries
    current = {row["name"]: row for row in listed}
    seeds = seeds or seed_lookups(spark)

    def table(name: str, otherwise: DataFrame | None = None) -> DataFrame:
        if name == ACCUMULATOR or name in DATED:
            own = [row for row in listed if row["name"] == table_name(name, natco)]
            return sliced(spark, name, own, dates if name in DATED else files)
        entry = current.get(table_name(name, natco))
        if entry is None:
            return literal_table(spark, [], SCHEMAS[name]) if otherwise is None else otherwise
        return _read(spark, name, entry["path"], entry["format"])

    state = State(**{name: table(name) for name in STATE_SCHEMAS})
    contents = table("ContentDescriptionMapping", seeds.contents)
    return Lookups(seeds.natcos, seeds.conversation_types, contents), state


def sliced(spark: SparkSession, table: str, entries: list, wanted: Iterable[str] | None = None) -> DataFrame:
    """The rows of the listed slices, in one scan, and of whole tables but for the slices that are newer.

    ``wanted``: the slices to read, else all; files of other slices are not opened.
    """
    wanted = None if wanted is None else set(wanted)
    found = [row for row in entries if row["path"] and row["slice"] is not None and (wanted is None or row["slice"] in wanted)]
    paths = [row["path"] for row in found if row["format"] != SHARED]
    rows = _read(spark, table, paths, "parquet") if paths else literal_table(spark, [], SCHEMAS[table])
    column, kind = slice_column(table), "int" if table in BY_YEAR else "string" if table in BY_MONTH else "date"

    def within(names: Iterable[str]) -> Column:
        return column.isin([F.lit(x).cast(kind) for x in sorted(set(names) - {UNDATED, COVERED})])

    gathered: dict[str, list[str]] = {}
    for row in found:
        if row["format"] == SHARED:
            gathered.setdefault(row["name"], []).append(row["slice"])
    for name, names in gathered.items():
        places = sorted({row["path"] for row in found if row["name"] == name and row["format"] == SHARED})
        rows = rows.unionByName(_read(spark, table, places, "parquet").filter(within(names)))
    for whole in (row for row in entries if row["slice"] is None):
        newer = [row["slice"] for row in entries if row["slice"] is not None and row["name"] == whole["name"]]
        stored = _read(spark, table, whole["path"], whole["format"])
        if set(newer) - {UNDATED, COVERED}:
            stored = stored.filter(column.isNull() | ~within(newer))
        if UNDATED in newer:
            stored = stored.filter(column.isNotNull())
        if wanted is not None:
            stored = stored.filter(within(wanted) | (column.isNull() if UNDATED in wanted else F.lit(False)))
        rows = rows.unionByName(stored)
    return rows


def current_table(spark: SparkSession, output_path: str, table: str, natco: str = "", at: Snapshot | None = None) -> DataFrame:
    """All current rows of a published table, kept whole or in slices; none if it was never published."""
    name = table_name(table, natco)
    return sliced(spark, table, [row for row in (at or snapshot(spark, output_path)).entries if row["name"] == name])


def users_covered(at: Snapshot, natco: str) -> bool:
    """Whether the stored user months stand for the current accumulator: no slice of it was listed after them.

    They do not after a backfill, a run that wrote text, or in folders from before user months were stored.
    """
    mark = [r["commit"] for r in at.entries if r["name"] == table_name(USER_MONTHS, natco) and r["slice"] == COVERED]
    return bool(mark) and all(r["commit"] <= mark[0] for r in at.entries if r["name"] == table_name(ACCUMULATOR, natco))


def load_users(spark: SparkSession, natco: str, at: Snapshot, accumulator: DataFrame, dates: Iterable[str]) -> StoredUsers:
    """The stored users for a run whose feeds hold ``dates``.

    ``accumulator`` is what ``load`` has read: the slice that the run replaces, whose months are touched too, if user months
    are stored, and all slices if they are not; then the run makes the user months of all of them, once.
    """
    own = {x: [row for row in at.entries if row["name"] == table_name(x, natco)] for x in (*BY_MONTH, *BY_YEAR)}
    before = accumulator.filter("FileDate is not null").select(month_name("Date").alias("month")).distinct().collect()
    touched = {date[:-3] for date in dates} | {row["month"] or UNDATED for row in before} | {UNDATED}
    if not users_covered(at, natco):
        # Slices that are listed from before are replaced as well, also those that turn out empty.
        touched |= {row["slice"] for x in BY_MONTH for row in own[x] if row["slice"] not in (None, COVERED)}
        years = literal_table(spark, [], SCHEMAS[USER_YEARS])
        return StoredUsers(tuple(sorted(touched)), file_months(accumulator), years, years)
    years = {year_of(month) for month in touched}
    others = {row["slice"] for row in own[USER_YEARS]} - years
    return StoredUsers(
        tuple(sorted(touched)),
        sliced(spark, USER_MONTHS, own[USER_MONTHS], touched),
        sliced(spark, USER_YEARS, own[USER_YEARS], years),
        sliced(spark, USER_YEARS, own[USER_YEARS], others),
    )


def load_files(spark: SparkSession, natco: str, at: Snapshot, file_date: str, dates: Iterable[str]) -> StoredFiles:
    """What is stored of the dates of a file, by the files that added it. Slices that do not count are not read.

    Which count is told by the list alone. If facts were written by another kind of run since (a backfill, a run that
    does not keep files), contributions start over: the stored facts stand for all files before, and count on a date
    until its own file is run.
    """

    def named(table: str) -> list[Row]:
        return [row for row in at.entries if row["name"] == f"{table}_{natco}"]

    marks, entries = named(_FILES), []
    facts = {fact: named(fact) for fact in BY_FILE}
    parts = {fact: [row for row in named(table) if row["path"]] for fact, table in BY_FILE.items()}
    before = {fact: named(f"before_{fact}") for fact in BY_FILE}
    covered = max((row["commit"] for row in marks), default=-1)
    if any(row["commit"] > covered for rows in facts.values() for row in rows):
        cleared = [*marks, *(row for rows in parts.values() for row in rows)]
        entries = [(row["name"], row["version"], "", "parquet", row["slice"]) for row in cleared]
        for fact, rows in facts.items():
            # With the commits they have: a slice stays newer than the whole table that it replaces a part of.
            columns = "version", "path", "format", "slice", "commit"
            entries += [(f"before_{fact}_{natco}", *(row[c] for c in columns)) for row in rows]
        marks, parts, before = [], dict.fromkeys(BY_FILE, []), facts

    processed = {row["slice"] for row in marks if row["path"]} | {file_date}
    earlier = {row["slice"].partition("/")[2] for rows in parts.values() for row in rows if row["slice"].startswith(f"{file_date}/")}
    touched = sorted({*dates, file_date, *earlier, UNDATED})

    def added_by_others(fact: str) -> DataFrame:
        paths = []
        for row in parts[fact]:
            file, _, date = row["slice"].partition("/")
            if file != file_date and date in touched and counts(file, date, processed):
                paths.append(row["path"])
        return _read(spark, BY_FILE[fact], paths, "parquet") if paths else literal_table(spark, [], SCHEMAS[BY_FILE[fact]])

    return StoredFiles(
        tuple(touched),
        tuple(date for date in touched if counts(file_date, date, processed)),
        {fact: added_by_others(fact) for fact in BY_FILE},
        {fact: sliced(spark, fact, before[fact], set(touched) - processed - {UNDATED}) for fact in BY_FILE},
        tuple(entries),
    )


def load_backfill(
    spark: SparkSession, output_path: str, natcos: list[str], seeds: Lookups, at: Snapshot | None = None
) -> tuple[Lookups, dict[str, DataFrame]]:
    """Lookups and state for a backfill of some NatCos: the shared dimensions, and their facts with NatCo as a column."""
    at = at or snapshot(spark, output_path)
    states = {natco: load(spark, output_path, natco, seeds, at) for natco in natcos}
    lookup, first = next(iter(states.values())) if states else load(spark, output_path, "", seeds, at)
    found = {name: getattr(first, name) for name in STATE_SCHEMAS if name not in PER_NATCO}
    for name in STATE_SCHEMAS:
        if name in PER_NATCO:
            parts = [getattr(state, name).withColumn("NatCo", F.lit(natco)) for natco, (_, state) in states.items()]
            found[name] = reduce(DataFrame.unionByName, parts)
    return lookup, found


def load_accumulators(spark: SparkSession, output_path: str) -> DataFrame:
    """The current accumulators of all NatCos, one scan of all slices."""
    entries = published(spark, output_path).filter(F.col("name").startswith(f"{ACCUMULATOR}_")).collect()
    return conform(sliced(spark, ACCUMULATOR, entries), schemas.USER_ACCUMULATOR)
