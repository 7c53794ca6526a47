"""The jobs one schedules: a daily file, the users of all NatCos, a backfill. All work on folders."""

from collections.abc import Iterable, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from palaver.operators.merges import touched_dates
from palaver.operators.staging import feeds_are_empty
from palaver.operators.users import users_across_natcos
from palaver.plans.backfill import NATCO_ORDER, backfill
from palaver.plans.daily import Lookups, day_digests, run_day, seed_lookups
from palaver.plans.publish import (
    Superseded,
    load,
    load_accumulators,
    load_backfill,
    load_files,
    load_users,
    publish,
    publish_backfill,
    publish_users,
    snapshot,
    users_covered,
)
from palaver.sources.feeds import Feed, read_feed
from palaver.workspace import run_folder, write_once


def new_version() -> str:
    return datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f")


def _land(
    spark: SparkSession,
    folder: str,
    feed: Feed,
    dates: Iterable[str],
    natcos: Iterable[str],
    bad_records_path: str | None = None,
) -> DataFrame:
    """Decompress the feed once. Every later step reads the columns it needs from splittable files."""
    rows = read_feed(spark, folder, feed, dates, natcos, bad_records_path)
    # With a quarantine the parse is stored already.
    return write_once(rows.hint("rebalance"), feed) if bad_records_path is None else rows


class DayRun:
    """One run in two steps: it is computed on what is current when it is made, and published when it is told to.

    If another run replaced what this one has read, it is computed again on the new state, from the same digests of its
    feeds, until it is published on the state that it was computed on. So runs at the same time end as if one had been
    after the other, in the order in which they were published. Of the accumulating facts, only the dates that the feeds
    touch are read, aggregated and written; the results hold these dates. Users are counted likewise, from stored months.
    With ``by_file`` facts are kept by the file that added to them, so that a file may be run again.
    """

    def __init__(
        self,
        activity: DataFrame,
        events: DataFrame,
        lookup_path: str,
        output_path: str,
        file_date: str,
        natco: str,
        seeds: Lookups | None = None,
        as_csv: bool = False,
        per: str = "type",
        by_file: bool = False,
    ):
        if by_file and as_csv:
            raise ValueError("facts kept by file are stored as Parquet")
        self.feeds, self.folders, self.run = (activity, events), (lookup_path, output_path), (file_date, natco)
        self.as_csv, self.per, self.by_file, self.spark = as_csv, per, by_file, activity.sparkSession
        self.seeds = seeds or seed_lookups(self.spark, lookup_path)
        self.digests = day_digests(activity, events, file_date, natco)
        # Text has no slices: a run that writes it reads and writes whole facts.
        self.dates = None if as_csv else sorted(str(row["Date"]) for row in touched_dates(file_date, *self.digests).collect())
        self.attempts = 0
        self._compute()

    def _compute(self) -> None:
        self.since = snapshot(self.spark, self.folders[1])
        day, natco = self.run
        files = [day] if self.dates is not None and users_covered(self.since, natco) else None
        lookup, state = load(self.spark, self.folders[1], natco, self.seeds, self.since, self.dates, files)
        users = None
        if self.dates is not None:
            users = load_users(self.spark, natco, self.since, state.acc_users_daily, self.dates)
        self.months = users and users.touched
        self.files = load_files(self.spark, natco, self.since, day, self.dates) if self.by_file else None
        self.results = run_day(*self.feeds, lookup, state, day, natco, self.per, self.digests, users, self.files)
        self.attempts += 1

    def publish(self) -> list[str]:
        """Make the results current. Returns the names of the tables that were not empty."""
        while True:
            try:
                day, natco = self.run
                return publish(
                    self.results, *self.folders, new_version(), natco, day, self.as_csv, self.since, self.dates, self.months, self.files
                )
            except Superseded:
                self._compute()


def process_day(
    spark: SparkSession,
    input_path: str,
    lookup_path: str,
    output_path: str,
    file_date: str,
    natco: str,
    seeds: Lookups | None = None,
    as_csv: bool = False,
    per: str = "type",
    bad_records_path: str | None = None,
    by_file: bool = False,
) -> list[str]:
    """Process the two files of one date and NatCo. Returns the published names, none when both are empty or absent.

    Lookups come from the files of ``lookup_path``, the built-in rows where it has none. Working tables are gone when
    the job ends. Several such jobs may run at the same time on one output folder. With ``by_file``, what the file adds to
    the accumulating facts is stored apart, and a file that is run again replaces it; without it, late rows add up again.
    """
    with run_folder(spark):
        activity = _land(spark, input_path, "activity", [file_date], [natco], bad_records_path)
        events = _land(spark, input_path, "events", [file_date], [natco], bad_records_path)
        if feeds_are_empty(activity, events):
            return []
        return DayRun(activity, events, lookup_path, output_path, file_date, natco, seeds, as_csv, per, by_file).publish()


def process_users(
    spark: SparkSession, output_path: str, seeds: Lookups | None = None, lookup_path: str | None = None
) -> str:
    """Write the distinct users of all NatCos, newest date first, make them current as f_uau, and return the path."""
    lookup = seeds or seed_lookups(spark, lookup_path)
    return publish_users(users_across_natcos(load_accumulators(spark, output_path), lookup.natcos), output_path, new_version())


def process_backfill(
    spark: SparkSession,
    input_path: str,
    lookup_path: str,
    output_path: str,
    file_dates: Sequence[str] = ("*",),
    natcos: Sequence[str] = ("*",),
    natco_order: Sequence[str] = NATCO_ORDER,
    seeds: Lookups | None = None,
    bad_records_path: str | None = None,
) -> list[str]:
    """Process the files of the given dates and NatCos as one job, and make the result current.

    The result is that of the runs one after another, by date and then NatCo, on what is published: ids stay, rows that
    no run replaces stay, and NatCos without a file are not touched. Files that are not there are passed over.
    """
    with run_folder(spark):
        activity = _land(spark, input_path, "activity", file_dates, natcos, bad_records_path)
        events = _land(spark, input_path, "events", file_dates, natcos, bad_records_path)
        found = activity.select("FileDate", "NatCo").unionByName(events.select("FileDate", "NatCo")).distinct()
        runs = sorted((str(row["FileDate"]), row["NatCo"]) for row in found.collect())
        if not runs:
            return []
        seeds = seeds or seed_lookups(spark, lookup_path)
        while True:
            since = snapshot(spark, output_path)
            lookup, state = load_backfill(spark, output_path, sorted({n for _, n in runs}), seeds, since)
            results = backfill(activity, events, lookup, natco_order, state=state)
            try:
                return publish_backfill(results, lookup_path, output_path, new_version(), runs, since)
            except Superseded:
                continue
