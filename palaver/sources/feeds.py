"""The two gzip TSV feeds, whose date and NatCo are known from the file name only, and the per-NatCo accumulators."""

import re
from collections.abc import Iterable
from fnmatch import fnmatchcase
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from palaver import schemas
from palaver.functions.text import to_date
from palaver.sources.delimited import SEMICOLONS, SOURCE, TABS, read_and_quarantine, read_delimited
from palaver.workspace import literal_table, matching

# Names of the feed files and of the accumulators.
FEED_NAME = {
    "activity": "rbm_activity_{date}.csv_{natco}.csv.gz",
    "events": "rbm_billable_events_{date}.csv_{natco}.csv.gz",
}
ACCUMULATOR_NAME = "acc_users_daily_{natco}.csv"

Feed = Literal["activity", "events"]
_TAGS = [StructField("NatCo", StringType()), StructField("FileDate", DateType())]
_SCHEMA: dict[str, StructType] = {"activity": schemas.ACTIVITY, "events": schemas.EVENTS}


def feed_file(feed: Feed, file_date: str, natco: str) -> str:
    return FEED_NAME[feed].format(date=file_date, natco=natco)


def present(
    spark: SparkSession,
    folder: str,
    feed: Feed,
    file_dates: Iterable[str] = ("*",),
    natcos: Iterable[str] = ("*",),
    prefix: str = "",
) -> list[tuple[str, str, str]]:
    """File date, NatCo and path of the requested files that are there. The folder is listed once."""
    dates, names = list(file_dates), list(natcos)
    head, tail = (re.escape(part) for part in FEED_NAME[feed].split("{date}"))
    name = re.compile(re.escape(prefix) + head + r"(\d{4}-\d{2}-\d{2})" + tail.replace(re.escape("{natco}"), "([^./]+)") + "$")
    found = []
    for path in matching(spark, f"{folder.rstrip('/')}/{prefix}{feed_file(feed, '*', '*')}"):
        match = name.search(path)
        if match and any(fnmatchcase(match[1], d) for d in dates) and any(fnmatchcase(match[2], n) for n in names):
            found.append((match[1], match[2], path))
    return sorted(found)


def read_feed(
    spark: SparkSession,
    folder: str,
    feed: Feed,
    file_dates: Iterable[str] = ("*",),
    natcos: Iterable[str] = ("*",),
    bad_records_path: str | None = None,
    prefix: str = "",
) -> DataFrame:
    """Read any number of feed files in one scan; FileDate and NatCo come from each file's name.

    With a quarantine folder the rows come from a working table, else from the text: a gzip file cannot be split, so a file
    is one task. Land feeds that are read more than once. A name may also be a folder of files; ``prefix`` is text before
    the name, such as ``file=`` where Spark wrote the folders. Requested files that are not there are passed over
    (``present`` tells which are).
    """
    paths = [path for _, _, path in present(spark, folder, feed, file_dates, natcos, prefix)]
    if not paths:
        return literal_table(spark, [], StructType([*_SCHEMA[feed], *_TAGS]))
    named = FEED_NAME[feed].replace(".", r"\.").format(date=r"(\d{4}-\d{2}-\d{2})", natco="([^./]+)")
    if bad_records_path is None:
        rows, source = read_delimited(spark, paths, _SCHEMA[feed], TABS), F.col("_metadata.file_path")
    else:
        rows, source = read_and_quarantine(spark, paths, _SCHEMA[feed], bad_records_path, TABS), F.col(SOURCE)
    return rows.select(
        *_SCHEMA[feed].names,
        F.regexp_extract(source, named, 2).alias("NatCo"),
        to_date(F.regexp_extract(source, named, 1)).alias("FileDate"),
    )


def land_feed(feed: DataFrame, path: str) -> DataFrame:
    """Store a feed as Parquet by FileDate and NatCo, replacing only the slices it holds, and return the stored table.

    REBALANCE sizes the files: it joins small slices' tasks and splits a slice that holds much of the data.
    """
    (
        feed.hint("rebalance", "FileDate", "NatCo")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("FileDate", "NatCo")
        .parquet(path)
    )
    return feed.sparkSession.read.schema(feed.schema).parquet(path).select(*feed.columns)


def read_accumulators(spark: SparkSession, folder: str, natco: str = "*", prefix: str = "") -> DataFrame:
    """The accumulators of all NatCos in one scan."""
    path = f"{folder.rstrip('/')}/{prefix}{ACCUMULATOR_NAME.format(natco=natco)}"
    return read_delimited(spark, path, schemas.USER_ACCUMULATOR, SEMICOLONS)
