"""Accumulating facts kept by file: what each file adds to a date is stored, and a date is summed over its files.

A file that is run again replaces what its earlier version added, on the dates of both versions, and adds nothing twice.
Whatever the order of the runs, the facts are those of every file run once, by date, as in the closed form of a backfill:
on a date whose own file was run, files of earlier dates do not count, and rows without a date count from the last file.
"""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.functions.rounding import from_hundredths
from palaver.functions.text import to_date, to_decimal_comma
from palaver.operators.merges import (
    CONTENT_KEYS,
    CONTENT_SUMS,
    CONVERSATION_KEYS,
    CONVERSATION_SUMS,
    SM_SUMS,
    in_hundredths,
    mean_over_files,
)

UNDATED = "none"
#: The table of contributions that a fact is summed from.
BY_FILE = {
    "f_message_content": "c_message_content",
    "f_message_conversation": "c_message_conversation",
    "f_conversations_and_sm": "c_conversations_and_sm",
}
_COUNTED = {"f_message_content": (CONTENT_KEYS, CONTENT_SUMS), "f_message_conversation": (CONVERSATION_KEYS, CONVERSATION_SUMS)}
_DURATION = ["DurationTotal", "DurationCount"]


@dataclass(frozen=True)
class StoredFiles:
    """What a run takes over. ``dates`` are those it makes anew (``none`` for rows without one): the dates of its file, of
    the file's earlier version, and of no date. ``others`` holds, by fact, what other files add to them and ``facts`` what
    was stored before contributions were; ``counting`` names the dates on which the file's own rows count."""

    dates: tuple[str, ...]
    counting: tuple[str, ...]
    others: dict[str, DataFrame]
    facts: dict[str, DataFrame]
    #: Entries to be listed with the run when contributions start over from the stored facts.
    entries: tuple[tuple, ...] = ()


def counts(file_date: str, date: str, processed: Iterable[str]) -> bool:
    """Whether what a file adds to a date is part of the fact, once the files of ``processed`` dates have been run."""
    processed = set(processed)
    return file_date == max(processed) if date == UNDATED else date not in processed or file_date >= date


def by_file(fact: DataFrame, name: str, file_date: str | None) -> DataFrame:
    """The rows of a fact as contributions of a file, one per key; without a file date, as stored before any."""
    rows = fact.withColumn("Date", to_date("Date"))
    if "TypeOfConvID" in rows.columns:
        rows = rows.withColumn("TypeOfConvID", F.col("TypeOfConvID").cast("string"))
    if name in _COUNTED:
        keys, sums = _COUNTED[name]
        added = [F.sum(c).cast("bigint").alias(c) for c in sums]
    else:
        keys, rows = CONVERSATION_KEYS, in_hundredths(rows)
        means = F.sum("AverageDuration").cast("bigint"), F.count("AverageDuration")
        added = [x.alias(c) for x, c in zip(means, _DURATION)] + [F.sum(c).cast("bigint").alias(c) for c in SM_SUMS]
    file = F.lit(file_date).cast("date").alias("FileDate")
    return rows.groupBy(*keys).agg(*added).select(file, "*")


def over_files(rows: DataFrame, name: str) -> DataFrame:
    """The fact: counts are summed over the files of a key, mean durations are folded in the order of file dates.

    A key has one row per file that touched its date, so a list of means is as long as a date has files.
    """
    if name in _COUNTED:
        keys, sums = _COUNTED[name]
        return rows.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in sums])
    files = F.collect_list(F.struct("FileDate", F.col(_DURATION[0]).alias("total"), F.col(_DURATION[1]).alias("n")))
    summed = rows.groupBy(*CONVERSATION_KEYS).agg(files.alias("files"), *[F.sum(c).cast("bigint").alias(c) for c in SM_SUMS])
    duration = to_decimal_comma(from_hundredths(mean_over_files(F.col("files")))).alias("AverageDuration")
    return summed.select(*CONVERSATION_KEYS, duration, *SM_SUMS)


def on_dates(rows: DataFrame, dates: Iterable[str]) -> DataFrame:
    dates = set(dates)
    dated: Column = F.col("Date").isin([F.lit(d).cast("date") for d in sorted(dates - {UNDATED})])
    return rows.filter(F.col("Date").isNull() | dated if UNDATED in dates else F.coalesce(dated, F.lit(False)))


def fact_of_files(name: str, own: DataFrame, stored: StoredFiles) -> DataFrame:
    """A fact on the dates that a run makes anew, from the contributions of its file and what is stored of the others."""
    before = by_file(stored.facts[name], name, None)
    rows = on_dates(own, stored.counting).unionByName(stored.others[name]).unionByName(before)
    return over_files(rows, name)
