"""User months that are stored and can take a file back, so that a run counts users from the months its file touches.

A row per (FileDate, Month, AgentID, user_id) has a bit for each day on which that file saw the user: replacing a file
replaces its rows and clears no day that another file has seen too. A row per (Year, AgentID, user_id) has a bit for each
active month, so a year is counted, and put right when a month changes, without its other months.
"""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.functions.text import to_date
from palaver.operators.facts import with_natco

UNDATED = "none"
_USER = ("NatCo", "AgentID", "user_id")


@dataclass(frozen=True)
class StoredUsers:
    """What a run takes over. ``touched`` names months (``yyyy-MM``, ``none`` for rows without a date); ``months`` holds
    the rows of these, ``years`` those of their years, and ``other_years`` those of all other years."""

    touched: tuple[str, ...]
    months: DataFrame
    years: DataFrame
    other_years: DataFrame


def year_of(month: str) -> str:
    return UNDATED if month == UNDATED else str(int(month[:-3]))


def month_name(date: str | Column) -> Column:
    """The name of a date's month; null without a date."""
    return F.date_format(date, "yyyy-MM")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.coalesce(place, F.lit(0)))


def file_months(accumulator: DataFrame) -> DataFrame:
    """One row per (FileDate, NatCo, Month, AgentID, user_id). ``Days`` has a bit per active day, bit 0 without a date."""
    rows = accumulator.select("FileDate", to_date("Date").alias("Date"), *_USER)
    by_month = rows.groupBy("FileDate", F.trunc("Date", "month").alias("Month"), *_USER)
    return by_month.agg(F.bit_or(_bit(F.dayofmonth("Date"))).alias("Days"))


def replace_file(stored: DataFrame, today: DataFrame, file_date: str) -> DataFrame:
    """The stored rows of other files, and those of ``today``. As in the accumulator, rows without a FileDate go."""
    others = stored.filter(F.col("FileDate") != F.lit(file_date).cast("date"))
    return others.unionByName(today)


def over_files(rows: DataFrame, d_natco: DataFrame) -> DataFrame:
    """The user months of all files: one row per (Month, NatCoID, AgentID, user_id), as ``users.user_months`` gives them."""
    by_month = with_natco(rows, d_natco).groupBy("Month", "NatCoID", "AgentID", "user_id")
    return by_month.agg(F.bit_or("Days").alias("Days"))


def replace_months(years: DataFrame, rows: DataFrame, touched: Iterable[str]) -> DataFrame:
    """One row per (NatCo, Year, AgentID, user_id) with a bit per active month, bit 0 without a date.

    The bits of ``touched`` months are cleared in ``years`` and set again by ``rows``, the rows of these months.
    """
    cleared: dict[str, int] = {}
    for month in touched:
        place = 0 if month == UNDATED else int(month[-2:])
        cleared[year_of(month)] = cleared.get(year_of(month), 0) | 1 << place
    mask = F.lit(0)
    for year, bits in cleared.items():
        mask = F.when(F.coalesce(F.col("Year").cast("string"), F.lit(UNDATED)) == year, F.lit(bits)).otherwise(mask)
    kept = years.select("Year", *_USER, F.col("Months").bitwiseAND(F.bitwise_not(mask.cast("bigint"))).alias("Months"))
    new = rows.select(F.year("Month").alias("Year"), *_USER, _bit(F.month("Month")).alias("Months"))
    merged = kept.filter("Months != 0").unionByName(new).groupBy("Year", *_USER)
    return merged.agg(F.bit_or("Months").alias("Months"))


def as_months(years: DataFrame, d_natco: DataFrame) -> DataFrame:
    """Rows by year in the form that ``users.uau_yearly`` and ``users.uau_total`` count: a month stands for its year."""
    return with_natco(years, d_natco).select(F.make_date("Year", F.lit(1), F.lit(1)).alias("Month"), "NatCoID", "AgentID", "user_id")
