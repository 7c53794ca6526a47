"""Exact unique active users by day, month, year and over all time.

The accumulator is shuffled once, to one row per user and month with a bit for each day the user was active. Days and
months are counted from those rows without a further distinct, years and the total by one distinct of them each.
Whatever is shuffled in bulk is keyed by user_id too, so a hot agent spreads over all reducers, after a map-side pass
has merged its repeats.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.functions.text import to_date
from palaver.operators.facts import with_natco

def _user_rows(accumulator: DataFrame, d_natco: DataFrame) -> DataFrame:
    return with_natco(accumulator.select("NatCo", to_date("Date").alias("Date"), "AgentID", "user_id"), d_natco)


def user_months(accumulator: DataFrame, d_natco: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per (Month, NatCoID, AgentID, user_id). ``Days`` has a bit per active day, bit 0 for rows without a date.

    ``by`` keeps further columns apart, such as NatCo when unmapped ones share the null NatCoID.
    """
    bit = F.coalesce(F.dayofmonth("Date"), F.lit(0))
    return (
        _user_rows(accumulator, d_natco)
        .groupBy(*by, F.trunc("Date", "month").alias("Month"), "NatCoID", "AgentID", "user_id")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("Days"))
    )


def uau_daily(months: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    # A column per bit in one aggregation of the months: user rows are not multiplied by the days of a month.
    active = [F.getbit("Days", F.lit(day)) == 1 for day in range(32)]
    counts = [F.count_if(on & F.col("user_id").isNotNull()).alias(f"_n{day}") for day, on in enumerate(active)]
    counted = months.groupBy(*by, "Month", "NatCoID", "AgentID").agg(F.bit_or("Days").alias("_days"), *counts)
    days = F.array(*[F.struct(F.lit(day).alias("day"), F.col(f"_n{day}").alias("n")) for day in range(32)])
    rows = counted.select(*by, "Month", "NatCoID", "AgentID", "_days", F.explode(days).alias("_day"))
    rows = rows.filter(F.getbit("_days", F.col("_day.day")) == 1)
    date = F.date_add("Month", F.col("_day.day") - 1)
    return rows.select(*by, date.alias("Date"), "NatCoID", "AgentID", F.col("_day.n").alias("UAU_daily"))


def uau_monthly(months: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    # One row per user and month already.
    named = months.withColumn("YearMonth", F.date_format("Month", "yyyy-MM"))
    return named.groupBy(*by, "YearMonth", "NatCoID", "AgentID").agg(F.count("user_id").alias("UAU_monthly"))


def uau_yearly(months: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    years = months.withColumn("Year", F.year("Month"))
    return years.groupBy(*by, "Year", "NatCoID", "AgentID").agg(F.count_distinct("user_id").alias("UAU_yearly"))


def uau_total(months: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return months.groupBy(*by, "NatCoID", "AgentID").agg(F.count_distinct("user_id").alias("UAU_total"))


def users_across_natcos(accumulators: DataFrame, d_natco: DataFrame) -> DataFrame:
    """Distinct (AgentID, NatCoID, Date, user_id) over all NatCos, newest date first.

    The other columns follow Date in the order, so that range partitioning can split a day that holds many rows.
    """
    return (
        _user_rows(accumulators, d_natco)
        .select("AgentID", "NatCoID", "Date", "user_id")
        .distinct()
        .orderBy(F.desc("Date"), "AgentID", "NatCoID", "user_id")
    )
