"""Accumulating facts: replace the slice of a file date, then aggregate again so that late rows are absorbed.

Rows are not sorted here: publishing as delimited text sorts them by date, and stored Parquet needs no order.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from palaver.functions.rounding import from_hundredths, half_even_quotient, hundredths
from palaver.functions.text import from_decimal_comma, to_date, to_decimal_comma
from palaver.workspace import write_once

CONTENT_KEYS = ["Date", "NatCoID", "ContentID", "AgentID"]
CONTENT_SUMS = ["MT_MessagesByType", "MO_MessagesByType", "MTMO_MessagesByType"]
CONVERSATION_KEYS = ["Date", "NatCoID", "AgentID", "TypeOfConvID"]
CONVERSATION_SUMS = ["MO_messages", "MT_messages", "MTMO_messages"]
SM_SUMS = ["NoOfConv", "NoOfSM", "NoOfBM"]


def _file_day(file_date: str) -> Column:
    return F.lit(file_date).cast("date")


def _typed(fact: DataFrame) -> DataFrame:
    """Date as a date and TypeOfConvID as text, whichever the stored and the daily fact hold."""
    fact = fact.withColumn("Date", to_date("Date"))
    if "TypeOfConvID" in fact.columns:
        fact = fact.withColumn("TypeOfConvID", F.col("TypeOfConvID").cast("string"))
    return fact


def replace_date_slice(old: DataFrame, new: DataFrame, file_date: str) -> DataFrame:
    """Old rows of other dates and all new rows. Old rows without a date are dropped, new ones are kept."""
    kept = _typed(old).filter(F.col("Date") != _file_day(file_date))
    return kept.unionByName(_typed(new).select(*kept.columns))


def _sum_again(rows: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in sums])


def merge_message_content(old: DataFrame, new: DataFrame, file_date: str) -> DataFrame:
    return _sum_again(replace_date_slice(old, new, file_date), CONTENT_KEYS, CONTENT_SUMS)


def merge_message_conversation(old: DataFrame, new: DataFrame, file_date: str) -> DataFrame:
    return _sum_again(replace_date_slice(old, new, file_date), CONVERSATION_KEYS, CONVERSATION_SUMS)


def in_hundredths(fact: DataFrame) -> DataFrame:
    """AverageDuration as whole hundredths, from a number or from decimal-comma text."""
    text = isinstance(fact.schema["AverageDuration"].dataType, StringType)
    value = from_decimal_comma("AverageDuration") if text else F.col("AverageDuration")
    return fact.withColumn("AverageDuration", hundredths(value))


def merge_conversations_and_sm(old: DataFrame, new: DataFrame, file_date: str) -> DataFrame:
    """Sum the counts; AverageDuration becomes the unweighted mean of the means that meet under one key."""
    rows = replace_date_slice(in_hundredths(old), in_hundredths(new), file_date)
    mean = half_even_quotient(F.sum("AverageDuration"), F.count("AverageDuration"))
    return (
        rows.groupBy(*CONVERSATION_KEYS)
        .agg(mean.alias("AverageDuration"), *[F.sum(c).cast("bigint").alias(c) for c in SM_SUMS])
        .withColumn("AverageDuration", to_decimal_comma(from_hundredths(F.col("AverageDuration"))))
    )


def mean_over_files(files: Column) -> Column:
    """The mean in hundredths that a list of files (FileDate, total, n) leaves: each file's means are averaged with the
    mean stored before it, and rounded again."""
    return F.aggregate(
        F.sort_array(files),
        F.lit(None).cast("bigint"),
        lambda stored, file: F.when(stored.isNull(), half_even_quotient(file["total"], file["n"])).otherwise(
            half_even_quotient(stored + F.coalesce(file["total"], F.lit(0)), file["n"] + 1)
        ),
    )


def touched_dates(file_date: str, *frames: DataFrame) -> DataFrame:
    """The dates that a file's rows fall on, and its own. Written, so that Spark sees how few they are."""
    spark = frames[0].sparkSession
    dates = spark.range(1).select(_file_day(file_date).alias("Date"))
    for frame in frames:
        dates = dates.unionByName(frame.select(to_date("Date").alias("Date")))
    return write_once(dates.filter(F.col("Date").isNotNull()).distinct(), "dates")


def merge_touched_dates(
    old: DataFrame,
    new: DataFrame,
    file_date: str,
    merge: Callable[[DataFrame, DataFrame, str], DataFrame],
    touched: DataFrame | None = None,
) -> DataFrame:
    """The same rows as ``merge``, for a stored ``old`` that ``merge`` itself produced.

    Dates the new file does not touch are already aggregated: they pass through without a shuffle, and only the few
    touched dates are aggregated again. ``touched`` may name more dates than ``new`` has, never fewer.
    """
    touched = touched_dates(file_date, new) if touched is None else touched
    stored = _typed(old)
    untouched = stored.filter(F.col("Date").isNotNull()).join(touched, "Date", "left_anti")
    merged = merge(stored.join(touched, "Date", "left_semi"), new, file_date)
    return untouched.select(*merged.columns).unionByName(merged)
