"""Column helpers for identifiers, dates and decimal-comma numbers. All stay inside generated JVM code."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_part(address: str | Column) -> Column:
    """The text before ``@``; the whole text when there is none."""
    return F.substring_index(address, "@", 1)


def day_part(moment: str | Column) -> Column:
    """The text before ``T`` of an ISO timestamp; still text, not checked to be a date."""
    return F.substring_index(moment, "T", 1)


def to_date(column: str | Column) -> Column:
    """Cast to a date; text that is no date becomes null instead of failing the job."""
    return (F.col(column) if isinstance(column, str) else column).try_cast("date")


def from_decimal_comma(column: str | Column) -> Column:
    return F.translate(column, ",", ".").try_cast("double")


def to_decimal_comma(column: Column) -> Column:
    return F.translate(column.cast("string"), ".", ",")
