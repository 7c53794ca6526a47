"""Exact half-even means of numbers with two decimals.

Averaging such numbers as doubles decides a tie by floating-point noise and by the order of summation. Whole
hundredths decide it exactly, whatever the partitioning.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def hundredths(column: Column) -> Column:
    return F.bround(column * F.lit(100), 0).cast("bigint")


def half_even_quotient(total: Column, count: Column) -> Column:
    """``total / count`` rounded to a whole number, ties to the even one; null when ``count`` is 0."""
    size = F.when(count != 0, count)
    rest = F.pmod(total, size)
    whole = F.call_function("div", total - rest, size)
    up = (rest * 2 > size) | ((rest * 2 == size) & (F.pmod(whole, F.lit(2)) == 1))
    return whole + F.when(up, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def from_hundredths(column: Column) -> Column:
    return column / F.lit(100.0)
