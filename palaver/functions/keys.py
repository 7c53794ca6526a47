"""Dense surrogate keys without a single-task window."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.workspace import write_once

_RANGE = "_key_range"


def max_id(table: DataFrame, id_column: str) -> Column:
    """The highest id of ``table`` as a scalar subquery, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint")).scalar()


def number_rows(
    rows: DataFrame, order: list[str], id_column: str, after: Column | int = 0
) -> DataFrame:
    """Add ``id_column`` = ``after`` + 1, 2, ... in ascending ``order``, nulls first.

    Spark range-partitions the rows by ``order``; the written table fixes which range each row fell into, so that
    counting the ranges and numbering inside them see the same ranges. Every range is numbered by its own task, and
    only one count per range is summed in one place.
    """
    ranged = rows.repartitionByRange(*order).withColumn(_RANGE, F.spark_partition_id())
    stored = write_once(ranged, "keys")

    sizes = stored.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_rows"))
    up_to_here = Window.partitionBy(F.lit(0)).orderBy(_RANGE)
    starts = sizes.select(_RANGE, (F.sum("_rows").over(up_to_here) - F.col("_rows")).alias("_start"))

    within = Window.partitionBy(_RANGE).orderBy(*order)
    first = after if isinstance(after, Column) else F.lit(after).cast("bigint")
    return (
        stored.withColumn("_rank", F.row_number().over(within))
        .join(starts, _RANGE)
        .withColumn(id_column, first + F.col("_start") + F.col("_rank"))
        .drop(_RANGE, "_start", "_rank")
    )
