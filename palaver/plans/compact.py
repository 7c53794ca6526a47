"""Compaction: slices by date are gathered in files by month.

A compacted slice is still listed by itself, with the path of its month. A run that replaces one date lists that slice with a
path of its own; the rows that the month's files hold of it are not read any more, until the month is compacted again.
"""

from functools import partial

from pyspark.sql import SparkSession

from palaver.operators.user_months import UNDATED, month_name
from palaver.plans.publish import (
    ACCUMULATOR,
    DATED,
    LOOKUP_TABLES,
    SHARED,
    Snapshot,
    Superseded,
    _commit,
    slice_column,
    sliced,
    snapshot,
    table_name,
)
from palaver.workspace import concurrently, remove


def compact(
    spark: SparkSession, lookup_path: str, output_path: str, version: str, natco: str, until: str | None = None
) -> dict[str, int]:
    """Gather the slices of the accumulator and of the accumulating facts by month. Returns how many slices moved, by table.

    ``until``: only months before that of this date, so that the month that runs still add to is left alone. Months that lie
    in one place already are left as well. Other runs may be under way; rows and what they count as do not change.
    """
    while True:
        since = snapshot(spark, output_path)
        # A compacted slice takes the number of the append that it stands for, so its version has to be the later one.
        version = max(version, *(f"{row['version']}-compact" for row in since.entries)) if since.entries else version
        stored = concurrently(
            *[partial(_gather, spark, since, table, lookup_path, output_path, version, natco, until) for table in (ACCUMULATOR, *DATED)]
        )
        entries = [entry for found in stored for entry in found]
        if not entries:
            return {}
        try:
            _commit(spark, output_path, entries, since, [natco])
        except Superseded:
            for root in {lookup_path.rstrip("/"), output_path.rstrip("/")}:
                remove(spark, f"{root}/{version}")
            continue
        return {table: len(found) for table, found in zip((ACCUMULATOR, *DATED), stored) if found}


def _gather(
    spark: SparkSession, since: Snapshot, table: str, lookup_path: str, output_path: str, version: str, natco: str, until: str | None
) -> list[tuple]:
    name = table_name(table, natco)
    root = (lookup_path if table in LOOKUP_TABLES else output_path).rstrip("/")
    months: dict[str, list] = {}
    for row in since.entries:
        if row["name"] == name and row["path"] and row["slice"] not in (None, UNDATED):
            months.setdefault(row["slice"][:7], []).append(row)
    scattered = {
        month: rows
        for month, rows in months.items()
        if len({row["path"] for row in rows}) > 1 and (until is None or month < until[:7])
    }
    moved = [row for rows in scattered.values() for row in rows]
    if not moved:
        return []
    path = f"{root}/{version}/{name}"
    rows = sliced(spark, table, moved).withColumn("month_", month_name(slice_column(table)))
    rows.hint("rebalance", "month_").write.partitionBy("month_").parquet(path)
    return [(name, version, f"{path}/month_={row['slice'][:7]}", SHARED, row["slice"], row["commit"]) for row in moved]
