"""Run registered queries on Spark and DuckDB and compare them: ``python -m checks.compare [sf_dir] [query ...]``."""

import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.catalog import QUERIES
from checks.oracles import ORACLES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _rows(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark: SparkSession, connection, name: str, sf_dir: str) -> str | None:
    """What differs between the two engines, or None."""
    df = QUERIES[name](spark, sf_dir)
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"rows {found.total()} / {expected.total()}, extra {list(extra.items())[:3]}, "
        f"missing {list(missing.items())[:3]}"
    )


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> None:
    spark = session()
    connection = database(sf_dir)
    failed = 0
    for name in names or QUERIES:
        if name not in ORACLES:
            continue
        start = time.time()
        problem = difference(spark, connection, name, sf_dir)
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    sys.exit(1 if failed else 0)


_scratch = tempfile.TemporaryDirectory(prefix="palaver-")


def session(cpus: str = "8") -> SparkSession:
    """A local session, whose working tables are gone when the process ends."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("palaver")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": _scratch.name,
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    main(*sys.argv[1:])
