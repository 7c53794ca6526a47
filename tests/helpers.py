"""Small feeds written by hand, and comparison of whole tables."""

from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from palaver import schemas
from palaver.plans.publish import SCHEMAS
from palaver.workspace import literal_table

ACTIVITY_DDL = "agent_id string, user_id string, direction string, time string, type string"
EVENTS_DDL = (
    "type string, agent_id string, agent_owner string, start_time string, duration bigint, mt_messages bigint, "
    "mo_messages bigint"
)


def activity(spark: SparkSession, *rows: dict) -> DataFrame:
    """Activity rows; what is not given has a plain value. ``run`` = (FileDate, NatCo) adds the tags."""
    return _feed(
        spark,
        rows,
        {
            "activity_id": None,
            "agent_id": "bot@host",
            "user_id": "u1",
            "direction": "MT",
            "time": "2024-01-02T10:00:00",
            "type": "text_message",
        },
        "activity_id string, " + ACTIVITY_DDL,
        numbered="activity_id",
    )


def events(spark: SparkSession, *rows: dict) -> DataFrame:
    defaults = {
        "type": "a2p_conversation",
        "agent_id": "bot@host",
        "agent_owner": "acme@owners",
        "start_time": "2024-01-02T10:00:00",
        "duration": 10,
        "mt_messages": 2,
        "mo_messages": 1,
    }
    return _feed(spark, rows, defaults, EVENTS_DDL)


def _feed(spark, rows, defaults, ddl, numbered=None) -> DataFrame:
    ddl += ", NatCo string, FileDate string"
    names = [part.split()[0] for part in ddl.split(", ")]
    filled = []
    for i, row in enumerate(rows):
        file_date, natco = row.get("run", ("2024-01-02", "mt"))
        full = {**defaults, **row, "NatCo": natco, "FileDate": file_date}
        if numbered and full[numbered] is None:
            full[numbered] = f"id{i}"
        filled.append(tuple(full[n] for n in names))
    df = spark.createDataFrame(filled, ddl)
    return df.withColumn("FileDate", df["FileDate"].cast("date"))


def table(spark: SparkSession, name: str, *rows: tuple) -> DataFrame:
    """A stored table; dates given as text."""
    schema = SCHEMAS[name]
    text = ", ".join(f"{f.name} {'string' if f.dataType.typeName() == 'date' else f.dataType.simpleString()}" for f in schema)
    df = spark.createDataFrame(list(rows), text)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])


def natcos(spark: SparkSession) -> DataFrame:
    return literal_table(spark, [("mt", 1), ("cg", 2)], schemas.NATCO)


def contents(spark: SparkSession, *rows: tuple) -> DataFrame:
    return literal_table(spark, list(rows), schemas.CONTENT_MAPPING)


def rows(df: DataFrame, *columns: str) -> Counter:
    """All rows as text, so that dates compare with plain text."""
    picked = df.select(*columns) if columns else df
    return Counter(tuple(str(v) if hasattr(v, "isoformat") else v for v in r) for r in picked.collect())


def bag(*expected: tuple) -> Counter:
    return Counter(expected)
