from pyspark.sql import functions as F

from palaver.operators import users
from palaver.operators.staging import roll_user_accumulator
from palaver.workspace import literal_table
from palaver import schemas
from tests.helpers import activity, bag, natcos, rows, table


def accumulator(spark, *rows_):
    return table(spark, "acc_users_daily", *rows_)


def test_counts_at_every_grain(spark):
    acc = accumulator(
        spark,
        ("2024-01-02", "2024-01-02", "mt", 1, "a"),
        ("2024-01-02", "2024-01-02", "mt", 1, "a"),
        ("2024-01-02", "2024-01-02", "mt", 1, None),
        ("2024-02-01", "2024-02-01", "mt", 1, "a"),
        ("2024-02-01", "2024-02-02", "mt", 1, "b"),
        ("2025-02-01", "2025-02-02", "mt", 1, "a"),
        ("2025-02-01", None, "mt", 1, "c"),
        ("2025-02-01", "2025-02-02", "tp", None, None),
        ("2025-02-01", "2025-02-02", "mk", None, "z"),
    )
    months = users.user_months(acc, natcos(spark))
    assert rows(users.uau_daily(months)) == bag(
        ("2024-01-02", 1, 1, 1), ("2024-02-01", 1, 1, 1), ("2024-02-02", 1, 1, 1), ("2025-02-02", 1, 1, 1),
        (None, 1, 1, 1), ("2025-02-02", None, None, 1),
    )
    assert rows(users.uau_monthly(months)) == bag(
        ("2024-01", 1, 1, 1), ("2024-02", 1, 1, 2), ("2025-02", 1, 1, 1), (None, 1, 1, 1), ("2025-02", None, None, 1)
    )
    assert rows(users.uau_yearly(months)) == bag((2024, 1, 1, 2), (2025, 1, 1, 1), (None, 1, 1, 1), (2025, None, None, 1))
    assert rows(users.uau_total(months)) == bag((1, 1, 3), (None, None, 1))
    apart = users.user_months(acc, natcos(spark), ["NatCo"])
    assert rows(users.uau_total(apart, ["NatCo"])) == bag(("mt", 1, 1, 3), ("tp", None, None, 0), ("mk", None, None, 1))


def test_every_day_of_a_month_has_its_own_bit(spark):
    """Random users over two years against a plain count; both ends of long and short months occur."""
    acc = spark.range(3000).selectExpr(
        "DATE'2024-12-31' AS FileDate", "date_add(DATE'2023-12-30', cast(id * 37 % 740 AS int)) AS Date", "'mt' AS NatCo",
        "id % 3 AS AgentID", "IF(id % 11 = 0, NULL, concat('u', id % 40)) AS user_id",
    )
    plain = acc.groupBy("Date", "AgentID").agg(F.count_distinct("user_id").alias("n"))
    found = users.uau_daily(users.user_months(acc, natcos(spark)))
    assert rows(found, "Date", "AgentID", "UAU_daily") == rows(plain)


def test_across_natcos_newest_first(spark):
    acc = accumulator(
        spark,
        ("2024-01-02", "2024-01-01", "mt", 1, "a"),
        ("2024-01-03", "2024-01-01", "mt", 1, "a"),
        ("2024-01-03", "2024-01-03", "tp", 1, "a"),
        ("2024-01-03", "2024-01-02", "cg", 2, "b"),
    )
    found = [tuple(map(str, r)) for r in users.users_across_natcos(acc, natcos(spark)).collect()]
    assert found == [
        ("1", "None", "2024-01-03", "a"), ("2", "2", "2024-01-02", "b"), ("1", "1", "2024-01-01", "a")
    ]


def test_roll_replaces_a_file_date_and_keeps_every_row(spark):
    acc = accumulator(
        spark,
        ("2024-01-01", "2024-01-01", "mt", 1, "a"),
        ("2024-01-02", "2024-01-02", "mt", 1, "stale"),
        (None, "2024-01-02", "mt", 1, "undated"),
    )
    today = activity(
        spark, {"user_id": "b"}, {"user_id": "b"}, {"agent_id": "new@h", "user_id": "c"}, {"time": "?", "user_id": "d"}
    )
    agents = table(spark, "d_agent", (1, None, "bot"))
    rolled = roll_user_accumulator(acc, today, "2024-01-02", agents, natco="mt")
    assert rows(rolled) == bag(
        ("2024-01-01", "2024-01-01", "mt", 1, "a"),
        ("2024-01-02", "2024-01-02", "mt", 1, "b"),
        ("2024-01-02", "2024-01-02", "mt", 1, "b"),
        ("2024-01-02", "2024-01-02", "mt", None, "c"),
        ("2024-01-02", None, "mt", 1, "d"),
    )


def test_roll_of_an_empty_day_only_drops_it(spark):
    acc = accumulator(spark, ("2024-01-01", "2024-01-01", "mt", 1, "a"), ("2024-01-02", "2024-01-02", "mt", 1, "b"))
    nothing = activity(spark, {}).filter("false")
    agents = literal_table(spark, [], schemas.AGENT)
    assert rows(roll_user_accumulator(acc, nothing, "2024-01-02", agents)) == bag(
        ("2024-01-01", "2024-01-01", "mt", 1, "a")
    )
