"""Stored user months: after every run the counts are those of a full recount, and only touched months are read."""

from palaver.operators import user_months, users
from palaver.plans.daily import run_day
from palaver.plans.jobs import DayRun
from palaver.plans.publish import (
    BY_MONTH,
    BY_YEAR,
    COVERED,
    current_table,
    load,
    load_users,
    publish,
    published,
    snapshot,
    users_covered,
)
from tests.helpers import activity, bag, events, rows, table
from tests.test_runs import lookup_tables

COUNTS = {"f_uau_daily": users.uau_daily, "f_uau_monthly": users.uau_monthly, "f_uau_yearly": users.uau_yearly, "f_uau_total": users.uau_total}


def feeds_of(spark, file_date, seen):
    """``seen``: user and date of each activity."""
    agents = ["bot@h", "new@h" if file_date > "2024-01-01" else "bot@h"]
    messages = [
        {"time": d and f"{d}T08:00:00", "user_id": u, "run": (file_date, "mt"), "agent_id": agents[i % 2]} for i, (u, d) in enumerate(seen)
    ]
    return activity(spark, *messages).drop("NatCo", "FileDate"), events(spark).drop("NatCo", "FileDate").filter("false")


def counts_are_a_recount(spark, output, lookup):
    accumulator = load(spark, output, "mt", lookup)[1].acc_users_daily
    months = users.user_months(accumulator, lookup.natcos)
    for name, count in COUNTS.items():
        assert rows(current_table(spark, output, name, "mt")) == rows(count(months)), name


def slices(spark, output):
    names = {f"{name}_mt": name for name in (*BY_MONTH, *BY_YEAR)}
    return {(names[r["name"]], r["slice"]): r["path"] for r in published(spark, output).collect() if r["name"] in names and r["slice"] != COVERED}


def test_counts_equal_a_recount_after_reruns(spark, tmp_path):
    lookup, folders = lookup_tables(spark), (str(tmp_path / "l"), str(tmp_path / "o"))
    output = folders[1]
    DayRun(*feeds_of(spark, "2023-12-31", [("u1", "2023-12-31"), ("u2", "2023-12-31"), ("u1", "2024-01-01"), ("u3", None)]), *folders, "2023-12-31", "mt", lookup).publish()
    counts_are_a_recount(spark, output, lookup)
    # u1 on a day that another file has seen too, u4 in both years, a user without a name
    seen = [("u1", "2023-12-31"), ("u4", "2023-12-30"), ("u4", "2024-01-31"), (None, "2024-01-31"), ("u9", "2024-03-01")]
    DayRun(*feeds_of(spark, "2024-01-31", seen), *folders, "2024-01-31", "mt", lookup).publish()
    counts_are_a_recount(spark, output, lookup)
    before = slices(spark, output)
    assert {x for name, x in before if name == "acc_user_months"} == {"2023-12", "2024-01", "2024-03", "none"}
    assert {x for name, x in before if name == "acc_user_years"} == {"2023", "2024", "none"}
    # a rerun that takes days, a month and a user of a year back
    again = DayRun(*feeds_of(spark, "2024-01-31", [("u2", "2024-02-01")]), *folders, "2024-01-31", "mt", lookup)
    assert set(again.months) == {"2023-12", "2024-01", "2024-02", "2024-03", "none"}
    again.publish()
    counts_are_a_recount(spark, output, lookup)
    assert slices(spark, output)["acc_user_months", "2024-03"] == ""
    # a file of one month reads and writes that month and its year, and the slice of its own file date
    before = slices(spark, output)
    run = DayRun(*feeds_of(spark, "2024-02-02", [("u1", "2024-02-02"), ("u5", "2024-02-01")]), *folders, "2024-02-02", "mt", lookup)
    state = load(spark, output, "mt", lookup, run.since, run.dates, [run.run[0]])[1]
    assert state.acc_users_daily.inputFiles() == []
    stored = load_users(spark, "mt", run.since, state.acc_users_daily, run.dates)
    assert stored.touched == ("2024-02", "none")
    assert {x.split("date_=")[1].split("/")[0] for x in stored.months.inputFiles()} == {"2024-02", "__HIVE_DEFAULT_PARTITION__"}
    assert {x.split("date_=")[1].split("/")[0] for x in stored.other_years.inputFiles()} == {"2023"}
    run.publish()
    counts_are_a_recount(spark, output, lookup)
    after = slices(spark, output)
    assert {x for x in after if after[x] != before.get(x)} <= {(n, "2024-02") for n in BY_MONTH} | {(n, "2024") for n in BY_YEAR} | {(n, "none") for n in (*BY_MONTH, *BY_YEAR)}
    # a run that knows nothing of user months: the next one makes them anew
    feeds = feeds_of(spark, "2024-02-02", [("u6", "2024-05-01")])
    publish(run_day(*feeds, *load(spark, output, "mt", lookup), "2024-02-02", "mt"), *folders, "plain", "mt", "2024-02-02")
    assert not users_covered(snapshot(spark, output), "mt")
    DayRun(*feeds_of(spark, "2024-05-02", [("u6", "2024-05-02")]), *folders, "2024-05-02", "mt", lookup).publish()
    assert users_covered(snapshot(spark, output), "mt")
    counts_are_a_recount(spark, output, lookup)
    rebuilt = user_months.file_months(load(spark, output, "mt", lookup)[1].acc_users_daily)
    assert rows(current_table(spark, output, "acc_user_months", "mt"), *rebuilt.columns) == rows(rebuilt)


def test_months_are_cleared_in_their_year_only(spark):
    years = table(spark, "acc_user_years", ("mt", 2023, 1, "u", 0b110), ("mt", 2024, 1, "u", 0b10), ("mt", None, 1, "v", 1), ("mt", 2024, 1, "w", 0b1010))
    seen = table(spark, "acc_user_months", ("2024-03-01", "mt", "2024-03-01", 1, "w", 2), ("2024-03-01", "mt", None, None, None, 1))
    found = user_months.replace_months(years, seen, ["2024-01", "2024-03", "none"])
    expected = bag((2023, "mt", 1, "u", 0b110), (2024, "mt", 1, "w", 0b1000), (None, "mt", None, None, 1))
    assert rows(found, "Year", "NatCo", "AgentID", "user_id", "Months") == expected


def test_a_day_stays_as_long_as_one_file_has_seen_it(spark):
    stored = table(spark, "acc_user_months", ("2024-01-01", "mt", "2024-01-01", 1, "u", 0b10), ("2024-01-02", "mt", "2024-01-01", 1, "u", 0b110), (None, "mt", "2024-01-01", 1, "u", 8))
    left = user_months.replace_file(stored, stored.filter("false"), "2024-01-02")
    assert rows(left, "FileDate", "Days") == bag(("2024-01-01", 0b10))
