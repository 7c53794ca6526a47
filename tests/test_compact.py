"""Compaction: the same rows from fewer places, while single dates can still be replaced."""

from collections import Counter

from palaver.operators.contributions import BY_FILE
from palaver.plans.compact import compact
from palaver.plans.jobs import DayRun, new_version
from palaver.plans.publish import (
    ACCUMULATOR,
    compact_list,
    load,
    publish,
    publish_backfill,
    published,
    snapshot,
    users_covered,
    vacuum,
)
from palaver.workspace import matching
from tests.helpers import bag, rows, table
from tests.test_runs import lookup_tables
from tests.test_slices import feeds_of

DATES = [f"2024-{m:02}-{d:02}" for m in (1, 2, 3) for d in range(1, 13)]


def places(df):
    return {x.rpartition("/")[0].rpartition("/")[2] for x in df.inputFiles()}


def test_an_accumulator_of_many_dates_lies_in_a_place_per_month(spark, tmp_path):
    lookup, folders = lookup_tables(spark), (str(tmp_path / "l"), str(tmp_path / "o"))
    expected = {n: [(d, d, n, i, f"u{i}") for i, d in enumerate(DATES)] * 2 for n in ("mt", "cg")}
    runs = [(d, n) for n in expected for d in (*DATES, "2024-01-20")]  # one run without rows
    publish_backfill({ACCUMULATOR: table(spark, ACCUMULATOR, *(r for x in expected.values() for r in x))}, *folders, "v1", runs)

    def stored(natco="mt", files=None):
        return load(spark, folders[1], natco, lookup, files=files)[1].acc_users_daily

    assert len(places(stored())) == len(DATES)
    assert compact(spark, *folders, "v2", "mt", until="2024-03-05") == {ACCUMULATOR: 24}  # the last month is left
    assert places(stored()) == {"month_=2024-01", "month_=2024-02", *(f"date_={d}" for d in DATES[24:])}
    assert compact(spark, *folders, "v3", "mt") == {ACCUMULATOR: 12} and compact(spark, *folders, "v4", "mt") == {}
    assert places(stored()) == {"month_=2024-01", "month_=2024-02", "month_=2024-03"}
    assert places(stored(files=["2024-02-03"])) == {"month_=2024-02"}
    assert rows(stored(files=["2024-02-03"]), "FileDate") == bag(("2024-02-03",), ("2024-02-03",))
    assert len(places(stored("cg"))) == len(DATES)

    # single dates replaced, one of them by nothing, one with no version later than the compacted one
    again = [("2024-02-03", "2024-02-02", "mt", 7, "new")]
    for version, date, new in (("v5", "2024-02-03", again), ("v0", "2024-02-04", [])):
        publish({ACCUMULATOR: table(spark, ACCUMULATOR, *new)}, *folders, version, "mt", date)
    kept = [r for r in expected["mt"] if r[0] not in ("2024-02-03", "2024-02-04")] + again
    for _ in range(2):
        assert rows(stored()) == Counter(kept) and rows(stored("cg")) == Counter(expected["cg"])
        compact(spark, *folders, "v0", "mt")  # a clock that runs behind
    assert places(stored()) == {"month_=2024-01", "month_=2024-02", "month_=2024-03"}

    before = rows(published(spark, folders[1]))
    assert compact_list(spark, folders[1]) > 1 and compact_list(spark, folders[1]) == 0
    assert rows(published(spark, folders[1])) == before
    assert len(matching(spark, f"{folders[1]}/_published/commit-*.json")) == 1
    vacuum(spark, *folders)
    assert rows(stored()) == Counter(kept) and rows(stored("cg")) == Counter(expected["cg"])


def test_runs_go_on_from_compacted_slices(spark, tmp_path):
    lookup, folders = lookup_tables(spark), (str(tmp_path / "l"), str(tmp_path / "o"))
    files = [("2024-01-01", ["2024-01-01", None]), ("2024-01-02", ["2024-01-02", "2024-01-01"])]
    for file_date, dates in files:
        DayRun(*feeds_of(spark, file_date, dates), *folders, file_date, "mt", lookup, by_file=True).publish()
    before = load(spark, folders[1], "mt", lookup)[1]
    moved = compact(spark, *folders, new_version(), "mt")
    assert set(moved) == {ACCUMULATOR, *BY_FILE}
    after = load(spark, folders[1], "mt", lookup)[1]
    for name in (ACCUMULATOR, *BY_FILE):
        assert rows(getattr(before, name)) == rows(getattr(after, name)), name
    assert users_covered(snapshot(spark, folders[1]), "mt")
    # the same file once more: nothing starts over, nothing changes
    run = DayRun(*feeds_of(spark, *files[1]), *folders, files[1][0], "mt", lookup, by_file=True)
    assert not run.files.entries
    run.publish()
    again = load(spark, folders[1], "mt", lookup)[1]
    for name in BY_FILE:
        assert rows(getattr(before, name)) == rows(getattr(again, name)), name
