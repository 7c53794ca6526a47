"""Facts kept by file: in any order, with files run again and put right, they are those of every file run once."""

import random

import pytest

from palaver.operators.contributions import BY_FILE, counts
from palaver.plans.backfill import backfill
from palaver.plans.jobs import DayRun
from palaver.plans.publish import load, load_backfill, publish_backfill, published, snapshot, vacuum
from palaver.workspace import matching
from tests.helpers import activity, events, rows
from tests.test_runs import lookup_tables

FACTS = tuple(BY_FILE)
DATES = ("2024-01-01", "2024-01-02", "2024-01-03")


def a_file(seed: int, file_date: str) -> tuple[list, list]:
    """Early, late and undated rows of one file of mt; some keys meet in several files."""
    draw = random.Random(seed)
    days = [*DATES, "2023-12-31", "2024-01-09", None]

    def row(time, **more):
        day = draw.choice(days)
        agent = draw.choice(["a@h", "b@h", "c", None])
        return {"run": (file_date, "mt"), "agent_id": agent, time: day and f"{day}T10:00:00", **more}

    seen = [row("time", direction=draw.choice(["MT", "MO", None]), type=draw.choice(["text_message", "spam", "new"])) for _ in range(9)]
    kinds = ["a2p_conversation", "p2a_conversation", "single_message", "basic_message"]
    billed = [row("start_time", type=draw.choice(kinds), duration=draw.choice([None, 1, 2, 5, 7, 100])) for _ in range(9)]
    return seen, billed


def feeds_of(spark, *files):
    return activity(spark, *(r for seen, _ in files for r in seen)), events(spark, *(r for _, billed in files for r in billed))


def run(spark, folders, lookup, file, file_date, **more):
    acts, evts = feeds_of(spark, file)
    made = DayRun(acts.drop("NatCo", "FileDate"), evts.drop("NatCo", "FileDate"), *folders, file_date, "mt", lookup, **more)
    made.publish()
    return made


def by_name(facts, agents, contents, name):
    """Ids depend on the order of the runs, so rows are compared by what their keys name."""
    named = facts.join(agents.select("AgentID", "Agent"), "AgentID", "left").drop("AgentID", "NatCo")
    if "ContentID" in named.columns:
        named = named.join(contents.select("ContentID", "OriginalContent"), "ContentID", "left").drop("ContentID")
    return rows(named, *sorted(named.columns))


def facts_are(spark, output, lookup, expected):
    _, state = load(spark, output, "mt", lookup)
    for name in FACTS:
        found = by_name(getattr(state, name), state.d_agent, state.d_content_type, name)
        assert found == by_name(expected[name], expected["d_agent"], expected["d_content_type"], name), name


def once(spark, files, lookup, state=None):
    runs = spark.createDataFrame([(d, "mt") for d in files], "d string, NatCo string").selectExpr("date(d) FileDate", "NatCo")
    return backfill(*feeds_of(spark, *files.values()), lookup, runs=runs, state=state)


def test_files_run_in_any_order_and_again_count_once(spark, tmp_path):
    lookup, folders = lookup_tables(spark), (str(tmp_path / "l"), str(tmp_path / "o"))
    files = {d: a_file(20 + i, d) for i, d in enumerate(DATES)}
    for d in (DATES[2], DATES[0], DATES[1], DATES[2]):
        run(spark, folders, lookup, files[d], d, by_file=True)
    facts_are(spark, folders[1], lookup, once(spark, files, lookup))
    # another version of a file: what only the earlier one had is taken back, also where nothing is left of a date
    files[DATES[0]] = ([{"run": (DATES[0], "mt"), "time": "2024-01-02T10:00:00", "agent_id": "a@h"}], [])
    again = run(spark, folders, lookup, files[DATES[0]], DATES[0], by_file=True)
    assert set(again.files.dates) > set(again.dates)
    vacuum(spark, *folders)  # nothing that is current goes with what is not
    facts_are(spark, folders[1], lookup, once(spark, files, lookup))


def test_a_run_reads_and_writes_touched_dates_only(spark, tmp_path):
    lookup, folders = lookup_tables(spark), (str(tmp_path / "l"), str(tmp_path / "o"))

    def file(file_date, *days):
        times = [f"{d}T10:00:00" for d in days]
        return [{"run": (file_date, "mt"), "time": t} for t in times], [{"run": (file_date, "mt"), "start_time": t} for t in times]

    run(spark, folders, lookup, file("2024-01-01", "2024-01-01", "2024-01-02", "2024-01-03"), "2024-01-01", by_file=True)
    run(spark, folders, lookup, file("2024-01-02", "2024-01-02", "2024-01-01"), "2024-01-02", by_file=True)
    before = {(r["name"], r["slice"]): r["path"] for r in published(spark, folders[1]).collect()}
    made = run(spark, folders, lookup, file("2024-01-03", "2024-01-03", "2024-01-01"), "2024-01-03", by_file=True)
    assert made.files.dates == ("2024-01-01", "2024-01-03", "none")
    for name, part in BY_FILE.items():
        read = {(x.split("/")[-2].removeprefix("date_=")) for x in made.files.others[name].inputFiles()}
        assert read == {"2024-01-01"}, name  # of the third, only its own file counts
        assert made.files.facts[name].inputFiles() == []
        after = {(r["name"], r["slice"]): r["path"] for r in published(spark, folders[1]).collect()}
        changed = {x for n, x in after if n == f"{part}_mt" and after[n, x] != before.get((n, x))}
        assert changed == {f"2024-01-03/{d}" for d in made.files.dates}


def test_files_are_kept_from_a_backfill_on(spark, tmp_path):
    lookup, folders = lookup_tables(spark), (str(tmp_path / "l"), str(tmp_path / "o"))
    files = {d: a_file(30 + i, d) for i, d in enumerate(DATES)}
    first = {DATES[0]: files[DATES[0]]}
    publish_backfill(once(spark, first, lookup), *folders, "v0", [(DATES[0], "mt")], snapshot(spark, folders[1]))
    for d in DATES[1:]:
        run(spark, folders, lookup, files[d], d, by_file=True)
    facts_are(spark, folders[1], lookup, once(spark, files, lookup))

    # a run that does not keep files changes the facts: what is stored then stands for all files before
    plain = run(spark, folders, lookup, a_file(41, "2024-01-04"), "2024-01-04")
    assert plain.files is None
    _, state = load_backfill(spark, folders[1], ["mt"], lookup)
    last = {"2024-01-05": a_file(42, "2024-01-05")}
    expected = once(spark, last, lookup, state)
    for _ in range(2):
        run(spark, folders, lookup, last["2024-01-05"], "2024-01-05", by_file=True)
        facts_are(spark, folders[1], lookup, expected)


def test_which_files_count():
    processed = {"2024-01-02", "2024-01-04"}
    assert not counts("2024-01-01", "2024-01-02", processed)
    assert counts("2024-01-02", "2024-01-02", processed) and counts("2024-01-04", "2024-01-02", processed)
    assert counts("2024-01-02", "2024-01-03", processed)  # the third has no file of its own
    assert counts("2024-01-04", "none", processed) and not counts("2024-01-02", "none", processed)


def test_text_cannot_keep_files(spark, tmp_path):
    lookup, output = lookup_tables(spark), str(tmp_path / "o")
    with pytest.raises(ValueError, match="Parquet"):
        run(spark, (str(tmp_path / "l"), output), lookup, a_file(1, DATES[0]), DATES[0], as_csv=True, by_file=True)
    assert not matching(spark, f"{output}/*")
