"""Whole runs: one after another through the stored state, and all at once."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from palaver import schemas
from palaver.plans import jobs
from palaver.plans.backfill import backfill
from palaver.plans.daily import Lookups, empty_state, run_day
from palaver.plans.publish import PER_NATCO, load, load_backfill, publish, published, publish_backfill, vacuum
from palaver.sources import feeds, lookups
from palaver.workspace import matching, working_folder, write_once
from tests.helpers import activity, bag, contents, events, natcos, rows

ORDER = ("cg", "mt", "tp")
DATES = ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04")


def lookup_tables(spark) -> Lookups:
    seeds = contents(spark, (4, "text_message", "Text"), (9, "spam", None))
    return Lookups(natcos(spark), lookups.conversation_types(spark), seeds)


def random_feeds(spark, seed: int):
    """Early, late and undated rows; nulls; agents with several hosts and owners; some runs without rows."""
    draw = random.Random(seed)
    runs = [(d, n) for d in DATES[:3] for n in ORDER if draw.random() < 0.8]
    days = [*DATES, "2023-12-31", None, "junk"]
    agents = ["a@h1", "a@h2", "b@h1", "c@h1", "c", None]
    owners = ["x@o", "y@o", "y@p", None]

    def spread(n, make):
        return [{"run": draw.choice(runs), **make()} for _ in range(n)]

    def moment():
        day = draw.choice(days)
        return None if day is None else f"{day}T10:00:00"

    acts = spread(
        60,
        lambda: {
            "agent_id": draw.choice(agents),
            "user_id": draw.choice(["u1", "u2", "u3", None]),
            "direction": draw.choice(["MT", "mo", "MO", None]),
            "time": moment(),
            "type": draw.choice(["text_message", "spam", "new1", "new2", None]),
        },
    )
    evts = spread(
        60,
        lambda: {
            "agent_id": draw.choice(agents),
            "agent_owner": draw.choice(owners),
            "start_time": moment(),
            "type": draw.choice(["a2p_conversation", "p2a_conversation", "single_message", "basic_message", None]),
            "duration": draw.choice([None, 1, 2, 5, 7, 100]),
            "mt_messages": draw.choice([None, 1, 2]),
            "mo_messages": draw.choice([1, 3]),
        },
    )
    return write_once(activity(spark, *acts), "acts"), write_once(events(spark, *evts), "evts"), runs


def one_run(df, file_date, natco):
    return df.filter((F.col("FileDate") == F.lit(file_date).cast("date")) & (F.col("NatCo") == natco))


@pytest.mark.parametrize("seed, as_csv", [(1, False), (2, True)])
def test_backfill_is_the_runs_one_after_another(spark, tmp_path, seed, as_csv):
    acts, evts, runs = random_feeds(spark, seed)
    lookup = lookup_tables(spark)
    output, shared = str(tmp_path / "output"), str(tmp_path / "lookup")

    processed = [(d, n) for d in DATES[:3] for n in ORDER]  # runs without rows are processed as well
    for i, (date, natco) in enumerate(processed):
        current, state = load(spark, output, natco, lookup)
        results = run_day(one_run(acts, date, natco), one_run(evts, date, natco), current, state, date, natco)
        publish(results, shared, output, f"v{i:03d}", natco, date, as_csv)

    all_runs = spark.createDataFrame(processed, "FileDate string, NatCo string")
    all_runs = all_runs.withColumn("FileDate", F.col("FileDate").cast("date"))
    at_once = backfill(acts, evts, lookup, ORDER, all_runs)

    for natco in ORDER:
        current, state = load(spark, output, natco, lookup)
        for table in ("f_message_content", "f_message_conversation", "f_conversations_and_sm", "acc_users_daily"):
            mine = at_once[table].filter(F.col("NatCo") == natco)
            stored = getattr(state, table)
            assert rows(mine, *stored.columns) == rows(stored), (natco, table)
    for table in ("d_agent_owner", "d_agent", "d_content_type"):
        assert rows(at_once[table], *getattr(state, table).columns) == rows(getattr(state, table)), table
    assert rows(at_once["ContentDescriptionMapping"]) == rows(current.contents)

    ids = [r["AgentID"] for r in at_once["d_agent"].collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    for table in ("f_uau_daily", "f_uau_monthly", "f_uau_yearly", "f_uau_total"):
        last = {n: r for n, r in ((r["name"], r) for r in published(spark, output).collect())}
        for natco in ORDER:
            entry = last.get(f"{table}_{natco}")
            if entry is None:
                assert at_once[table].filter(F.col("NatCo") == natco).isEmpty()
            elif not as_csv:
                stored = spark.read.parquet(entry["path"])
                assert rows(at_once[table].filter(F.col("NatCo") == natco), *stored.columns) == rows(stored)


def test_users_grow_with_the_period(spark):
    acts, evts, _ = random_feeds(spark, 3)
    found = backfill(acts, evts, lookup_tables(spark), ORDER)
    keys = ["NatCo", "NatCoID", "AgentID"]

    def most(table, column):
        return {tuple(r)[:3]: r["n"] for r in found[table].groupBy(*keys).agg(F.max(column).alias("n")).collect()}

    day, month = most("f_uau_daily", "UAU_daily"), most("f_uau_monthly", "UAU_monthly")
    year, total = most("f_uau_yearly", "UAU_yearly"), most("f_uau_total", "UAU_total")
    assert day.keys() == total.keys()
    assert all(day[k] <= month[k] <= year[k] <= total[k] for k in total)
    content = found["f_message_content"].collect()
    assert all(r["MT_MessagesByType"] + r["MO_MessagesByType"] <= r["MTMO_MessagesByType"] for r in content)


def test_an_agents_first_day_has_no_agent_id(spark):
    lookup, day = lookup_tables(spark), ("2024-01-02", "mt")
    results = run_day(activity(spark, {}), events(spark, {}), lookup, empty_state(spark), *day)
    assert rows(results["acc_users_daily"]) == bag(("2024-01-02", "2024-01-02", "mt", None, "u1"))
    assert rows(results["f_uau_daily"]) == bag(("2024-01-02", 1, None, 1))
    assert rows(results["f_message_content"]) == bag(("2024-01-02", 1, 4, 1, 1, 0, 1))
    assert rows(results["d_agent"]) == bag((1, 1, "bot"))


def test_historical_content_ids(spark):
    """One nameless id per activity on the first day, so that its facts have no ContentID; names come the day after."""
    lookup, state = lookup_tables(spark), empty_state(spark)
    acts = activity(spark, {"type": "new", "activity_id": "a"}, {"type": "new", "activity_id": "b"})
    first = run_day(acts, events(spark, {}), lookup, state, "2024-01-02", "mt", per="activity")
    assert rows(first["d_content_type"]) == bag((10, None, None), (11, None, None))
    assert rows(first["f_message_content"]) == bag(("2024-01-02", 1, None, 1, 2, 0, 2))
    lookup = Lookups(lookup.natcos, lookup.conversation_types, first["ContentDescriptionMapping"])
    stored = {t: first[t] for t in ("d_agent", "d_agent_owner", "d_content_type")}
    state = type(state)(**{**vars(state), **stored})
    second = run_day(acts, events(spark, {}), lookup, state, "2024-01-03", "mt", per="activity")
    assert rows(second["d_content_type"]) == bag((10, None, None), (11, None, None), (10, "new", "N/A"), (11, "new", "N/A"))


@pytest.mark.parametrize("seed", [1, 5])
def test_backfill_goes_on_from_the_stored_state(spark, tmp_path, seed):
    """First half by daily runs, the rest as one backfill of two NatCos: as if all had been daily runs."""
    acts, evts, _ = random_feeds(spark, seed)
    lookup = lookup_tables(spark)
    processed = [(d, n) for d in DATES[:3] for n in ORDER]
    first, second = processed[:4], [(d, n) for d, n in processed if n != "tp" and (d, n) not in processed[:4]]
    second.append(("2024-01-01", "cg"))  # a rerun
    second.sort(key=lambda run: (run[0], ORDER.index(run[1])))

    def daily(folder, runs, start=0):
        for i, (date, natco) in enumerate(runs, start):
            current, state = load(spark, folder, natco, lookup)
            results = run_day(one_run(acts, date, natco), one_run(evts, date, natco), current, state, date, natco)
            publish(results, f"{folder}/l", folder, f"v{i:03d}", natco, date)

    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    daily(one, first)
    daily(two, first)
    untouched = load(spark, one, "tp", lookup)[1].f_message_content
    before = rows(untouched)
    daily(one, second, len(first))

    runs = spark.createDataFrame(second, "FileDate string, NatCo string")
    runs = runs.withColumn("FileDate", F.col("FileDate").cast("date"))
    asked = [F.struct("FileDate", "NatCo").isin([F.struct(F.lit(d).cast("date"), F.lit(n)) for d, n in second])]
    current, state = load_backfill(spark, two, ["cg", "mt"], lookup)
    results = backfill(acts.filter(asked[0]), evts.filter(asked[0]), current, ORDER, runs, state)
    publish_backfill(results, f"{two}/l", two, "v100", second)

    for natco in ORDER:
        (lookup1, state1), (lookup2, state2) = load(spark, one, natco, lookup), load(spark, two, natco, lookup)
        for name in vars(state1):
            assert rows(getattr(state1, name)) == rows(getattr(state2, name)), (natco, name)
        assert rows(lookup1.contents) == rows(lookup2.contents)
    assert rows(load(spark, two, "tp", lookup)[1].f_message_content) == before
    listed = [{r["name"]: r["path"] for r in published(spark, folder).collect() if r["name"].startswith("f_uau")} for folder in (one, two)]
    assert listed[0].keys() == listed[1].keys()
    for name in listed[0]:
        stored = [spark.read.parquet(paths[name]) for paths in listed]
        assert rows(stored[0]) == rows(stored[1], *stored[0].columns), name


def test_an_empty_result_leaves_the_published_table(spark, tmp_path):
    lookup, output, shared = lookup_tables(spark), str(tmp_path / "o"), str(tmp_path / "l")
    results = run_day(activity(spark, {}), events(spark, {}), lookup, empty_state(spark), "2024-01-02", "mt")
    assert set(publish(results, shared, output, "v1", "mt", "2024-01-02")) == {
        f"{t}_mt" if t in PER_NATCO else t for t in results
    }
    results["f_uau_total"] = results["f_uau_total"].filter("false")
    assert "f_uau_total_mt" not in publish(results, shared, output, "v2", "mt", "2024-01-02")
    versions = {r["name"]: r["version"] for r in published(spark, output).collect()}
    assert versions.pop("f_uau_total_mt") == "v1"
    assert set(versions.values()) == {"v2"}
    before = {r["name"]: tuple(r) for r in published(spark, output).collect()}
    gone = vacuum(spark, shared, output)
    assert len(gone) == 14 and not any("f_uau_total" in x and "/v1/" in x for x in gone)
    assert vacuum(spark, shared, output) == []
    assert {r["name"]: tuple(r) for r in published(spark, output).collect()} == before
    assert rows(load(spark, output, "mt", lookup)[1].d_agent) == bag((1, 1, "bot"))


def test_a_run_that_was_not_committed_leaves_no_trace(spark, tmp_path, monkeypatch):
    lookup, output, shared = lookup_tables(spark), str(tmp_path / "o"), str(tmp_path / "l")
    results = run_day(activity(spark, {}), events(spark, {}), lookup, empty_state(spark), "2024-01-02", "mt")
    publish(results, shared, output, "v1", "mt", "2024-01-02")

    from palaver.plans import publish as module

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(module, "_commit", fail)
    before = {r["name"]: tuple(r) for r in published(spark, output).collect()}
    stored = {name: rows(getattr(load(spark, output, "mt", lookup)[1], name)) for name in vars(load(spark, output, "mt", lookup)[1])}
    again = {name: df.unionAll(df) for name, df in results.items()}
    with pytest.raises(RuntimeError):
        publish(again, shared, output, "v2", "mt", "2024-01-02")
    monkeypatch.undo()
    _, state = load(spark, output, "mt", lookup)
    assert rows(state.d_agent) == bag((1, 1, "bot"))
    assert {name: rows(getattr(state, name)) for name in stored} == stored
    assert {r["name"]: tuple(r) for r in published(spark, output).collect()} == before
    assert len(before) == 14


def feed_file(folder, name, names, *lines):
    text = "\n".join("\t".join(row) for row in [names, *lines]) + "\n"
    (folder / name).write_bytes(gzip.compress(text.encode()))


def write_files(folder, *runs):
    for date, natco in runs:
        feed_file(
            folder,
            feeds.feed_file("activity", date, natco),
            schemas.ACTIVITY.names,
            ["a1", "b1", "bot@h", "u1", "MT", f"{date}T08:00:00", "text_message", "5"],
            ["a2", "b1", "bot@h", "u2", "MO", f"{date}T08:00:00", "unheard_of", "5"],
        )
        feed_file(
            folder,
            feeds.feed_file("events", date, natco),
            schemas.EVENTS.names,
            ["e1", "a2p_conversation", "bot@h", "acme@o", "p", "1", "2", "3", f"{date}T08:00:00", "60", "4", "2", "1", "n", "o"],
        )


def test_jobs_over_folders(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    runs = [("2024-01-01", "cg"), ("2024-01-01", "mt"), ("2024-01-02", "cg"), ("2024-01-02", "mt")]
    write_files(inbox, *runs)
    daily, shared = str(tmp_path / "o"), str(tmp_path / "l")
    for date, natco in runs:
        assert jobs.process_day(spark, str(inbox), shared, daily, date, natco)
    users = jobs.process_users(spark, daily)
    lines = spark.read.option("header", True).option("sep", ";").csv(users)
    assert lines.columns == ["AgentID", "NatCoID", "Date", "user_id"]
    assert rows(lines) == bag(
        ("1", "1", "2024-01-02", "u1"), ("1", "1", "2024-01-02", "u2"), ("1", "2", "2024-01-02", "u1"),
        ("1", "2", "2024-01-02", "u2"), ("1", "1", "2024-01-01", "u1"), ("1", "1", "2024-01-01", "u2"),
        (None, "2", "2024-01-01", "u1"), (None, "2", "2024-01-01", "u2"),
    )

    once, shared2 = str(tmp_path / "o2"), str(tmp_path / "l2")
    jobs.process_backfill(spark, str(inbox), shared2, once)
    for natco in ("cg", "mt"):
        (lookup1, state1), (lookup2, state2) = load(spark, daily, natco), load(spark, once, natco)
        for name in vars(state1):
            assert rows(getattr(state1, name)) == rows(getattr(state2, name)), (natco, name)
        assert rows(lookup1.contents) == rows(lookup2.contents)

    # A daily run goes on from the backfilled state.
    write_files(inbox, ("2024-01-03", "mt"))
    assert jobs.process_day(spark, str(inbox), shared2, once, "2024-01-03", "mt")
    _, state = load(spark, once, "mt")
    assert state.acc_users_daily.count() == 6
    assert load(spark, once, "cg")[1].acc_users_daily.count() == 4
    assert rows(state.f_message_conversation, "Date", "MTMO_messages") == bag(
        ("2024-01-01", 6), ("2024-01-02", 6), ("2024-01-03", 6)
    )


def test_a_day_without_rows_is_not_processed(spark, tmp_path):
    feed_file(tmp_path, feeds.feed_file("activity", "2024-01-01", "mt"), schemas.ACTIVITY.names)
    feed_file(tmp_path, feeds.feed_file("events", "2024-01-01", "mt"), schemas.EVENTS.names)
    folder = str(tmp_path)
    assert jobs.process_day(spark, folder, f"{folder}/l", f"{folder}/o", "2024-01-01", "mt") == []
    assert published(spark, f"{folder}/o").isEmpty()


def test_backfill_publishes_every_natco(spark, tmp_path):
    acts, evts, runs = random_feeds(spark, 4)
    output = str(tmp_path / "o")
    names = publish_backfill(
        backfill(acts, evts, lookup_tables(spark), ORDER), str(tmp_path / "l"), output, "v1", sorted(runs)
    )
    assert {n for n in names if n.startswith("acc_users_daily_")} == {
        f"acc_users_daily_{r['NatCo']}" for r in acts.select("NatCo").distinct().collect()
    }


def test_jobs_read_the_lookup_folder_pass_over_absent_files_and_clean_up(spark, tmp_path):
    inbox, shared, output = tmp_path / "in", tmp_path / "l", str(tmp_path / "o")
    inbox.mkdir()
    shared.mkdir()
    (shared / "NatCoMapping.csv").write_text("NatCo;NatCoID\nmt;1\nmk;9\n")
    write_files(inbox, ("2024-01-01", "mk"), ("2024-01-02", "mt"))
    asked = {"file_dates": ["2024-01-01", "2024-01-02"], "natcos": ["mk", "mt"]}
    assert jobs.process_backfill(spark, str(inbox), str(shared), output, **asked)
    assert rows(load(spark, output, "mk")[1].f_message_conversation, "NatCoID") == bag((9,))
    assert jobs.process_day(spark, str(inbox), str(shared), output, "2024-01-05", "mk") == []
    path = jobs.process_users(spark, output, lookup_path=str(shared))
    assert {r["name"]: r["path"] for r in published(spark, output).collect()}["f_uau"] == path
    folder = f"{working_folder(spark)}/palaver/{spark.sparkContext.applicationId}"
    assert matching(spark, f"{folder}/run-*") == []
    assert [x[:2] for x in feeds.present(spark, str(inbox), "events", ["2024-01-0?"], ["m*"])] == [("2024-01-01", "mk"), ("2024-01-02", "mt")]
