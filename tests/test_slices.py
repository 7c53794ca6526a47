"""Facts in slices by date: the same rows as whole facts, with only the touched dates read and written."""

from palaver.plans.daily import run_day
from palaver.plans.jobs import DayRun
from palaver.plans.publish import DATED, load, publish, published
from tests.helpers import activity, events, rows
from tests.test_runs import lookup_tables

#: Each file date, and the dates of its rows: late, early and without a date, and a date that only an earlier file has.
FILES = [
    ("2024-01-01", ["2024-01-01", "2024-01-01", None]),
    ("2024-01-02", ["2024-01-02", "2024-01-01", "2024-01-05"]),
    ("2024-01-03", ["2024-01-03", None]),
    ("2024-01-05", ["2024-01-05", "2024-01-03"]),
    ("2024-01-05", ["2024-01-04"]),
]


def feeds_of(spark, file_date, dates):
    times = [f"{d}T08:00:00" if d else None for d in dates]
    messages = [{"time": t, "user_id": f"u{i}", "run": (file_date, "mt"), "agent_id": f"bot{i % 2}@h"} for i, t in enumerate(times)]
    billed = [{"start_time": t, "duration": 7 * i + 1, "type": k, "run": (file_date, "mt")} for i, t in enumerate(times) for k in ("a2p_conversation", "single_message")]
    return activity(spark, *messages).drop("NatCo", "FileDate"), events(spark, *billed).drop("NatCo", "FileDate")


def folders_of(df, name):
    return {x.rpartition("/")[0].rpartition("/")[2] for x in df.inputFiles() if f"/{name}_mt/" in x}


def test_slices_hold_what_whole_facts_hold(spark, tmp_path):
    lookup = lookup_tables(spark)
    sliced, whole = [(str(tmp_path / x / "l"), str(tmp_path / x / "o")) for x in "sw"]
    current = {}
    for i, (file_date, dates) in enumerate(FILES):
        feeds = feeds_of(spark, file_date, dates)
        run = DayRun(*feeds, *sliced, file_date, "mt", lookup)
        touched = sorted({*filter(None, dates), file_date})
        assert run.dates == touched
        read, state = load(spark, sliced[1], "mt", lookup, run.since, run.dates)
        for name in DATED:  # only touched slices are read, only they are written
            assert folders_of(getattr(state, name), name) <= {f"date_={d}" for d in touched}
        run.publish()
        entries = {(r["name"], r["slice"]): r["path"] for r in published(spark, sliced[1]).collect() if r["name"][:-3] in DATED}
        assert {k for k in entries if entries[k] != current.get(k)} <= {(f"{n}_mt", d) for n in DATED for d in (*touched, "none")}
        assert all(k in entries for k in current)
        current = entries
        found = load(spark, whole[1], "mt", lookup)
        publish(run_day(*feeds, *found, file_date, "mt"), *whole, f"v{i}", "mt", file_date)
        stored = [load(spark, folder, "mt", lookup)[1] for _, folder in (sliced, whole)]
        for name in vars(stored[0]):
            assert rows(getattr(stored[0], name)) == rows(getattr(stored[1], name)), (file_date, name)
    assert {d for _, d in current} == {"2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05", "none"}
    assert {current[f"{n}_mt", "none"] for n in DATED} == {""}


def test_slices_go_on_from_a_whole_fact_and_a_whole_fact_from_slices(spark, tmp_path):
    lookup, folders = lookup_tables(spark), (str(tmp_path / "l"), str(tmp_path / "o"))
    compared = str(tmp_path / "c")
    for i, (file_date, dates) in enumerate(FILES[:4]):
        feeds = feeds_of(spark, file_date, dates)
        as_csv = i == 2  # text is written whole, in place of the slices before it
        DayRun(*feeds, *folders, file_date, "mt", lookup, as_csv=as_csv).publish()
        publish(run_day(*feeds, *load(spark, f"{compared}/o", "mt", lookup), file_date, "mt"), f"{compared}/l", f"{compared}/o", f"v{i}", "mt", file_date)
    stored = [load(spark, folder, "mt", lookup)[1] for folder in (folders[1], f"{compared}/o")]
    for name in DATED:
        assert rows(getattr(stored[0], name)) == rows(getattr(stored[1], name)), name
