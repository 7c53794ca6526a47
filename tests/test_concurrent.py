"""Runs at the same time: whatever the order in which they load and publish, the result is that of one after another."""

from itertools import permutations

import pytest

from palaver.plans import publish as module
from palaver.plans.daily import empty_state, run_day
from palaver.plans.jobs import DayRun
from palaver.plans.publish import Superseded, load, published, snapshot
from tests.helpers import activity, events, rows
from tests.test_runs import lookup_tables

DAY, LATER = "2024-01-02", "2024-01-03"


def feeds_of(spark, natco, date=DAY):
    agents = {"cg": ["alpha@h", "mid@h", "old@h"], "mt": ["beta@h", "mid@h", "old@h"], "st": ["old@h"]}[natco]
    unknown = {"cg": "first_type", "mt": "other_type", "st": "text_message"}[natco]
    time = f"{date}T09:00:00"
    messages = [{"agent_id": a, "type": t, "run": (date, natco), "time": time, "user_id": natco} for a in agents for t in ("text_message", unknown)]
    billed = [{"agent_id": a, "agent_owner": f"{natco if a[0] != 'o' else 'all'}@o", "run": (date, natco), "start_time": time} for a in agents]
    return activity(spark, *messages).drop("NatCo", "FileDate"), events(spark, *billed).drop("NatCo", "FileDate")


def everything(spark, output, lookup):
    found = {}
    for natco in ("cg", "mt", "st"):
        contents, state = load(spark, output, natco, lookup)
        found |= {(natco, name): rows(getattr(state, name)) for name in vars(state)}
        found[natco, "mapping"] = rows(contents.contents)
    return found


def whole_tables(spark, folder):
    return {row["name"]: row["version"] for row in published(spark, f"{folder}/o").collect() if row["slice"] is None}


def started(spark, folder, natco, lookup, date=DAY):
    return DayRun(*feeds_of(spark, natco, date), f"{folder}/l", f"{folder}/o", date, natco, lookup)


@pytest.mark.parametrize("order", list(permutations(["cg", "mt"])))
def test_runs_that_loaded_before_either_published(spark, tmp_path, order):
    lookup = lookup_tables(spark)
    both = {natco: started(spark, tmp_path / "both", natco, lookup) for natco in ("cg", "mt")}
    for natco in order:
        assert f"f_message_content_{natco}" in both[natco].publish()
    assert [both[natco].attempts for natco in order] == [1, 2]
    for natco in order:
        started(spark, tmp_path / "serial", natco, lookup).publish()
    found = everything(spark, f"{tmp_path}/both/o", lookup)
    assert found == everything(spark, f"{tmp_path}/serial/o", lookup)
    assert len(set(found["cg", "d_agent"])) == 4
    versions = {row["version"] for row in published(spark, f"{tmp_path}/both/o").collect()}
    assert {p.name for p in (tmp_path / "both").glob("?/2*")} == versions


def test_runs_without_new_keys_do_not_wait_for_each_other(spark, tmp_path):
    lookup = lookup_tables(spark)
    for natco in ("cg", "mt"):
        started(spark, tmp_path, natco, lookup).publish()
    before = whole_tables(spark, tmp_path)
    runs = [started(spark, tmp_path, natco, lookup, LATER) for natco in ("cg", "mt", "st")]
    names = [run.publish() for run in runs]
    assert [run.attempts for run in runs] == [1, 1, 1] and all("d_agent" in x for x in names)
    after = whole_tables(spark, tmp_path)
    assert {n for n in before if before[n] == after[n]} == {"d_agent", "d_agent_owner", "d_content_type", "d_natco", "d_conversation_type", "ContentDescriptionMapping"}


def test_two_files_of_one_natco_at_the_same_time(spark, tmp_path):
    lookup = lookup_tables(spark)
    runs = [started(spark, tmp_path / "both", "mt", lookup, date) for date in (DAY, LATER)]
    for run in runs:
        run.publish()
    for date in (DAY, LATER):
        started(spark, tmp_path / "serial", "mt", lookup, date).publish()
    assert runs[1].attempts == 2
    assert everything(spark, f"{tmp_path}/both/o", lookup) == everything(spark, f"{tmp_path}/serial/o", lookup)


def test_an_append_in_between_is_seen(spark, tmp_path, monkeypatch):
    """The other run's append comes between the comparison and the rename."""
    lookup, output = lookup_tables(spark), str(tmp_path / "o")
    slow, fast = started(spark, tmp_path, "mt", lookup), started(spark, tmp_path, "cg", lookup)
    put, seen = module._put_if_absent, []

    def late(*given):
        if not seen:
            seen.append(given)
            fast.publish()
        return put(*given)

    monkeypatch.setattr(module, "_put_if_absent", late)
    slow.publish()
    assert slow.attempts == 2 and fast.attempts == 1
    assert sorted(p.name for p in (tmp_path / "o" / "_published").glob("[!.]*")) == ["commit-000000001.json", "commit-000000002.json"]
    assert rows(load(spark, output, "mt", lookup)[1].d_agent, "AgentID", "Agent") == rows(load(spark, output, "cg", lookup)[1].d_agent, "AgentID", "Agent")


def test_what_was_read_decides(spark, tmp_path):
    lookup, output = lookup_tables(spark), str(tmp_path / "o")
    since = snapshot(spark, output)
    results = run_day(*feeds_of(spark, "mt"), lookup, empty_state(spark), DAY, "mt")
    module.publish(results, str(tmp_path / "l"), output, "v1", "mt", DAY, since=since)
    with pytest.raises(Superseded):
        module.publish(results, str(tmp_path / "l"), output, "v0", "mt", DAY, since=since)
    # a later append is current, whatever its version's name
    module.publish(results, str(tmp_path / "l"), output, "v0", "mt", DAY)
    assert {row["version"] for row in published(spark, output).collect()} == {"v0"}
