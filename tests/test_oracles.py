"""Every registered query against DuckDB on the smallest tables, and the totals of the fixture views."""

import pytest

from checks.catalog import QUERIES
from checks.compare import database, difference
from checks.fixtures import activity_sql, events_sql
from checks.oracles import ORACLES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return database(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert difference(spark, duck, name, SMALL) is None


def test_fixture_totals():
    """Totals of the base views at sf0.01 that both engines agreed on before any operator existed."""
    duck = database("/root/testdata/sf0.01")
    activity = activity_sql().format(events="events")
    billed = events_sql().format(orders="orders", lineitem="lineitem")
    one = lambda sql: duck.execute(sql).fetchone()
    assert one(
        f"""SELECT count(*), count(DISTINCT agent_id), count(direction), sum(size_bytes), count(DISTINCT FileDate),
        count(*) FILTER (WHERE FileDate > CAST(split_part(time, 'T', 1) AS DATE)) FROM ({activity}) a"""
    ) == (10_000, 20, 9_000, 49_630_064, 31, 589)
    assert one(
        f"""SELECT count(*), count(DISTINCT agent_id), count(DISTINCT agent_owner), sum(duration), count(duration),
        sum(mt_messages), sum(mo_messages) FROM ({billed}) b"""
    ) == (15_000, 25, 7, 23_718_874, 13_636, 40_074, 19_926)
