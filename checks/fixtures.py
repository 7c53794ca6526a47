"""The two feeds as views over the generated tables. One SQL text serves Spark and DuckDB.

``events`` gives the activity feed; ``orders`` with ``lineitem`` gives the billable events. Every row is used. The
variants differ in how agents are spread and in which files carry a row:

* base: 20 and 25 agents with one owner each.
* wide: an agent per user or customer, some with two hosts or two owners, so that the dimensions grow with the data.
* joint: events dated to the month of the activity feed, so that runs hold rows of both feeds.

Late rows arrive in the next day's file. Events, and activity with ``early=True``, also have rows that arrive in the
file of the day before.
"""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

ACTIVITY_DAY = "2024-01-15"
EVENTS_DAY = "1998-06-15"


def natco(key: str) -> str:
    return (
        f"CASE CAST({key} % 6 AS INT) WHEN 0 THEN 'mt' WHEN 1 THEN 'cg' WHEN 2 THEN 'st' "
        "WHEN 3 THEN 'cr' WHEN 4 THEN 'tc' ELSE 'tp' END"
    )


def activity_sql(wide: bool = False, early: bool = False) -> str:
    host = "CASE WHEN user_id % 40 = 0 AND event_id % 2 = 0 THEN '@b.example.com' ELSE '@a.example.com' END"
    agent = f"CAST(user_id AS STRING) || {host}" if wide else "CAST(user_id % 20 AS STRING) || '@a.example.com'"
    ahead = "WHEN event_id % 19 = 0 THEN CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS DATE)" if early else ""
    return f"""
    SELECT CAST(event_id AS STRING) AS activity_id,
           CAST(event_id % 5000 AS STRING) AS billing_event_id,
           'agent' || {agent} AS agent_id,
           'u' || CAST(user_id AS STRING) AS user_id,
           CASE WHEN event_id % 10 < 6 THEN 'MT' WHEN event_id % 10 < 9 THEN 'MO' ELSE NULL END AS direction,
           CAST(CAST(ts AS DATE) AS STRING) || 'T00:00:00' AS time,
           CASE event_type WHEN 'click' THEN 'suggestion_tap' WHEN 'view' THEN 'read_receipt_event'
                WHEN 'purchase' THEN 'file_transfer' WHEN 'signup' THEN 'text_message'
                ELSE 'unmapped_type' END AS type,
           CAST(floor(value * 100) AS BIGINT) AS size_bytes,
           {natco("user_id")} AS NatCo,
           CASE WHEN event_id % 17 = 0 THEN CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS DATE) {ahead}
                ELSE CAST(ts AS DATE) END AS FileDate
    FROM {{events}}"""


def events_sql(wide: bool = False, joint: bool = False) -> str:
    agent = "CAST(o_custkey AS STRING)" if wide else "CAST(o_custkey % 25 AS STRING)"
    second = "CASE WHEN o_custkey % 50 = 0 AND o_orderkey % 2 = 0 THEN 'reseller' ELSE 'owner' END"
    owner = f"{second} || CAST(o_custkey % 97 AS STRING)" if wide else "'owner' || CAST((o_custkey % 25) % 7 AS STRING)"
    day = "CAST(DATE '2024-01-01' + CAST(o_orderkey % 31 AS INT) AS DATE)" if joint else "CAST(o_orderdate AS DATE)"
    return f"""
    SELECT billing_event_id, type, agent_id, agent_owner, CAST(day AS STRING) || 'T08:00:00' AS start_time,
           duration, mt_messages, mo_messages, NatCo,
           CASE WHEN late THEN CAST(day + INTERVAL 1 DAY AS DATE) WHEN ahead THEN CAST(day - INTERVAL 1 DAY AS DATE)
                ELSE day END AS FileDate
    FROM (
      SELECT CAST(o_orderkey AS STRING) AS billing_event_id,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'a2p_conversation' WHEN '2-HIGH' THEN 'p2a_conversation'
                  WHEN '3-MEDIUM' THEN 'single_message' WHEN '4-NOT SPECIFIED' THEN 'basic_message'
                  ELSE 'a2p_conversation' END AS type,
             'agent' || {agent} || '@a.example.com' AS agent_id,
             {owner} || '@owners.example.com' AS agent_owner,
             {day} AS day, o_orderkey % 13 = 0 AS late, o_orderkey % 29 = 0 AS ahead,
             CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 3600 END AS duration,
             coalesce(l.mt, 0) AS mt_messages, coalesce(l.mo, 0) AS mo_messages,
             {natco("o_custkey")} AS NatCo
      FROM {{orders}} o LEFT JOIN (
        SELECT l_orderkey,
               CAST(sum(CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END) AS BIGINT) AS mt,
               CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS mo
        FROM {{lineitem}} GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey) t"""


def years_sql() -> str:
    """An accumulator over several years, from the orders: users come back in other months and years."""
    return f"""
    SELECT CAST(o_orderdate AS DATE) AS FileDate, CAST(o_orderdate AS DATE) AS Date, {natco("o_custkey")} AS NatCo,
           CAST(o_custkey % 7 AS BIGINT) AS AgentID,
           CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'u' || CAST(o_custkey % 97 AS STRING) END AS user_id
    FROM {{orders}}"""


@dataclass(frozen=True)
class Feeds:
    """The views of one test-data folder."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def activity(self, **variant: bool) -> DataFrame:
        return self.spark.sql(activity_sql(**variant), events=self.table("events"))

    def events(self, **variant: bool) -> DataFrame:
        return self.spark.sql(events_sql(**variant), orders=self.table("orders"), lineitem=self.table("lineitem"))

    def years(self) -> DataFrame:
        return self.spark.sql(years_sql(), orders=self.table("orders"))

    @cached_property
    def base_activity(self) -> DataFrame:
        return self.activity()

    @cached_property
    def base_events(self) -> DataFrame:
        return self.events()
