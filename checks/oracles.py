"""The registered queries in plain SQL over the same tables, written from the semantics, not from the Spark plans."""

from checks.fixtures import ACTIVITY_DAY, EVENTS_DAY, activity_sql, events_sql, years_sql

# The lookup rows and the order of NatCos, spelled out so that a wrong one in the library shows.
NATCO_ORDER = ("tc", "tp", "cg", "cr", "mk", "mt", "st")
NATCOS = [("mt", 1), ("cg", 2), ("st", 3), ("cr", 4), ("tc", 5)]
CONVERSATION_TYPES = [(1, "A2P", "Application to Person"), (2, "P2A", "Person to Application")]
CONTENTS = [
    (1, "file_transfer", " File Transfer"),
    (2, "text_message", "Text Message"),
    (3, "suggestion_tap", "Suggestion Tap"),
    (4, "rich_card/carousel", "Rich Card"),
    (5, "rich_card", "Rich card"),
    (6, "rich_card_carousel", "Rich card carousel"),
    (7, "file_transfer_image", "File transfer image"),
    (8, "file_transfer_video", "File transfer video"),
    (9, "suggested_reply_tap", "Suggested reply tap"),
    (10, "suggested_action_tap", "Suggested action tap"),
    (11, "delivery_receipt_event", "Delivery receipt event"),
    (12, "read_receipt_event", "Read receipt event"),
    (13, "spam_report", "Spam report"),
]


def _feed(sql: str) -> str:
    return sql.format(events="events", orders="orders", lineitem="lineitem")


def _values(rows: list[tuple]) -> str:
    def text(value) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    return "VALUES " + ", ".join("(" + ", ".join(map(text, row)) + ")" for row in rows)


def _with(*ctes: tuple[str, str], body: str, recursive: bool = False) -> str:
    listed = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {'RECURSIVE ' if recursive else ''}{listed}\n{body}"


# --- building blocks --------------------------------------------------------------------------------------------

NATCO = ("natco(NatCo, NatCoID)", _values(NATCOS))
KINDS = ("kinds(TypeOfConvID, TypeOfConv, Description)", _values(CONVERSATION_TYPES))
SEEDS = (
    "seeds",
    f"SELECT CAST(a AS BIGINT) AS ContentID, b AS OriginalContent, c AS Content FROM ({_values(CONTENTS)}) v(a, b, c)",
)


def activity(name: str = "activity", **variant: bool) -> tuple[str, str]:
    return name, _feed(activity_sql(**variant))


def billed(name: str = "billed", **variant: bool) -> tuple[str, str]:
    return name, _feed(events_sql(**variant))


def owners_sql(source: str) -> str:
    return (
        "SELECT row_number() OVER (ORDER BY AgentOwner) AS AgentOwnerID, AgentOwner "
        f"FROM (SELECT DISTINCT split_part(agent_owner, '@', 1) AS AgentOwner FROM {source}) o"
    )


def agents_sql(ids: str, source: str, owners: str = "owners") -> str:
    return f"""
    SELECT i.AgentID, o.AgentOwnerID, split_part(i.agent_id, '@', 1) AS Agent
    FROM (SELECT agent_id, row_number() OVER (ORDER BY agent_id) AS AgentID FROM (SELECT DISTINCT agent_id FROM ({ids}) d) e) i
    LEFT JOIN (SELECT DISTINCT agent_id, agent_owner FROM {source}) w ON w.agent_id = i.agent_id
    LEFT JOIN {owners} o ON o.AgentOwner = split_part(w.agent_owner, '@', 1)"""


BOTH = "SELECT agent_id FROM activity UNION ALL SELECT agent_id FROM billed"
OWNERS = ("owners", owners_sql("billed"))
AGENTS = ("agents", agents_sql(BOTH, "billed"))
NEW_TYPES = """
    SELECT (SELECT max(ContentID) FROM seeds) + row_number() OVER (ORDER BY type) AS ContentID,
           type AS OriginalContent, 'N/A' AS Content
    FROM (SELECT DISTINCT type FROM activity) t WHERE type NOT IN (SELECT OriginalContent FROM seeds)"""
CONTENT = (
    "contents",
    f"SELECT * FROM seeds WHERE OriginalContent IN (SELECT type FROM activity) UNION ALL {NEW_TYPES}",
)
PER_ACTIVITY = (
    "per_activity",
    """SELECT (SELECT max(ContentID) FROM seeds) + row_number() OVER (ORDER BY activity_id, type) AS ContentID, type
    FROM (SELECT DISTINCT activity_id, type FROM activity) t WHERE type NOT IN (SELECT OriginalContent FROM seeds)""",
)
BASE = (activity(), billed(), NATCO, SEEDS, OWNERS, AGENTS, CONTENT)


def content_sql(source: str = "activity") -> str:
    return f"""
    SELECT t.Date, n.NatCoID, c.ContentID, a.AgentID, t.MT_MessagesByType, t.MO_MessagesByType, t.MTMO_MessagesByType
    FROM (SELECT split_part(time, 'T', 1) AS Date, NatCo, split_part(agent_id, '@', 1) AS Agent, type,
                 count(*) FILTER (WHERE upper(direction) = 'MT') AS MT_MessagesByType,
                 count(*) FILTER (WHERE upper(direction) = 'MO') AS MO_MessagesByType,
                 count(*) AS MTMO_MessagesByType
          FROM {source} GROUP BY ALL) t
    LEFT JOIN contents c ON c.OriginalContent = t.type
    LEFT JOIN agents a ON a.Agent = t.Agent
    LEFT JOIN natco n ON n.NatCo = t.NatCo"""


def conversation_sql(source: str = "billed") -> str:
    return f"""
    SELECT t.Date, n.NatCoID, a.AgentID, CASE WHEN type = 'p2a_conversation' THEN '2' ELSE '1' END AS TypeOfConvID,
           t.MO_messages, t.MT_messages, t.MO_messages + t.MT_messages AS MTMO_messages
    FROM (SELECT split_part(start_time, 'T', 1) AS Date, NatCo, split_part(agent_id, '@', 1) AS Agent, type,
                 CAST(sum(mo_messages) AS BIGINT) AS MO_messages, CAST(sum(mt_messages) AS BIGINT) AS MT_messages
          FROM {source} WHERE type IN ('a2p_conversation', 'p2a_conversation') GROUP BY ALL) t
    LEFT JOIN agents a ON a.Agent = t.Agent
    LEFT JOIN natco n ON n.NatCo = t.NatCo"""


def sm_sql(source: str = "billed") -> str:
    return f"""
    SELECT t.Date, n.NatCoID, a.AgentID, CASE WHEN type = 'p2a_conversation' THEN '2' ELSE '1' END AS TypeOfConvID,
           t.AverageDuration, t.NoOfConv, t.NoOfSM, t.NoOfBM
    FROM (SELECT split_part(start_time, 'T', 1) AS Date, NatCo, split_part(agent_id, '@', 1) AS Agent, type,
                 round_even(avg(coalesce(duration, 0)), 2) AS AverageDuration,
                 count(*) FILTER (WHERE type IN ('a2p_conversation', 'p2a_conversation')) AS NoOfConv,
                 count(*) FILTER (WHERE type = 'single_message') AS NoOfSM,
                 count(*) FILTER (WHERE type = 'basic_message') AS NoOfBM
          FROM {source} GROUP BY ALL) t
    LEFT JOIN agents a ON a.Agent = t.Agent
    LEFT JOIN natco n ON n.NatCo = t.NatCo"""


def half_even(total: str, count: str) -> str:
    """Whole hundredths: the quotient, ties to even."""
    return (
        f"(({total}) // ({count}) + CASE WHEN 2 * (({total}) % ({count})) > ({count}) "
        f"OR (2 * (({total}) % ({count})) = ({count}) AND (({total}) // ({count})) % 2 = 1) THEN 1 ELSE 0 END)"
    )


def comma(hundredths: str) -> str:
    return f"replace(CAST(CAST({hundredths} AS DOUBLE) / 100 AS VARCHAR), '.', ',')"


def sums(columns: str) -> str:
    return ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in columns.split())


CONTENT_SUMS = sums("MT_MessagesByType MO_MessagesByType MTMO_MessagesByType")
CONVERSATION_SUMS = sums("MO_messages MT_messages MTMO_messages")
SM_SUMS = sums("NoOfConv NoOfSM NoOfBM")
CONTENT_MERGED = f"SELECT CAST(Date AS DATE) AS Date, NatCoID, ContentID, AgentID, {CONTENT_SUMS} FROM {{}} GROUP BY ALL"
CONVERSATION_MERGED = (
    f"SELECT CAST(Date AS DATE) AS Date, NatCoID, AgentID, TypeOfConvID, {CONVERSATION_SUMS} FROM {{}} GROUP BY ALL"
)
SM_HUNDREDTHS = (
    "SELECT CAST(Date AS DATE) AS Date, NatCoID, AgentID, TypeOfConvID, "
    + half_even("CAST(sum(cents) AS BIGINT)", "count(*)")
    + f" AS cents, {SM_SUMS} FROM {{}} GROUP BY ALL"
)
SM_TEXT = (
    f"SELECT Date, NatCoID, AgentID, TypeOfConvID, {comma('cents')} AS AverageDuration, NoOfConv, NoOfSM, NoOfBM FROM "
)


def in_cents(sql: str) -> str:
    return f"SELECT *, CAST(round(AverageDuration * 100) AS BIGINT) AS cents FROM ({sql}) q"


def split(source: str, day: str) -> tuple[tuple[str, str], tuple[str, str]]:
    return (
        ("others", f"SELECT * FROM {source} WHERE FileDate <> DATE '{day}'"),
        ("slice", f"SELECT * FROM {source} WHERE FileDate = DATE '{day}'"),
    )


def accumulator_sql(agents: str = "agents") -> str:
    return f"""
    SELECT FileDate, CAST(split_part(time, 'T', 1) AS DATE) AS Date, NatCo, AgentID, user_id
    FROM activity LEFT JOIN {agents} a ON a.Agent = split_part(agent_id, '@', 1)"""


def uau(period: str, name: str, years: bool = False) -> str:
    keys = "NatCoID, AgentID"
    period = period + ", " if period else ""
    return _with(
        *((NATCO, ("acc", _feed(years_sql()))) if years else (*BASE, ("acc", accumulator_sql()))),
        body=f"SELECT {period}{keys}, count(DISTINCT user_id) AS {name} FROM acc LEFT JOIN natco USING (NatCo) GROUP BY ALL",
    )


# --- backfill ---------------------------------------------------------------------------------------------------

RUN = (
    "(FileDate - DATE '1970-01-01') * 100 + CASE NatCo "
    + " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(NATCO_ORDER, 1))
    + " ELSE 99 END"
)
SIGHTINGS = (
    "sightings",
    f"""SELECT agent_id, CAST(NULL AS VARCHAR) AS agent_owner, FALSE AS billed, {RUN} AS run FROM activity
    UNION ALL SELECT agent_id, agent_owner, TRUE, {RUN} FROM billed""",
)
B_OWNERS = (
    "owners",
    """SELECT row_number() OVER (ORDER BY run, AgentOwner) AS AgentOwnerID, AgentOwner
    FROM (SELECT split_part(agent_owner, '@', 1) AS AgentOwner, min(run) AS run FROM sightings WHERE billed GROUP BY 1) o""",
)
# Everything seen of an agent name in the run it was first seen in.
B_AGENTS = (
    "by_run",
    """SELECT row_number() OVER (ORDER BY d.run, d.agent_id, o.AgentOwnerID NULLS FIRST) AS AgentID, o.AgentOwnerID,
              split_part(d.agent_id, '@', 1) AS Agent, d.run
    FROM (SELECT DISTINCT s.agent_id, s.run FROM sightings s
          JOIN (SELECT split_part(agent_id, '@', 1) AS Agent, min(run) AS run FROM sightings GROUP BY 1) f
            ON f.Agent = split_part(s.agent_id, '@', 1) AND f.run = s.run) d
    LEFT JOIN (SELECT DISTINCT agent_id, run, agent_owner FROM sightings WHERE billed) w
      ON w.agent_id = d.agent_id AND w.run = d.run
    LEFT JOIN owners o ON o.AgentOwner = split_part(w.agent_owner, '@', 1)""",
)
B_CONTENT = (
    "contents",
    f"""SELECT * FROM seeds WHERE OriginalContent IN (SELECT type FROM activity) UNION ALL
    SELECT (SELECT max(ContentID) FROM seeds) + row_number() OVER (ORDER BY run, type), type, 'N/A'
    FROM (SELECT type, min({RUN}) AS run FROM activity GROUP BY type) t
    WHERE type NOT IN (SELECT OriginalContent FROM seeds)""",
)
RUNS = ("runs", "SELECT DISTINCT FileDate, NatCo FROM activity UNION SELECT DISTINCT FileDate, NatCo FROM billed")
B_FEEDS = (activity(early=True), billed(joint=True))
B_WIDE = (activity(early=True, wide=True), billed(joint=True, wide=True))
B_BASE = (*B_FEEDS, NATCO, SEEDS, SIGHTINGS, B_OWNERS, B_AGENTS, ("agents", "SELECT * FROM by_run"), B_CONTENT, RUNS)


def alive(source: str, time: str) -> tuple[str, str]:
    """Rows whose date was not replaced by a later file of that date."""
    return (
        "alive",
        f"""SELECT * FROM {source} s WHERE NOT EXISTS (
          SELECT 1 FROM runs r WHERE r.NatCo = s.NatCo AND r.FileDate = CAST(split_part(s.{time}, 'T', 1) AS DATE)
          AND r.FileDate > s.FileDate)""",
    )


def per_natco(fact_sql: str) -> str:
    """A daily fact with the NatCo itself beside its id."""
    return fact_sql.replace("n.NatCoID", "t.NatCo, n.NatCoID", 1)


def per_file(fact_sql: str) -> str:
    return fact_sql.replace("SELECT t.Date", "SELECT t.FileDate, t.Date", 1).replace("AS Date, NatCo", "AS Date, FileDate, NatCo", 1)


AVERAGE_DURATION = _with(
    *B_BASE,
    alive("billed", "start_time"),
    ("means", in_cents(per_file(per_natco(sm_sql("alive"))))),
    (
        "files",
        f"""SELECT Date, NatCo, NatCoID, AgentID, TypeOfConvID, FileDate, CAST(sum(cents) AS BIGINT) AS total,
                   count(*) AS n, {SM_SUMS},
                   row_number() OVER (PARTITION BY Date, NatCo, AgentID, TypeOfConvID ORDER BY FileDate) AS step
            FROM means GROUP BY Date, NatCo, NatCoID, AgentID, TypeOfConvID, FileDate""",
    ),
    (
        "folded",
        f"""SELECT Date, NatCo, NatCoID, AgentID, TypeOfConvID, step, {half_even("total", "n")} AS cents
            FROM files WHERE step = 1
            UNION ALL
            SELECT f.Date, f.NatCo, f.NatCoID, f.AgentID, f.TypeOfConvID, f.step, {half_even("p.cents + f.total", "f.n + 1")}
            FROM folded p JOIN files f ON f.Date = p.Date AND f.NatCo = p.NatCo AND f.AgentID = p.AgentID
             AND f.TypeOfConvID = p.TypeOfConvID AND f.step = p.step + 1""",
    ),
    (
        "counted",
        f"""SELECT Date, NatCo, NatCoID, AgentID, TypeOfConvID, max(step) AS step, {SM_SUMS} FROM files
            GROUP BY Date, NatCo, NatCoID, AgentID, TypeOfConvID""",
    ),
    body=f"""SELECT c.NatCo, CAST(c.Date AS DATE) AS Date, c.NatCoID, c.AgentID, c.TypeOfConvID,
                    {comma("p.cents")} AS AverageDuration, c.NoOfConv, c.NoOfSM, c.NoOfBM
             FROM counted c JOIN folded p ON p.Date = c.Date AND p.NatCo = c.NatCo AND p.AgentID = c.AgentID
              AND p.TypeOfConvID = c.TypeOfConvID AND p.step = c.step""",
    recursive=True,
)

# --- one run over the state of all others -----------------------------------------------------------------------

THIS = f"FileDate = DATE '{ACTIVITY_DAY}' AND NatCo = 'mt'"


def _count(table: str, total: str, source: str) -> str:
    return f"SELECT '{table}' AS table_name, count(*) AS n_rows, CAST(sum({total}) AS BIGINT) AS total FROM ({source}) x"


RUN_DAILY = _with(
    ("all_activity", _feed(activity_sql(early=True))),
    ("all_billed", _feed(events_sql(joint=True))),
    ("activity", f"SELECT * FROM all_activity WHERE NOT ({THIS})"),
    ("billed", f"SELECT * FROM all_billed WHERE NOT ({THIS})"),
    ("today_activity", f"SELECT * FROM all_activity WHERE {THIS}"),
    ("today_billed", f"SELECT * FROM all_billed WHERE {THIS}"),
    NATCO,
    KINDS,
    SEEDS,
    SIGHTINGS,
    B_OWNERS,
    B_AGENTS,
    B_CONTENT,
    RUNS,
    ("today_agents", "SELECT agent_id FROM today_activity UNION SELECT agent_id FROM today_billed"),
    # Base agents have one owner and one host each, so that one new name is one new row.
    (
        "all_owners",
        """SELECT * FROM owners UNION ALL
        SELECT (SELECT max(AgentOwnerID) FROM owners) + row_number() OVER (ORDER BY n), n
        FROM (SELECT DISTINCT split_part(agent_owner, '@', 1) AS n FROM today_billed) t
        WHERE n NOT IN (SELECT AgentOwner FROM owners)""",
    ),
    (
        "agents",
        """SELECT AgentID, Agent FROM by_run UNION ALL
        SELECT (SELECT max(AgentID) FROM by_run) + row_number() OVER (ORDER BY agent_id), split_part(agent_id, '@', 1)
        FROM today_agents WHERE split_part(agent_id, '@', 1) NOT IN (SELECT Agent FROM by_run)""",
    ),
    (
        "alive_activity",
        alive("activity", "time")[1] + f" AND CAST(split_part(s.time, 'T', 1) AS DATE) <> DATE '{ACTIVITY_DAY}' "
        "AND s.NatCo = 'mt' UNION ALL SELECT * FROM today_activity",
    ),
    (
        "alive_billed",
        alive("billed", "start_time")[1]
        + f" AND CAST(split_part(s.start_time, 'T', 1) AS DATE) <> DATE '{ACTIVITY_DAY}' "
        "AND s.NatCo = 'mt' UNION ALL SELECT * FROM today_billed",
    ),
    ("content", CONTENT_MERGED.format(f"({content_sql('alive_activity')}) q")),
    ("conversation", CONVERSATION_MERGED.format(f"({conversation_sql('alive_billed')}) q")),
    (
        "sm",
        f"SELECT CAST(Date AS DATE) AS Date, NatCoID, AgentID, TypeOfConvID, {SM_SUMS} "
        f"FROM ({sm_sql('alive_billed')}) q GROUP BY ALL",
    ),
    (
        "acc",
        f"""SELECT CAST(split_part(time, 'T', 1) AS DATE) AS Date, a.AgentID, user_id
        FROM (SELECT *, {RUN} AS now FROM activity WHERE NatCo = 'mt'
              UNION ALL SELECT *, 999999999 AS now FROM today_activity) r
        LEFT JOIN by_run a ON a.Agent = split_part(r.agent_id, '@', 1) AND a.run < r.now""",
    ),
    body="\nUNION ALL ".join(
        [
            _count("d_natco", "NatCoID", "SELECT * FROM natco"),
            _count("d_conversation_type", "TypeOfConvID", "SELECT * FROM kinds"),
            _count("d_agent", "AgentID", "SELECT * FROM agents"),
            _count("d_agent_owner", "AgentOwnerID", "SELECT * FROM all_owners"),
            _count("d_content_type", "ContentID", "SELECT * FROM contents"),
            _count(
                "ContentDescriptionMapping",
                "ContentID",
                "SELECT * FROM seeds UNION ALL SELECT * FROM contents WHERE Content = 'N/A'",
            ),
            _count("f_message_content", "MTMO_MessagesByType", "SELECT * FROM content"),
            _count("f_message_conversation", "MTMO_messages", "SELECT * FROM conversation"),
            _count("f_conversations_and_sm", "NoOfConv", "SELECT * FROM sm"),
            _count("f_uau_daily", "n", "SELECT Date, AgentID, count(DISTINCT user_id) AS n FROM acc GROUP BY ALL"),
            _count(
                "f_uau_monthly",
                "n",
                "SELECT strftime(Date, '%Y-%m') AS m, AgentID, count(DISTINCT user_id) AS n FROM acc GROUP BY ALL",
            ),
            _count("f_uau_yearly", "n", "SELECT year(Date) AS y, AgentID, count(DISTINCT user_id) AS n FROM acc GROUP BY ALL"),
            _count("f_uau_total", "n", "SELECT AgentID, count(DISTINCT user_id) AS n FROM acc GROUP BY ALL"),
            _count("acc_users_daily", "AgentID", "SELECT * FROM acc"),
        ]
    ),
)

# --- two runs at the same time: as if the second had come after the first ----------------------------------------


def _after(first: str, new: str, key: str) -> str:
    """The rows of ``first`` and those of ``new`` with other keys, numbered in order of the key behind them."""
    return f"""SELECT id, {key} FROM {first} UNION ALL
    SELECT (SELECT max(id) FROM {first}) + row_number() OVER (ORDER BY {key}), {key} FROM ({new}) n
    WHERE {key} NOT IN (SELECT {key} FROM {first})"""


def _run_ids(k: int) -> str:
    return f"SELECT agent_id FROM a{k} UNION SELECT agent_id FROM b{k}"


def _run_owners(k: int) -> str:
    return f"SELECT DISTINCT split_part(agent_owner, '@', 1) AS owner FROM b{k}"


def _two_runs(first: tuple[str, str], second: tuple[str, str]) -> tuple[tuple[str, str], ...]:
    """The rows and the dimensions of two runs, each given by its NatCo and the rows of its files."""
    feeds = [
        (name, f"SELECT * REPLACE ('{natco}' AS NatCo) FROM {feed} WHERE {held}")
        for k, (natco, held) in enumerate((first, second), 1)
        for name, feed in ((f"a{k}", "activity"), (f"b{k}", "billed"))
    ]
    return (activity(early=True), billed(joint=True), NATCO, SEEDS, CONTENT, *feeds, *RUN_DIMENSIONS)


RUN_DIMENSIONS = (
    ("ids1", f"SELECT row_number() OVER (ORDER BY agent_id) AS id, agent_id FROM ({_run_ids(1)}) i"),
    ("ids", _after("ids1", _run_ids(2), "agent_id")),
    ("owners1", f"SELECT row_number() OVER (ORDER BY owner) AS id, owner FROM ({_run_owners(1)}) o"),
    ("owners", _after("owners1", _run_owners(2), "owner")),
    # An agent of the first run keeps the owner it has there, also none.
    (
        "agents",
        """SELECT ids.id AS AgentID, o.id AS AgentOwnerID, split_part(ids.agent_id, '@', 1) AS Agent
        FROM ids LEFT JOIN ids1 USING (agent_id)
        LEFT JOIN (SELECT DISTINCT 1 AS run, agent_id, agent_owner FROM b1 UNION SELECT DISTINCT 2, agent_id, agent_owner FROM b2) w
               ON w.agent_id = ids.agent_id AND w.run = CASE WHEN ids1.id IS NULL THEN 2 ELSE 1 END
        LEFT JOIN owners o ON o.owner = split_part(w.agent_owner, '@', 1)""",
    ),
)
CONCURRENT = _two_runs(("mt", "agent_id >= 'agent15'"), ("cg", "agent_id < 'agent3'"))
ONE_DATE_MORE = _two_runs(("mt", f"FileDate <> DATE '{ACTIVITY_DAY}'"), ("mt", f"FileDate = DATE '{ACTIVITY_DAY}'"))
# The second file replaces its own date and adds to the others.
REPLACED = f"SELECT * FROM a1 WHERE split_part(time, 'T', 1) <> '{ACTIVITY_DAY}' UNION ALL SELECT * FROM a2"
REPLACED_BILLED = f"SELECT * FROM b1 WHERE split_part(start_time, 'T', 1) <> '{ACTIVITY_DAY}' UNION ALL SELECT * FROM b2"

# Agents are looked up as they were before a run: none before the first, those of the first before the second.
USER_GRAINS = {
    "daily": "CAST(Date AS VARCHAR)",
    "monthly": "strftime(Date, '%Y-%m')",
    "yearly": "CAST(year(Date) AS VARCHAR)",
    "total": "CAST(NULL AS VARCHAR)",
}
SEEN_USERS = (
    "acc",
    """SELECT CAST(split_part(time, 'T', 1) AS DATE) AS Date, NatCo, CAST(NULL AS BIGINT) AS AgentID, user_id FROM a1
    UNION ALL SELECT CAST(split_part(time, 'T', 1) AS DATE), NatCo, i.id, user_id
    FROM a2 LEFT JOIN ids1 i ON split_part(i.agent_id, '@', 1) = split_part(a2.agent_id, '@', 1)""",
)

# --- the registered queries -------------------------------------------------------------------------------------

ACTIVITY_COLUMNS = "activity_id, billing_event_id, agent_id, user_id, direction, time, type, size_bytes"
SPLIT_DATE = "DATE '1995-07-01'"
EARLY_LATE = (
    activity(wide=True),
    billed("all_billed", wide=True),
    ("early", f"SELECT * FROM all_billed WHERE FileDate < {SPLIT_DATE}"),
    ("late", f"SELECT * FROM all_billed WHERE FileDate >= {SPLIT_DATE}"),
    ("old_owners", owners_sql("early")),
    (
        "merged_owners",
        f"""SELECT * FROM old_owners UNION ALL
        SELECT (SELECT max(AgentOwnerID) FROM old_owners) + row_number() OVER (ORDER BY AgentOwner), AgentOwner
        FROM ({owners_sql("late")}) n WHERE AgentOwner NOT IN (SELECT AgentOwner FROM old_owners)""",
    ),
)

ORACLES: dict[str, str] = {
    "src_delimited_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "src_multifile": _with(activity(), body=f"SELECT {ACTIVITY_COLUMNS} FROM activity"),
    "src_glob_partitions": _with(*BASE, body=accumulator_sql()),
    "src_feed_by_filename": _with(activity(), body=f"SELECT {ACTIVITY_COLUMNS}, NatCo, FileDate FROM activity"),
    "src_malformed_policy": _with(
        activity(),
        body="""SELECT activity_id, CASE WHEN CAST(activity_id AS BIGINT) % 50 IN (7, 13) THEN NULL ELSE size_bytes END
                AS size_bytes, CASE WHEN CAST(activity_id AS BIGINT) % 50 IN (7, 11, 13) THEN 'quarantined' ELSE 'kept' END
                AS status FROM activity""",
    ),
    "sink_csv_roundtrip": _with(
        *BASE,
        ("means", in_cents(sm_sql())),
        ("merged", SM_HUNDREDTHS.format("means")),
        body=SM_TEXT + "merged",
    ),
    "sink_publish_skip_empty": "SELECT * FROM (VALUES ('d_natco', 'v2'), ('d_agent', 'v2'), ('f_message_content_mt', 'v1')) v(name, version)",
    "publish_concurrent": _with(
        *CONCURRENT, body=CONTENT_MERGED.format(f"({content_sql('a1')} UNION ALL {content_sql('a2')}) q")
    ),
    "publish_concurrent_agents": _with(*CONCURRENT, body="SELECT AgentID, AgentOwnerID, Agent FROM agents"),
    "merge_slices_state": _with(*ONE_DATE_MORE, body=CONTENT_MERGED.format(f"({content_sql(f'({REPLACED})')}) q")),
    "facts_rerun": _with(*ONE_DATE_MORE, body=CONTENT_MERGED.format(f"({content_sql(f'({REPLACED})')}) q")),
    "facts_rerun_conversations": _with(
        *ONE_DATE_MORE, body=CONVERSATION_MERGED.format(f"({conversation_sql(f'({REPLACED_BILLED})')}) q")
    ),
    "uau_incremental": _with(
        *ONE_DATE_MORE,
        SEEN_USERS,
        body=" UNION ALL ".join(
            f"SELECT '{grain}' AS grain, {period} AS period, NatCoID, AgentID, count(DISTINCT user_id) AS users "
            "FROM acc LEFT JOIN natco USING (NatCo) GROUP BY ALL"
            for grain, period in USER_GRAINS.items()
        ),
    ),
    "stage_activity": _with(activity(), body=f"SELECT {ACTIVITY_COLUMNS}, NatCo FROM activity"),
    "stage_events": _with(billed(), body="SELECT * FROM billed"),
    "stage_lookups": _with(
        activity(),
        billed(),
        NATCO,
        KINDS,
        SEEDS,
        body="""SELECT 'natco' AS lookup, CAST(NatCoID AS BIGINT) AS id, NatCo AS text,
                       (SELECT count(*) FROM activity a WHERE a.NatCo = natco.NatCo) AS feed_rows FROM natco
                UNION ALL SELECT 'content', ContentID, Content,
                       (SELECT count(*) FROM activity a WHERE a.type = OriginalContent) FROM seeds
                UNION ALL SELECT 'conversation_type', TypeOfConvID, Description,
                       (SELECT count(*) FROM billed b WHERE (b.type = 'p2a_conversation') = (TypeOfConvID = 2)) FROM kinds""",
    ),
    "acc_users_daily_roll": _with(
        activity(wide=True),
        billed("all_billed", wide=True),
        ("billed", "SELECT * FROM all_billed WHERE type = 'p2a_conversation'"),
        OWNERS,
        ("agents", agents_sql("SELECT agent_id FROM billed", "billed")),
        body=accumulator_sql(),
    ),
    "guard_empty_inputs": _with(
        activity(),
        billed(joint=True),
        ("dates", "SELECT FileDate FROM activity UNION SELECT FileDate FROM billed"),
        (f"names(NatCo)", "VALUES " + ", ".join(f"('{n}')" for n in NATCO_ORDER)),
        ("a", "SELECT FileDate, NatCo, count(*) AS n FROM activity GROUP BY ALL"),
        ("b", "SELECT FileDate, NatCo, count(*) AS n FROM billed GROUP BY ALL"),
        body="""SELECT FileDate, NatCo, coalesce(a.n, 0) AS activity_rows, coalesce(b.n, 0) AS event_rows,
                       coalesce(a.n, 0) + coalesce(b.n, 0) > 0 AS has_data
                FROM dates CROSS JOIN names LEFT JOIN a USING (FileDate, NatCo) LEFT JOIN b USING (FileDate, NatCo)""",
    ),
    "stage_run_slice": _with(
        activity(), body=f"SELECT * FROM activity WHERE FileDate = DATE '{ACTIVITY_DAY}' AND NatCo = 'mt'"
    ),
    "d_natco": _with(
        activity(),
        NATCO,
        body="""SELECT natco.NatCo, NatCoID, a.activity_rows FROM natco LEFT JOIN
                (SELECT NatCo, count(*) AS activity_rows FROM activity GROUP BY 1) a ON a.NatCo = natco.NatCo""",
    ),
    "d_conversation_type": _with(
        billed(),
        KINDS,
        body="""SELECT TypeOfConvID, TypeOfConv, Description, event_rows FROM kinds LEFT JOIN
                (SELECT CASE WHEN type = 'p2a_conversation' THEN 2 ELSE 1 END AS k, count(*) AS event_rows
                 FROM billed GROUP BY 1) b ON k = TypeOfConvID""",
    ),
    "dim_agent_owner_daily": _with(billed(wide=True), body=owners_sql("billed")),
    "dim_agent_daily": _with(activity(wide=True), billed(wide=True), OWNERS, body=agents_sql(BOTH, "billed")),
    "dim_content_type_daily": _with(activity(), SEEDS, body=CONTENT[1]),
    "content_mapping_extend": _with(activity(), SEEDS, body=f"SELECT * FROM seeds UNION ALL {NEW_TYPES}"),
    "dim_content_type_per_activity": _with(
        activity(),
        SEEDS,
        PER_ACTIVITY,
        body="""SELECT * FROM seeds WHERE OriginalContent IN (SELECT type FROM activity)
                UNION ALL SELECT ContentID, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM per_activity""",
    ),
    "content_mapping_extend_per_activity": _with(
        activity(), SEEDS, PER_ACTIVITY, body="SELECT * FROM seeds UNION ALL SELECT ContentID, type, 'N/A' FROM per_activity"
    ),
    "scd_agent_owner": _with(*EARLY_LATE, body="SELECT * FROM merged_owners"),
    "scd_agent": _with(
        *EARLY_LATE,
        ("old", agents_sql("SELECT agent_id FROM early", "early", "old_owners")),
        ("new", agents_sql("SELECT agent_id FROM activity UNION SELECT agent_id FROM late", "late", "merged_owners")),
        body="""SELECT AgentID, AgentOwnerID, Agent FROM old UNION ALL
                SELECT (SELECT max(AgentID) FROM old) + row_number() OVER (ORDER BY AgentID, AgentOwnerID NULLS FIRST),
                       AgentOwnerID, Agent
                FROM new WHERE Agent NOT IN (SELECT Agent FROM old)""",
    ),
    "scd_content_type": _with(
        activity(),
        SEEDS,
        PER_ACTIVITY,
        body="""SELECT * FROM seeds WHERE OriginalContent IN (SELECT type FROM activity)
                UNION ALL SELECT ContentID, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM per_activity
                UNION ALL SELECT ContentID, type, 'N/A' FROM per_activity""",
    ),
    "fact_message_content_daily": _with(*BASE, body=content_sql()),
    "fact_message_conversation_daily": _with(*BASE, body=conversation_sql()),
    "fact_conversation_sm_daily": _with(*BASE, body=sm_sql()),
    "merge_date_slice": _with(
        *BASE,
        *split("activity", ACTIVITY_DAY),
        ("old", CONTENT_MERGED.format(f"({content_sql('others')}) q")),
        body=f"""SELECT Date, NatCoID, ContentID, AgentID, MT_MessagesByType, MO_MessagesByType, MTMO_MessagesByType
                 FROM old WHERE Date <> DATE '{ACTIVITY_DAY}'
                 UNION ALL SELECT CAST(Date AS DATE), NatCoID, ContentID, AgentID, MT_MessagesByType, MO_MessagesByType,
                 MTMO_MessagesByType FROM ({content_sql("slice")}) q""",
    ),
    "merge_message_content": _with(
        *BASE,
        *split("activity", ACTIVITY_DAY),
        ("rows", f"SELECT * FROM ({content_sql('others')}) o WHERE Date <> '{ACTIVITY_DAY}' UNION ALL {content_sql('slice')}"),
        body=CONTENT_MERGED.format("rows"),
    ),
    "merge_message_conversation": _with(
        *BASE,
        *split("billed", EVENTS_DAY),
        ("rows", f"SELECT * FROM ({conversation_sql('others')}) o WHERE Date <> '{EVENTS_DAY}' UNION ALL {conversation_sql('slice')}"),
        body=CONVERSATION_MERGED.format("rows"),
    ),
    "merge_conversation_sm": _with(
        *BASE,
        *split("billed", EVENTS_DAY),
        ("old_means", in_cents(sm_sql("others"))),
        ("new_means", in_cents(sm_sql("slice"))),
        ("old", SM_HUNDREDTHS.format("old_means")),
        (
            "rows",
            f"""SELECT * FROM old WHERE Date <> DATE '{EVENTS_DAY}' UNION ALL
            SELECT CAST(Date AS DATE), NatCoID, AgentID, TypeOfConvID, cents, NoOfConv, NoOfSM, NoOfBM FROM new_means""",
        ),
        ("merged", SM_HUNDREDTHS.format("rows")),
        body=SM_TEXT + "merged",
    ),
    "uau_daily": uau("Date", "UAU_daily"),
    "uau_monthly": uau("strftime(Date, '%Y-%m') AS YearMonth", "UAU_monthly"),
    "uau_yearly": uau("CAST(year(Date) AS INT) AS Year", "UAU_yearly"),
    "uau_total": uau("", "UAU_total"),
    "uau_cross_natco": _with(
        *BASE,
        ("acc", accumulator_sql()),
        body="SELECT DISTINCT AgentID, NatCoID, Date, user_id FROM acc LEFT JOIN natco USING (NatCo)",
    ),
    "run_daily_all": RUN_DAILY,
    "backfill_dims": _with(*B_WIDE, SIGHTINGS, B_OWNERS, B_AGENTS, body="SELECT AgentID, AgentOwnerID, Agent FROM by_run"),
    "backfill_dims_owner": _with(*B_WIDE, SIGHTINGS, B_OWNERS, body="SELECT AgentOwnerID, AgentOwner FROM owners"),
    "backfill_dims_content": _with(activity(early=True), SEEDS, body=B_CONTENT[1]),
    "backfill_facts": _with(
        *B_BASE,
        alive("activity", "time"),
        body=CONTENT_MERGED.replace("NatCoID,", "NatCo, NatCoID,").format(f"({per_natco(content_sql('alive'))}) q"),
    ),
    "backfill_facts_conversation": _with(
        *B_BASE,
        alive("billed", "start_time"),
        body=CONVERSATION_MERGED.replace("NatCoID,", "NatCo, NatCoID,").format(f"({per_natco(conversation_sql('alive'))}) q"),
    ),
    "backfill_average_duration": AVERAGE_DURATION,
    "backfill_users": _with(
        *B_BASE,
        body=f"""SELECT r.NatCo, CAST(split_part(time, 'T', 1) AS DATE) AS Date, NatCoID, AgentID,
                        count(DISTINCT user_id) AS UAU_daily
                 FROM (SELECT *, {RUN} AS now FROM activity) r
                 LEFT JOIN by_run a ON a.Agent = split_part(r.agent_id, '@', 1) AND a.run < r.now
                 LEFT JOIN natco n ON n.NatCo = r.NatCo GROUP BY ALL""",
    ),
}
ORACLES["merge_touched_dates"] = ORACLES["merge_message_content"]

# Dates one half after the other, on the state in between, come to the same as all at once.
ORACLES["backfill_onto_state_facts"] = ORACLES["backfill_facts"]
ORACLES["backfill_onto_state_average_duration"] = ORACLES["backfill_average_duration"]
ORACLES["backfill_onto_state_dims"] = ORACLES["backfill_dims"]
ORACLES["backfill_onto_state_users"] = ORACLES["backfill_users"]
ORACLES["uau_daily_years"] = uau("Date", "UAU_daily", years=True)
ORACLES["uau_monthly_years"] = uau("strftime(Date, '%Y-%m') AS YearMonth", "UAU_monthly", years=True)
ORACLES["uau_yearly_years"] = uau("CAST(year(Date) AS INT) AS Year", "UAU_yearly", years=True)
ORACLES["uau_total_years"] = uau("", "UAU_total", years=True)
ORACLES["acc_users_daily_compacted"] = f"SELECT * FROM ({ORACLES['acc_users_daily_roll']}) rolled WHERE NatCo = 'mt'"
