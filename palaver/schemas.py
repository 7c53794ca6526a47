"""Explicit schemas of every feed, lookup and stored table.

Nothing in the library infers a schema: inference costs one job per file and lets the type of an id or a date
depend on the rows that happen to be in the file.
"""

from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


ACTIVITY = _schema(
    activity_id=StringType,
    billing_event_id=StringType,
    agent_id=StringType,
    user_id=StringType,
    direction=StringType,
    time=StringType,
    type=StringType,
    size_bytes=LongType,
)

EVENTS = _schema(
    billing_event_id=StringType,
    type=StringType,
    agent_id=StringType,
    agent_owner=StringType,
    billing_party=StringType,
    max_duration_single_message=LongType,
    max_duration_a2p_conversation=LongType,
    max_duration_p2a_conversation=LongType,
    start_time=StringType,
    duration=LongType,
    mt_messages=LongType,
    mo_messages=LongType,
    size_kilobytes=LongType,
    agent_name=StringType,
    owner_name=StringType,
)

NATCO = _schema(NatCo=StringType, NatCoID=IntegerType)
CONVERSATION_TYPE = _schema(TypeOfConvID=IntegerType, TypeOfConv=StringType, Description=StringType)
CONTENT_MAPPING = _schema(ContentID=LongType, OriginalContent=StringType, Content=StringType)

AGENT_OWNER = _schema(AgentOwnerID=LongType, AgentOwner=StringType)
AGENT = _schema(AgentID=LongType, AgentOwnerID=LongType, Agent=StringType)
CONTENT_TYPE = CONTENT_MAPPING

MESSAGE_CONTENT = _schema(
    Date=DateType,
    NatCoID=IntegerType,
    ContentID=LongType,
    AgentID=LongType,
    MT_MessagesByType=LongType,
    MO_MessagesByType=LongType,
    MTMO_MessagesByType=LongType,
)
MESSAGE_CONVERSATION = _schema(
    Date=DateType,
    NatCoID=IntegerType,
    AgentID=LongType,
    TypeOfConvID=StringType,
    MO_messages=LongType,
    MT_messages=LongType,
    MTMO_messages=LongType,
)
# AverageDuration is stored as text with a decimal comma.
CONVERSATIONS_AND_SM = _schema(
    Date=DateType,
    NatCoID=IntegerType,
    AgentID=LongType,
    TypeOfConvID=StringType,
    AverageDuration=StringType,
    NoOfConv=LongType,
    NoOfSM=LongType,
    NoOfBM=LongType,
)
# What each file adds to a fact. A mean duration is the sum and the number of a file's means, in hundredths.
MESSAGE_CONTENT_BY_FILE = StructType([StructField("FileDate", DateType()), *MESSAGE_CONTENT])
MESSAGE_CONVERSATION_BY_FILE = StructType([StructField("FileDate", DateType()), *MESSAGE_CONVERSATION])
CONVERSATIONS_AND_SM_BY_FILE = _schema(
    FileDate=DateType,
    Date=DateType,
    NatCoID=IntegerType,
    AgentID=LongType,
    TypeOfConvID=StringType,
    DurationTotal=LongType,
    DurationCount=LongType,
    NoOfConv=LongType,
    NoOfSM=LongType,
    NoOfBM=LongType,
)
USER_ACCUMULATOR = _schema(
    FileDate=DateType, Date=DateType, NatCo=StringType, AgentID=LongType, user_id=StringType
)
USER_MONTHS = _schema(
    FileDate=DateType, NatCo=StringType, Month=DateType, AgentID=LongType, user_id=StringType, Days=LongType
)
USER_YEARS = _schema(NatCo=StringType, Year=IntegerType, AgentID=LongType, user_id=StringType, Months=LongType)
UAU_DAILY = _schema(Date=DateType, NatCoID=IntegerType, AgentID=LongType, UAU_daily=LongType)
UAU_MONTHLY = _schema(YearMonth=StringType, NatCoID=IntegerType, AgentID=LongType, UAU_monthly=LongType)
UAU_YEARLY = _schema(Year=IntegerType, NatCoID=IntegerType, AgentID=LongType, UAU_yearly=LongType)
UAU_TOTAL = _schema(NatCoID=IntegerType, AgentID=LongType, UAU_total=LongType)
UAU = _schema(AgentID=LongType, NatCoID=IntegerType, Date=DateType, user_id=StringType)
