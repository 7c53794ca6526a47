"""The three lookups: read from ``;``-separated files, or the seed rows every installation starts from."""

from pyspark.sql import DataFrame, SparkSession

from palaver import schemas
from palaver.sources.delimited import SEMICOLONS, read_delimited
from palaver.workspace import literal_table

# The lookup rows and the names of their files.
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
NATCO_FILE = "NatCoMapping.csv"
CONVERSATION_TYPE_FILE = "ConvTypeMapping.csv"
CONTENT_FILE = "ContentDescriptionMapping.csv"


def natcos(spark: SparkSession, folder: str | None = None) -> DataFrame:
    if folder is None:
        return literal_table(spark, NATCOS, schemas.NATCO)
    return read_delimited(spark, f"{folder.rstrip('/')}/{NATCO_FILE}", schemas.NATCO, SEMICOLONS)


def conversation_types(spark: SparkSession, folder: str | None = None) -> DataFrame:
    if folder is None:
        return literal_table(spark, CONVERSATION_TYPES, schemas.CONVERSATION_TYPE)
    path = f"{folder.rstrip('/')}/{CONVERSATION_TYPE_FILE}"
    return read_delimited(spark, path, schemas.CONVERSATION_TYPE, SEMICOLONS)


def content_mapping(spark: SparkSession, folder: str | None = None) -> DataFrame:
    """The content lookup; the seed rows for a first run. Later runs read the one the previous run published."""
    if folder is None:
        return literal_table(spark, CONTENTS, schemas.CONTENT_MAPPING)
    return read_delimited(spark, f"{folder.rstrip('/')}/{CONTENT_FILE}", schemas.CONTENT_MAPPING, SEMICOLONS)
