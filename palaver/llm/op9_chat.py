"""Operator 9: chat formatting in budgeted windows; DataFrame functions only.

The prefix sum of turn tokens says in which span of ``span`` tokens a turn starts; the turns that start in a span make a
window, so a window is cut between turns only and nothing is left out of a turn that is longer than the span. In front
of its own turns a window repeats the system turn that opens the conversation, and the last turns before it as long as
they have at most ``history`` tokens. What is repeated is not under the loss mask.

Turns are numbered and summed in two steps, inside ranges of turn numbers and over the sums of ranges, so that a long
conversation is spread over many tasks.

A turn is ``<|turn|>role<|text|>text<|end|>``. In roles and texts every ``<``, ``[`` and ``\\`` is followed by a ``\\``, so
no control string, of this template or one in brackets, can come from a text; taking these away gives the text back.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palaver.llm.tables import read
from palaver.workspace import write_once

SPAN = 1024
HISTORY = 256
RANGE = 256
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def numbered(turns: DataFrame, rows: int = RANGE) -> DataFrame:
    """``conv_id``, ``role``, ``text``, ``tokens``, ``place`` (from 0) and ``before``, the tokens of earlier turns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    turns = turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce(F.col("role"), F.lit("")).alias("role"), text.alias("text"))
    turns = turns.withColumns({"tokens": F.regexp_count("text", F.lit(TOKEN)) + 3, "range": F.floor(F.col("turn") / rows)})
    inside = Window.partitionBy("conv_id", "range").orderBy("turn", "role", "text")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumns({"_place": F.row_number().over(inside) - 1, "_before": F.coalesce(F.sum("tokens").over(earlier), F.lit(0))})

    up_to = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = turns.groupBy("conv_id", "range").agg(F.count("*").alias("_n"), F.sum("tokens").alias("_sum"))
    ranges = ranges.select(
        F.col("conv_id").alias("c"), F.col("range").alias("r"), F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_n"), F.coalesce(F.sum("_sum").over(up_to), F.lit(0)).alias("_sum")
    )
    joined = turns.join(ranges, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("range").eqNullSafe(F.col("r")))
    return joined.select("conv_id", "role", "text", "tokens", (F.col("_place") + F.col("_n")).alias("place"), (F.col("_before") + F.col("_sum")).alias("before"))


def windows(turns: DataFrame, span: int = SPAN, history: int = HISTORY) -> DataFrame:
    """``conv_id``, ``window``, ``formatted``, ``n_repeated``, ``loss`` of the conversations in ``turns``.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``; other columns are ignored. Rows go by turn, null first, and of
    one turn by role and text, so repeated rows are turns of their own. A null text or role is empty, a null conv_id is
    a conversation. The first ``n_repeated`` turns of ``formatted`` are the repeated ones; ``loss`` has the ranges of code
    points (``start``, ``stop``) that are trained on, the escaped texts of the window's own assistant turns. An empty table
    gives no rows.
    """
    rows = numbered(turns).withColumn("window", F.floor(F.col("before") / span))
    in_window = Window.partitionBy("conv_id", "window")
    rows = rows.withColumn("stop", F.max(F.col("before") + F.col("tokens")).over(in_window))
    own = F.struct(F.col("window"), F.lit(True).alias("own"))
    again = F.struct(F.floor(F.col("stop") / span).alias("window"), F.lit(False).alias("own"))
    goes_on = F.floor(F.col("stop") / span) > F.col("window")  # else no turn follows
    repeats = goes_on & (F.col("stop") - F.col("before") <= history) & ~((F.col("place") == 0) & (F.col("role") == "system"))
    rows = rows.withColumn("use", F.explode(F.when(repeats, F.array(own, again)).otherwise(F.array(own))))

    turn = F.struct("place", F.col("use.own").alias("own"), escaped(F.col("role")).alias("role"), escaped(F.col("text")).alias("text"))
    found = rows.groupBy("conv_id", F.col("use.window").alias("window")).agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.max("use.own").alias("real"))
    found = found.where("real")

    system = rows.where("place = 0 AND role = 'system' AND use.own")
    opening = F.array(F.struct(F.col("place"), F.lit(False).alias("own"), escaped(F.col("role")).alias("role"), escaped(F.col("text")).alias("text")))
    system = system.select(F.col("conv_id").alias("c"), opening.alias("opening"))
    found = found.join(system, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    first = F.element_at("turns", 1)["place"] == 0
    found = found.select("conv_id", "window", F.when(F.col("opening").isNull() | first, F.col("turns")).otherwise(F.concat("opening", "turns")).alias("turns"))

    def piece(t: Column) -> Column:
        return F.concat(F.lit(TURN), t["role"], F.lit(TEXT), t["text"], F.lit(END))

    def add(so_far: Column, t: Column) -> Column:
        start = so_far["length"] + F.lit(len(TURN + TEXT)).cast("bigint") + F.length(t["role"])
        stop = start + F.length(t["text"])
        target = t["own"] & (t["role"] == "assistant")
        ranges = F.when(target, F.array_append(so_far["loss"], F.struct(start.alias("start"), stop.alias("stop")))).otherwise(so_far["loss"])
        return F.struct((stop + len(END)).alias("length"), ranges.alias("loss"))

    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return found.select(
        "conv_id",
        "window",
        F.array_join(F.transform("turns", piece), "").alias("formatted"),
        F.size(F.filter("turns", lambda t: ~t["own"])).alias("n_repeated"),
        F.aggregate("turns", F.struct(F.lit(0).cast("bigint").alias("length"), none.alias("loss")), add)["loss"].alias("loss"),
    )


def read_back(found: DataFrame) -> DataFrame:
    """``conv_id``, ``window``, ``turns`` (``role``, ``text``), ``targets`` (texts under the loss mask) from formatted windows."""

    def parsed(piece: Column) -> Column:
        parts = F.split(piece, rf"\Q{TEXT}\E", 2)
        return F.struct(unescaped(F.substring(parts[0], len(TURN) + 1, 2**31 - 1)).alias("role"), unescaped(parts[1]).alias("text"))

    pieces = F.split("formatted", rf"\Q{END}\E", -1)
    pieces = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))

    def target(s: Column) -> Column:
        return unescaped(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))

    return found.select("conv_id", "window", F.length("formatted").cast("bigint").alias("length"), F.transform(pieces, parsed).alias("turns"), F.transform("loss", target).alias("targets"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, formatted and read back, as digests."""
    says = "</s>[INST] ok [/INST]"
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", f"'{says}' AS text")
    back = read_back(write_once(windows(turns.unionByName(added)), "windows"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    row = F.struct("window", F.size("turns").alias("n"), told.alias("told"), F.array_join("targets", "").alias("loss"))
    whole = back.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("w"), F.sum("length").alias("formatted_chars"), F.sum(F.size("turns")).alias("n_turns"))
    whole = whole.select("conv_id", "n_turns", F.array_join("w.told", "").alias("told"), F.array_join("w.loss", "").alias("loss"), "formatted_chars")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2("told", 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
