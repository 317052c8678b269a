"""Chat formatting by event-sourced reconstruction (native).

The log of a conversation holds events of its messages: ``delta`` appends a
streamed piece, ``regenerate`` throws away what was streamed so far, ``edit``
replaces it.  Events are partitioned by conversation and message, sorted by
sequence and folded to the final text; messages are then ordered by turn and
rendered.  A hot conversation's events spread over its messages; only its
final text (its one output row) is put together in one place.

The template is ``### ROLE: TEXT</turn>`` and a newline per turn.  ``\\``,
``#``, ``<`` (and ``:`` in roles) are escaped by a backslash, so neither
marker can appear inside a text, and reading back is exact.

Defined results: null texts, payloads and roles are empty; null turns come
first; rows of one turn are ordered by role, then text, and repeated rows are
turns of their own; a null conv_id is one conversation; an empty log gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Template marks.
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
TURN = r"(?s)### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.)*+)</turn>\n"
TRAINED_ROLE = "assistant"


def events_of(messages: DataFrame) -> DataFrame:
    """An event log whose fold gives ``messages`` (conv_id, turn, role, text).

    Depending on the text's checksum a message arrives as two deltas, as a
    draft that is regenerated, or as a wrong piece that is edited.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    half = (F.length(text) / 2).cast("int")
    first, second = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))

    def event(kind, payload):
        return F.struct(F.lit(kind).alias("kind"), payload.alias("payload"))

    delta1, delta2 = event("delta", first), event("delta", second)
    log = F.when(F.crc32(text.cast("binary")) % 3 == 0, F.array(delta1, delta2)) \
        .when(F.crc32(text.cast("binary")) % 3 == 1, F.array(delta1, event("regenerate", F.lit(None).cast("string")), delta1, delta2)) \
        .otherwise(F.array(delta2, event("edit", first), delta2))
    # The position of a row in the table's files names its message.
    return (messages.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
                            F.monotonically_increasing_id().alias("message"), log.alias("log"))
            .select("conv_id", "turn", "role", "message", F.posexplode("log").alias("seq", "event"))
            .select("conv_id", "turn", "role", "message", "seq", "event.kind", "event.payload"))


def fold_messages(log: DataFrame) -> DataFrame:
    """Final messages of an event log: conv_id, turn, role, text."""
    events = (log.groupBy("conv_id", "message")
              .agg(F.min("turn").alias("turn"), F.min("role").alias("role"),
                   F.array_sort(F.collect_list(F.struct("seq", "kind", "payload"))).alias("events")))
    # What counts starts at the last event that is not a delta.
    start = F.array_max(F.transform("events", lambda x, i: F.when(x["kind"] == "delta", 0).otherwise(i)))
    alive = F.slice("events", start + 1, F.size("events"))
    return events.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.array_join(
        F.transform(alive, lambda x: F.coalesce(x["payload"], F.lit(""))), "").alias("text"))


def escape(text: Column, also: str = "") -> Column:
    return F.regexp_replace(text, rf"([\\#<{also}])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted."""
    turn = F.concat(F.lit(OPEN), escape(F.col("role"), ":"), F.lit(COLON), escape(F.col("text")), F.lit(CLOSE))
    lines = messages.select("conv_id", F.struct("turn", "role", "text", turn.alias("line")).alias("m"))
    return (lines.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("m"))
            .select("conv_id", F.array_join(F.transform("m", lambda x: x["line"]), "").alias("formatted")))


def parse(formatted: Column) -> Column:
    """array<struct<role,text,loss,head,body>> read back from rendered text.

    ``loss`` marks the trained turns; ``head`` and ``body`` are the lengths in
    code points of a turn's opening and escaped text, so the runs
    (head, body, close) of all turns cover the text: the loss mask.
    """
    pairs = F.arrays_zip(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(1)).alias("role"),
                         F.regexp_extract_all(formatted, F.lit(TURN), F.lit(2)).alias("body"))
    return F.transform(pairs, lambda p: F.struct(
        unescape(p["role"]).alias("role"), unescape(p["body"]).alias("text"),
        (unescape(p["role"]) == TRAINED_ROLE).alias("loss"),
        (F.length(p["role"]) + len(OPEN) + len(COLON)).alias("head"), F.length(p["body"]).alias("body")))


def format_log(log: DataFrame) -> DataFrame:
    """Event log to conv_id, formatted, turns (with the loss mask)."""
    return render(fold_messages(log)).withColumn("turns", parse(F.col("formatted")))


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts hold the template's own control strings."""
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))


def digest_columns(chats: DataFrame) -> DataFrame:
    all_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss_text = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(all_text, 256).alias("turns_sha256"),
                        F.length(loss_text).cast("long").alias("loss_chars"), F.sha2(loss_text, 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"))
