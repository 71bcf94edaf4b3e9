"""Chat formatting from an event log: fold streamed deltas, edits and regenerations into messages, then render them.

An event is (conversation, message, seq, kind, role, text):

* ``message`` opens a message with a text, ``edit`` replaces its text, ``regenerate`` empties it to be written again,
* ``delta`` adds to its text,
* ``delete`` takes the message away (a later ``message`` or ``edit`` brings it back).

The template marks each turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside texts are escaped by one
more backslash between ``<`` and ``|``, which no mark has, so that reading back is exact for every text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
RESETS = ("message", "edit", "regenerate", "delete")


def escape(text: Column) -> Column:
    r"""``<|`` becomes ``<\|``, ``<\|`` becomes ``<\\|`` and so on."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    r"""A role is one line: a backslash is doubled and a line end becomes ``\n`` before marks are escaped."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # Every backslash that is left stands before a backslash or an n.
    plain = F.regexp_replace(unescape(role), r"\\n|\\\\", "$0\u0000")
    return F.replace(F.replace(plain, F.lit("\\n\u0000"), F.lit("\n")), F.lit("\\\\\u0000"), F.lit("\\"))


def fold(events: DataFrame, *, conv: str = "conv_id", message: str = "message_id") -> DataFrame:
    """(conv, seq, role, text): one row per message that is left, ``seq`` that of its first event.

    Each message is folded by its own group, so that the deltas of a long conversation are spread over tasks; a group
    holds the events of one message, as its result does. Events of equal seq fold in the order message, edit,
    regenerate, delete, delta, then by text. The role is the last one that is not null. Null texts add nothing. Null
    conversations and messages are keys like others; a null seq comes first. An unknown kind is an error.
    """
    rank = F.lit(None).cast("int")
    for n, kind in enumerate((*RESETS, "delta")):
        rank = F.when(F.col("kind") == kind, n).otherwise(rank)
    rank = F.when(rank.isNull(), F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce(F.col("kind"), F.lit("null"))))).otherwise(rank)
    event = F.struct(F.col("seq").alias("seq"), rank.alias("rank"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.col("role").alias("role"))
    groups = events.groupBy(conv, message).agg(F.sort_array(F.collect_list(event)).alias("log"))
    delta = len(RESETS)
    last = F.coalesce(F.array_max(F.transform(F.col("log"), lambda e, i: F.when(e["rank"] < delta, i))), F.lit(0))
    groups = groups.withColumn("__last", last)
    head = F.get(F.col("log"), F.col("__last"))
    tail = F.slice(F.col("log"), F.col("__last") + 1, F.size("log"))
    kept = F.transform(tail, lambda e: F.when(e["rank"] == RESETS.index("regenerate"), "").otherwise(e["text"]))
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return groups.filter(head["rank"] != RESETS.index("delete")).select(
        F.col(conv),
        F.get(F.col("log"), F.lit(0))["seq"].alias("seq"),
        F.coalesce(F.element_at(F.when(F.size(roles) > 0, roles), -1), F.lit("")).alias("role"),
        F.array_join(kept, "").alias("text"),
    )


def render(messages: DataFrame, *, conv: str = "conv_id", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv, n_turns, segments): the formatted text as consecutive parts, each with whether it counts for the loss.

    Turns are in the order of seq (nulls first), then role, then text; repeated rows are turns of their own. Joining the
    parts gives the text; the parts under the mask are the escaped texts of ``loss_roles`` alone, without marks. A
    conversation is one value, so its turns meet in one group, of the size of what it is turned into.
    """
    turn = F.struct(F.col("seq"), F.col("role"), F.col("text"))
    turns = messages.groupBy(conv).agg(F.sort_array(F.collect_list(turn)).alias("__turns"))

    def parts(t: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), t["role"].isin(*loss_roles).alias("loss")),
            F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")),
        )

    return turns.select(F.col(conv), F.size("__turns").cast("long").alias("n_turns"), F.flatten(F.transform("__turns", parts)).alias("segments"))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """What the mask covers, unescaped part by part, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def read_back(text: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    pieces = F.filter(F.split(text, r"<\|im_start\|>", -1), lambda _, i: i > 0)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, "\n")
        body = F.substring(piece, at + 1, F.length(piece) - at - len(END) - 1)
        return F.struct(unescape_role(F.substring(piece, F.lit(1), at - 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def format_log(events: DataFrame, *, conv: str = "conv_id", message: str = "message_id", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """An event log as one row per conversation: conv, n_turns, segments, formatted. A conversation whose messages are
    all deleted has no row; an empty log gives no rows. Other columns are ignored."""
    done = render(fold(events, conv=conv, message=message), conv=conv, loss_roles=loss_roles)
    return done.withColumn("formatted", formatted(F.col("segments")))
