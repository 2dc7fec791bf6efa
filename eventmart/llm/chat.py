"""Conversations rebuilt from their event logs and rendered with a turn template.

Log rows are ``message`` (a whole turn), ``delta`` (streamed text of a message), ``edit`` (new text
for a message) and ``regenerate`` (drop what a message had so far). All SQL expressions.

Template: ``<|turn|>ROLE<|text|>TEXT<|end|>\\n`` for each turn. In roles and texts each of ``<``,
``[`` and the backslash is followed by a backslash, so no control string of this or another
template survives in them, and taking away the second character of such pairs gives them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[\\])", r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[\\])\\", "$1")


def fold(log: DataFrame) -> DataFrame:
    """Final messages (conv_id, seq, message_id, role, text) of a log.

    ``log``: conv_id, seq, message_id, kind, role, text. Rows of one message are folded in the
    order of (seq, kind, text): an edit or a whole message replaces what came before, a regenerate
    empties it, deltas are appended. The message keeps its first seq and first non-null role. A null
    message_id makes each of its rows a message of its own, repeated rows too; unknown kinds count
    as deltas; null texts are empty.
    """
    event = F.struct("seq", F.coalesce("kind", F.lit("delta")).alias("kind"), F.coalesce("text", F.lit("")).alias("text"))
    alone = log.where("message_id is null").select(
        "conv_id", "seq", "message_id", "role",
        F.when(F.col("kind") == "regenerate", "").otherwise(F.coalesce("text", F.lit(""))).alias("text"),
    )
    grouped = (
        log.where("message_id is not null")
        .groupBy("conv_id", "message_id")
        .agg(F.min("seq").alias("seq"), F.min_by("role", F.struct(F.col("role").isNull(), "seq", "role")).alias("role"),
             F.array_sort(F.collect_list(event)).alias("events"))
    )
    numbered = grouped.withColumn(
        "reset", F.expr("array_max(transform(events, (e, i) -> if(e.kind in ('message', 'edit', 'regenerate'), i, 0)))")
    )
    kept = F.expr("array_join(transform(filter(events, (e, i) -> i >= reset and e.kind != 'regenerate'), e -> e.text), '')")
    return alone.unionByName(numbered.select("conv_id", "seq", "message_id", "role", kept.alias("text")))


def render(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """conv_id, formatted text, and its segments (text, loss) that concatenate to it.

    Turns go by (seq, role, text), nulls first; a null role is empty. Segments with ``loss`` are the
    escaped texts of ``trained_role``: what a model is trained on. A conversation is one row, so it
    must fit into one.
    """
    role = F.coalesce("role", F.lit(""))
    text = escape(F.coalesce("text", F.lit("")))
    segments = F.array(
        F.struct(F.concat(F.lit(TURN), escape(role), F.lit(TEXT)).alias("text"), F.lit(False).alias("loss")),
        F.struct(text.alias("text"), (role == trained_role).alias("loss")),
        F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
    )
    turns = messages.select("conv_id", F.struct("seq", "role", "text", segments.alias("segments")).alias("turn"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns")).select(
        "conv_id",
        F.flatten("turns.segments").alias("segments"),
    ).withColumn("formatted", F.array_join("segments.text", ""))


def parse(formatted: Column) -> Column:
    """array of (role, text) read back from a formatted text."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>\n", -1), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), TEXT, 1)).alias("role"),
            unescape(F.substr(p, F.instr(p, TEXT) + len(TEXT))).alias("text"),
        ),
    )


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them."""
    turns = parse(F.col("formatted"))
    loss = unescape(F.array_join(F.expr("transform(filter(segments, s -> s.loss), s -> s.text)"), ""))
    read = formatted.select("conv_id", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
