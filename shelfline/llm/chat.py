"""Conversations from event logs, rendered for training, in DataFrame operations only.

A log has one row per event of a conversation, ordered by ``seq``:

* ``message``    opens turn ``turn`` of ``role`` with ``text``
* ``delta``      appends ``text`` to the turn, as streaming does
* ``edit``       replaces the text of the turn and drops all later turns written before it
* ``regenerate`` empties the turn for new deltas, and likewise drops later turns

An event is dead if a later event of the log starts the same or an earlier turn anew.  What is left of a turn is
one start and the deltas after it.  Folding goes over blocks of a log first, so a very long log is cut
into parts for the search of later starts.

Rendering puts each turn between control strings; control strings inside texts are broken by a
backslash, and backslashes are doubled, so reading back is exact.  The loss mask is carried by segments: the
formatted text is the segments' texts one after the other, and only those marked ``loss`` are trained on.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, BODY, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
# Control strings of this template and of others that must not be taken for control when they occur in texts.
CONTROL = (OPEN, BODY, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
TRAINED_ROLES = ("assistant",)
STARTS = ("message", "edit", "regenerate")
# Events of a log that one window sorts; longer logs are cut.
LOG_BLOCK = 4096
DELTA_CHARS = 64


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put behind the first character of each control string."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    heads = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)
    return F.regexp_replace(doubled, f"({heads})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def live_events(events: DataFrame, block: int = LOG_BLOCK) -> DataFrame:
    """Events (``conv_id``, ``seq``, ``kind``, ``turn``, ``role``, ``text``) that no later start makes dead.

    ``seq`` numbers the events of a conversation from 0 without large gaps; its quotient by ``block`` cuts long logs.
    """
    starts = F.when(F.col("kind").isin(*STARTS), F.col("turn"))
    rows = events.withColumns({"_block": F.floor(F.col("seq") / block), "_start": starts})
    # Per block the earliest turn that it starts anew; few rows, even for a long log.
    blocks = rows.groupBy("conv_id", "_block").agg(F.min("_start").alias("_first"))
    later = Window.partitionBy("conv_id").orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("conv_id").alias("_c"), F.col("_block").alias("_b"), F.min("_first").over(later).alias("_beyond"))
    inside = Window.partitionBy("conv_id", "_block").orderBy(F.col("seq").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_within", F.min("_start").over(inside))
    rows = rows.join(blocks, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_block") == F.col("_b")), "left")
    dead = F.least("_within", "_beyond") <= F.col("turn")  # least() skips nulls
    return rows.filter(~F.coalesce(dead, F.lit(False))).select(*events.columns)


def fold(events: DataFrame, block: int = LOG_BLOCK) -> DataFrame:
    """Final messages: ``conv_id``, ``turn``, ``role``, ``text``, one row per turn that has a start or a delta left.

    Null texts append nothing; the role is that of the turn's last event that names one, else empty.
    """
    live = live_events(events, block)
    # Parts of one turn are joined per block of the log first, so a long turn moves as few rows.
    part = live.withColumn("_block", F.floor(F.col("seq") / block)).groupBy("conv_id", "turn", "_block").agg(
        F.array_sort(F.collect_list(F.struct("seq", F.coalesce("text", F.lit("")).alias("text")))).alias("p"),
        F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("r"))
    part = part.select("conv_id", "turn", "_block", F.array_join(F.transform("p", lambda s: s["text"]), "").alias("text"), "r")
    whole = part.groupBy("conv_id", "turn").agg(
        F.array_sort(F.collect_list(F.struct("_block", "text"))).alias("p"), F.max("r").alias("r"))
    return whole.select("conv_id", "turn", F.coalesce("r.role", F.lit("")).alias("role"),
                        F.array_join(F.transform("p", lambda s: s["text"]), "").alias("text"))


def render(messages: DataFrame, trained=TRAINED_ROLES) -> DataFrame:
    """``conv_id``, ``formatted``, ``segments`` (array of ``text``, ``loss``), turns in order.

    A conversation is one row, so its text must fit a row, as any use of it needs."""
    body = escaped(F.col("text"))
    loss = F.col("role").isin(*trained)
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(BODY))
    parts = F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")), F.struct(body.alias("text"), loss.alias("loss")),
                    F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")))
    turns = messages.select("conv_id", "turn", parts.alias("parts")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "parts"))).alias("t"))
    segments = F.flatten(F.transform("t", lambda t: t["parts"]))
    return turns.select("conv_id", segments.alias("segments")).select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_back(formatted: Column) -> Column:
    """Array of structs ``role``, ``text`` from a formatted conversation."""
    turns = F.filter(F.split(formatted, re.escape(OPEN)), lambda t: t != "")
    return F.transform(turns, lambda t: F.struct(
        unescaped(F.substring_index(t, BODY, 1)).alias("role"),
        unescaped(F.substring_index(F.substring_index(t, CLOSE, 1), BODY, -1)).alias("text")))


def trained_text(segments: Column) -> Column:
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def events_of_turns(rows: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The event log that would have led to finished turns (``conv_id``, ``turn``, ``role``, ``text``).

    Turns are ordered by ``turn``, then role and text, nulls first, so rows that repeat a turn are messages of their
    own.  Trained roles stream their text in deltas, others come whole; null is empty.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    # Pieces are cut by one pass of a pattern, so the cost is linear in the text.
    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("(?s).{1,%d}" % delta_chars), F.lit(0))
    streamed = F.col("role").isin(*TRAINED_ROLES)
    numbered = rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("turn"), "role", "text")
    start = F.struct(F.lit("message").alias("kind"), F.coalesce("role", F.lit("")).alias("role"),
                     F.when(F.coalesce(streamed, F.lit(False)), F.lit("")).otherwise(F.coalesce("text", F.lit(""))).alias("text"))
    deltas = F.when(streamed, F.transform(pieces, lambda p: F.struct(
        F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), p.alias("text"))))
    log = numbered.withColumn("_log", F.concat(F.array(start), F.coalesce(deltas, F.array().cast(
        "array<struct<kind:string,role:string,text:string>>"))))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    log = log.withColumn("_from", F.coalesce(F.sum(F.size("_log")).over(before), F.lit(0)))
    return log.select("conv_id", "turn", "_from", F.posexplode("_log").alias("_at", "e")).select(
        "conv_id", (F.col("_from") + F.col("_at")).alias("seq"), "e.kind", "turn", "e.role", "e.text")


def formatted_conversations(rows: DataFrame) -> DataFrame:
    """Turns -> event log -> folded messages -> formatted conversations.  A null ``conv_id`` is a conversation like any other."""
    return render(fold(events_of_turns(rows)))


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What the contract asks for, read back from the formatted text and its segments."""
    turns = read_back(F.col("formatted"))
    rows = formatted.select("conv_id", "formatted", turns.alias("_turns"), trained_text(F.col("segments")).alias("_loss"))
    told = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select("conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def oracle() -> str:
    """The same in DuckDB SQL.  Escaping adds a character per backslash and per control string."""
    def added(column):
        control = "|".join(re.escape(c) for c in CONTROL)
        doubled = f"replace({column}, '\\', '\\\\')"
        return f"length({doubled}) + len(regexp_extract_all({doubled}, '{control}'))"

    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL
  SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum({len(OPEN + BODY + CLOSE)} + {added('role')} + {added('text')}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
