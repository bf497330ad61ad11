"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; neighbouring turns of one role become one block; the
pieces are concatenated. Control characters inside texts are escaped, so the formatted text reads back exactly.

    <s>[user] first text [TURN] second text of the same role </s><s>[assistant] answer </s>
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLOCK_START, NEXT_TURN, BLOCK_END = "<s>[", " [TURN] ", " </s>"
HEAD_END = "] "
LOSS_ROLE = "assistant"

# Each control character and its escape; the backslash comes first and is undone last.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"), ("]", "\\r"))


def escape(text: Column) -> Column:
    for plain, escaped in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    for plain, escaped in reversed(ESCAPES):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_runs.

    ``loss_runs`` is the loss mask in run lengths of code points: per turn how many to skip, and how many of its text
    count (only texts of the role assistant do). Turns go by their number, ties by role and text; null roles and texts
    are empty; rows with a null conv_id are one conversation; repeated rows are turns of their own; other columns are
    ignored. An empty table gives no rows. A conversation is one value and so must fit one row, as in any table.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    grouped = turns.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(F.array_sort(F.collect_list(
        F.struct("turn", text("role").alias("role"), text("text").alias("text")))).alias("_turns"))

    role = lambda i: F.get(F.col("_turns"), i)["role"]
    opens = lambda t, i: (i == 0) | (role(i - 1) != t["role"])
    closes = lambda t, i: (i == F.size("_turns") - 1) | (role(i + 1) != t["role"])
    piece = lambda t, i: F.struct(
        F.when(opens(t, i), F.concat(F.lit(BLOCK_START), escape(t["role"]), F.lit(HEAD_END))).otherwise(NEXT_TURN).alias("head"),
        escape(t["text"]).alias("body"),
        F.when(closes(t, i), F.lit(BLOCK_END)).otherwise("").alias("tail"),
        (t["role"] == LOSS_ROLE).alias("loss"),
    )
    pieces = grouped.select("conv_id", F.transform("_turns", piece).alias("_pieces"))
    joined = F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "")
    runs = F.transform("_pieces", lambda p: F.struct(
        F.length(p["head"]).alias("skip"), F.when(p["loss"], F.length(p["body"])).otherwise(0).alias("take"),
        (F.when(p["loss"], 0).otherwise(F.length(p["body"])) + F.length(p["tail"])).alias("pass")))
    return pieces.select("conv_id", joined.alias("formatted"), runs.alias("loss_runs"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, in order."""
    blocks = F.filter(F.split(formatted, BLOCK_END, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        head = F.instr(block, HEAD_END)
        named = unescape(F.substring(block, F.lit(len(BLOCK_START) + 1), head - len(BLOCK_START) - 1))
        body = F.substring(block, head + len(HEAD_END), F.length(block))
        return F.transform(F.split(body, r" \[TURN\] ", -1), lambda t: F.struct(named.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def pieces(formatted: Column) -> Column:
    """A formatted conversation cut into one piece per turn, marks included; joined they are the conversation."""
    blocks = F.filter(F.split(formatted, BLOCK_END, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        parts = F.split(block, r" \[TURN\] ", -1)
        return F.transform(parts, lambda p, i: F.concat(
            F.when(i > 0, NEXT_TURN).otherwise(""), p, F.when(i == F.size(parts) - 1, BLOCK_END).otherwise("")))

    return F.flatten(F.transform(blocks, turns))


def under_mask(formatted: Column, loss_runs: Column) -> Column:
    """The text that the loss mask covers, cut out of the formatted text and unescaped.

    A run is applied to the piece of its turn, so cutting takes one pass whatever the number of turns; a mask that does
    not cover the text exactly is an error.
    """
    def cut_out(piece: Column, run: Column) -> Column:
        fits = F.length(piece) == run["skip"] + run["take"] + run["pass"]
        return F.when(fits, F.substring(piece, run["skip"] + 1, run["take"])).otherwise(
            F.raise_error(F.lit("the loss mask does not fit the text")).cast("string"))

    return unescape(F.array_join(F.zip_with(pieces(formatted), loss_runs, cut_out), ""))


def digests(formatted: DataFrame) -> DataFrame:
    """What reads back from the formatted text: turns, their hash, the text under the loss mask and its hash."""
    read = formatted.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("_read"),
        under_mask(F.col("formatted"), F.col("loss_runs")).alias("_loss"))
    told = F.array_join(F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("_read").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (
  SELECT *, replace(replace(replace(replace(text, '\\', '\\e'), '<', '\\l'), '[', '\\b'), ']', '\\r') AS body,
    replace(replace(replace(replace(role, '\\', '\\e'), '<', '\\l'), '[', '\\b'), ']', '\\r') AS named,
    lag(role) OVER w AS before, lead(role) OVER w AS after
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
pieces AS (
  SELECT *, CASE WHEN before IS DISTINCT FROM role THEN '<s>[' || named || '] ' ELSE ' [TURN] ' END || body
    || CASE WHEN after IS DISTINCT FROM role THEN ' </s>' ELSE '' END AS piece FROM placed)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(piece)) AS BIGINT) AS formatted_chars
FROM pieces GROUP BY conv_id"""
