"""Records that run over several pieces of a file, told apart without reading any file in one task.

A file is read in splits, each a list of pieces (lines, or what lies between two closing braces). Whether a piece starts
inside quotes depends on all pieces before it. Each piece is a function of that state: it keeps it, turns it round or
sets it. Composing such functions is associative, so running results inside a split and then over the splits of a file
give the state at every piece; counting the pieces that start a record gives each piece its record. Windows hold one
split of a file, or one row per split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridpulse.functions.rowrules import FIELD_LIMIT, QUOTED, RECORD_FIELD
from gridpulse.operators.sizes import broadcast_if_small
from gridpulse.sources.scratch import cut

_SPLIT = ["filename", "split"]
# a record longer than all fields at their limit is refused whatever it says
_RECORD_LIMIT = 8 * (FIELD_LIMIT + 2)


def opens_quote(line: Column) -> Column:
    """Does a line that starts outside quotes end inside."""
    return F.contains(line, F.lit('"')) & line.rlike(rf"\A(?:{RECORD_FIELD},)*+{QUOTED}\z")


def stays_quoted(line: Column) -> Column:
    """Does a line that starts inside quotes end inside, with that quote or a later one."""
    inner = r'\A[^"]*+(?:""[^"]*+)*+'
    return ~F.contains(line, F.lit('"')) | line.rlike(inner + r"\z") | line.rlike(
        rf'{inner}"[^,]*+,(?:{RECORD_FIELD},)*+{QUOTED}\z')


def _running(df: DataFrame, window: W, outside: Column, inside: Column, start) -> DataFrame:
    """Adds before, and what the pieces up to each one make of either start: after_outside, after_inside.

    ``outside`` and ``inside`` are the states (0 or 1) after a piece by its start; ``start`` is the state before the
    first piece. A piece that sets the state cuts off what came before; since then only turns count.
    """
    upto, ahead = window.rowsBetween(W.unboundedPreceding, W.currentRow), window.rowsBetween(W.unboundedPreceding, -1)
    turn = F.when((outside == 1) & (inside == 0), 1).otherwise(0)
    turned = df.withColumns({"_turn": turn, "_sets": outside == inside, "_to": outside}).withColumn("_turns", F.sum("_turn").over(upto) % 2)
    noted = turned.withColumn("_set", F.when(F.col("_sets"), (F.col("_to") + F.col("_turns")) % 2))
    last = noted.withColumns({"_last": F.last("_set", ignorenulls=True).over(upto), "_prior": F.last("_set", ignorenulls=True).over(ahead)})
    after = lambda s: ((F.coalesce("_last", F.lit(s)) + F.col("_turns")) % 2).cast("int")
    before = (F.coalesce(F.col("_prior"), start) + F.col("_turns") + F.col("_turn")) % 2
    return last.withColumns({"before": before.cast("int"), "after_outside": after(0), "after_inside": after(1)}).drop(
        "_turn", "_sets", "_to", "_turns", "_set", "_last", "_prior")


def quote_states(pieces: DataFrame, outside: Column, inside: Column) -> DataFrame:
    """Adds ``quoted``: 1 for a piece (filename, split, position) that starts inside quotes, else 0."""
    marked = pieces.withColumns({"_out": outside.cast("int"), "_in": inside.cast("int")})
    within = W.partitionBy(*_SPLIT).orderBy("position")
    local = cut(_running(marked, within, F.col("_out"), F.col("_in"), F.lit(0)).drop("before"))
    ends = local.groupBy(*_SPLIT).agg(F.max_by(F.struct("after_outside", "after_inside"), "position").alias("e")).select(
        *_SPLIT, F.col("e.after_outside").alias("_o"), F.col("e.after_inside").alias("_i"))
    over = W.partitionBy("filename").orderBy("split")
    starts = cut(_running(ends, over, F.col("_o"), F.col("_i"), F.lit(0)).select(*_SPLIT, F.col("before").alias("_start")))
    # what the pieces before this one make of the start of the split
    lag = lambda c, first: F.coalesce(F.lag(c).over(within), F.lit(first))
    known = local.withColumns({"_a": lag("after_outside", 0), "_b": lag("after_inside", 1)}).join(broadcast_if_small(starts), _SPLIT)
    return known.withColumn("quoted", F.when(F.col("_start") == 0, F.col("_a")).otherwise(F.col("_b"))).select(
        *pieces.columns, "quoted")


def numbered(pieces: DataFrame, starts: Column) -> DataFrame:
    """Adds ``record``: how many pieces of the file, up to this one, start a record."""
    marked = cut(pieces.withColumn("_starts", starts.cast("int")))
    per_split = marked.groupBy(*_SPLIT).agg(F.sum("_starts").alias("_n"))
    earlier = W.partitionBy("filename").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    offsets = cut(per_split.select(*_SPLIT, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")))
    upto = W.partitionBy(*_SPLIT).orderBy("position").rowsBetween(W.unboundedPreceding, W.currentRow)
    return marked.join(broadcast_if_small(offsets), _SPLIT).withColumn(
        "record", F.col("_offset") + F.sum("_starts").over(upto)).drop("_starts", "_offset")


def assembled(pieces: DataFrame, joint: str, limit: int) -> DataFrame:
    """(filename, record, split, position, value): pieces of each record in order, with ``joint`` between them.

    split and position are those of its first piece. Of a record longer than ``limit`` no more than about that much is
    gathered from a split, and ``value`` is null.
    """
    length = F.length("value") + len(joint)
    own = W.partitionBy(*_SPLIT, "record").orderBy("position").rowsBetween(W.unboundedPreceding, W.currentRow)
    sized = pieces.withColumn("_run", F.sum(length).over(own))
    part = F.when(F.col("_run") - length <= limit, F.struct("split", "position", "value"))
    found = sized.groupBy(*_SPLIT, "record").agg(
        F.min("position").alias("position"), F.sum(length).alias("_length"), F.array_sort(F.collect_list(part)).alias("_parts"))
    joined = F.array_join(F.transform("_parts", lambda p: p["value"]), joint)
    # one row per record and split, and of a long record no text
    pieced = found.select("filename", "record", "split", "position", "_length",
                          F.when(F.col("_length") <= limit, joined).alias("_text"))
    whole = pieced.groupBy("filename", "record").agg(
        F.min(F.struct("split", "position")).alias("at"), F.sum("_length").alias("_length"),
        F.count_if(F.col("_text").isNull()).alias("_long"), F.array_sort(F.collect_list(F.struct("split", "_text"))).alias("_parts"))
    text = F.array_join(F.transform("_parts", lambda p: p["_text"]), joint)
    fits = (F.col("_length") <= limit) & (F.col("_long") == 0)
    return whole.select("filename", "record", "at.split", "at.position", F.when(fits, text).alias("value"))


def quoted_records(lines: DataFrame) -> DataFrame:
    """(filename, split, position, value) of CSV records; a quoted line break is a line feed in ``value``.

    ``lines`` are all physical lines, empty ones included, with positions in file order inside a split. Empty records
    do not count; positions of the others are consecutive inside a split. A record beyond all limits becomes a field
    that is one character too long.
    """
    state = quote_states(lines, opens_quote(F.col("value")), stays_quoted(F.col("value")))
    records = assembled(numbered(state, F.col("quoted") == 0), "\n", _RECORD_LIMIT)
    told = records.withColumn("value", F.coalesce("value", F.repeat(F.lit("x"), FIELD_LIMIT + 1))).where("value <> ''")
    order = W.partitionBy(*_SPLIT).orderBy("record")
    return told.select(*_SPLIT, F.row_number().over(order).cast("bigint").alias("position"), "value")
