"""Mixing sources to target weights by Sainte-Lague apportionment of equal-word blocks.

Documents of a source are dealt to shards by a seeded hash, and the documents of a shard, in seeded order, are one
stream of words cut into blocks of ``block`` words. Blocks are the seats: sources get seats for their targets, and the
shards of a source get that source's seats for their sizes, both by the highest quotients size / (2 s + 1). A shard
takes every one of its blocks ``seats // blocks`` times and a seeded, evenly spread choice of them once more.

Only the text pass and one shuffle of (doc_id, source, size) rows follow the input; a shard is bounded by ``shard``
words and ``SHARD_ROWS`` rows, so a source with a third of all rows is simply many shards. Sizes per source and per shard
are small sums. Seats go from a source to groups of shards and from a group to its shards, so no task holds them all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridpulse.sources.scratch import cut

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK = 16  # words
SHARD, SHARD_ROWS = 1 << 18, 1 << 14  # words and rows of a shard
SEATED = 1 << 12  # shards that get their seats in one task
ADDED = ("size", "source_size", "target", "taken")


def word_count(text: Column) -> Column:
    """Words between blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def water_filling(sizes: np.ndarray, weights: np.ndarray, total: float, most: float) -> np.ndarray:
    """Shares of ``total`` by weight, none above ``most`` times its size; excess is shared again among the rest."""
    caps, targets = most * sizes, np.zeros(len(sizes))
    free = np.ones(len(sizes), bool)
    left = float(total)
    while free.any():
        share = left * weights / weights[free].sum()
        over = free & (share >= caps)
        if not over.any():
            targets[free] = share[free]
            break
        targets[over] = caps[over]
        left -= caps[over].sum()
        free &= ~over
    return targets


def sainte_lague(votes: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Integer seats by the highest quotients votes / (2 s + 1), none above its cap; ties go to the earlier."""
    caps = np.where(votes > 0, caps, 0).astype(np.int64)
    seats = int(min(seats, caps.sum()))
    count = lambda q: np.minimum(np.floor((votes / q + 1) / 2), caps).astype(np.int64)  # noqa: E731  quotients >= q
    if not seats:
        return np.zeros(len(votes), np.int64)
    low, high = 0.0, float(votes.max()) * 2  # bisect for a quotient that gives no more than the seats
    small = float(votes[votes > 0].min()) / (2.0 * seats + 1)
    low = min(small, 1e-12 * high) / 2
    for _ in range(200):
        middle = (low * high) ** 0.5
        low, high = (low, middle) if count(middle).sum() <= seats else (middle, high)
    given = count(high)
    while (rest := seats - int(given.sum())) > 0:  # those that tie at the last quotient
        quotient = np.where(given < caps, votes / (2 * given + 1), -1.0)
        best = np.argsort(-quotient, kind="stable")[: rest]
        given[best[quotient[best] >= quotient.max() * (1 - 1e-9)]] += 1
    return given


def _source_targets(totals: DataFrame, ratio: float, most: float, block: int, weights) -> DataFrame:
    """source, source_size, rows, target, seats: from one row per source."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # code points sort like UTF-8 bytes; null last
        rank = sorted(range(len(rows)), key=lambda i: (pd.isna(rows.source.iloc[i]), (rows.source.iloc[i] or "").encode()))
        rows = rows.iloc[rank].reset_index(drop=True)
        size = rows.source_size.to_numpy(float)
        weight = np.resize(np.array(weights), len(rows))
        target = water_filling(size, weight, ratio * size.sum(), most)
        seats = sainte_lague(target, round(target.sum() / block), np.ceil(most * size / block))
        return pd.DataFrame({"source": rows.source, "source_size": rows.source_size, "rows": rows.rows, "target": target, "seats": seats})

    return totals.groupBy().applyInPandas(run, "source string, source_size bigint, rows bigint, target double, seats bigint")


def _divided(parts: DataFrame, whole: list[str], part: str) -> DataFrame:
    """Replaces the seats of each ``whole`` by those of its parts, by their sizes; a part takes ``most`` at most."""
    names = parts.columns

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(part)
        seats = sainte_lague(rows["size"].to_numpy(float), int(rows.seats.iloc[0]), rows.most.to_numpy())
        return rows.assign(seats=seats)[names]

    return parts.groupBy(*whole).applyInPandas(run, parts.schema)


def _shard_seats(shards: DataFrame, seated: int = SEATED) -> DataFrame:
    """Seats of each shard of a source, in two levels; a shard can take each of its blocks ``most`` times."""
    grouped = shards.withColumn("part", F.floor(F.col("shard") / seated))
    groups = grouped.groupBy("source", "part").agg(
        F.sum("size").alias("size"), F.sum("most").alias("most"), F.first("seats").alias("seats"))
    given = _divided(groups, ["source"], "part").select(
        F.col("source").alias("_source"), F.col("part").alias("_part"), F.col("seats").alias("_seats"))
    own = grouped.join(given, grouped.source.eqNullSafe(given["_source"]) & (grouped.part == given["_part"])).withColumn(
        "seats", F.col("_seats"))
    return _divided(own.select(*shards.columns, "part"), ["source", "part"], "shard").drop("part", "most")


def _dealt(sized: DataFrame, seed: int) -> DataFrame:
    """Adds the hash that deals a row to a shard: of its id or, without one, of its text and its number among the copies.

    Copies are numbered inside each partition of the stored table, after those of the partitions before, so no task sees
    them all. Which copy gets which number does not matter, as they are alike.
    """
    key = F.xxhash64("_th", F.coalesce("source", F.lit("")), F.col("source").isNull())
    named = sized.where("doc_id is not null").withColumn("_deal", F.xxhash64(F.lit(seed), "doc_id"))
    lost = sized.where("doc_id is null").withColumn("_key", key)
    counts = lost.groupBy("_key", "_stored").count()
    before = counts.withColumn("_before", F.sum("count").over(W.partitionBy("_key").orderBy("_stored")) - F.col("count")).drop("count")
    inside = F.row_number().over(W.partitionBy("_key", "_stored").orderBy("_order"))
    copies = lost.withColumn("_copy", inside).join(before, ["_key", "_stored"])
    numbered = copies.withColumn("_deal", F.xxhash64(F.lit(seed), "_th", F.col("_before") + F.col("_copy")))
    return named.unionByName(numbered.drop("_key", "_copy", "_before"))


def mix(docs: DataFrame, ratio: float = 1.5, most: int = 2, weights=WEIGHTS, block: int = BLOCK,
        shard: int = SHARD, seed: int = 42, whole: bool = False) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target (words of its source), taken.

    ``whole`` gives all columns of ``docs`` in place of doc_id and source; its own columns of the names in ``ADDED``, in
    any case, give way to those of the mix. No key is unique (ids may be null or repeated), so the rows are carried
    through, not joined back.

    Sources in order of their code points, null last, get ``weights`` in turn and share ``ratio`` of all words; no
    target is above ``most`` times its source's size. ``taken`` counts words with repeats; it is at most ``most`` times
    the document's size. The same rows give the same mix, in whatever order they are read. Null and empty texts have no
    words and nothing taken; repeated rows are documents of their own; rows with a null doc_id are dealt by their
    text and their number among its copies. A table without words gives targets of 0, an empty one no rows. Other columns are ignored.
    """
    text = F.col("text").cast("string")
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    sized = cut(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"), F.xxhash64(text).alias("_th"),
        *([F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row")] if whole else []),
    ).withColumns({"_order": F.xxhash64(F.lit(seed), "doc_id", "size"), "_stored": F.spark_partition_id()}))

    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = cut(_source_targets(totals, ratio, most, block, weights))
    parts = F.ceil(F.greatest(F.col("source_size") / shard, F.col("rows") / SHARD_ROWS)) + 1
    right = targets.select(F.col("source").alias("_source"), parts.alias("_parts"))
    marked = _dealt(sized, seed + 1)
    dealt = marked.join(right, marked.source.eqNullSafe(right["_source"])).withColumn(
        "shard", F.pmod("_deal", F.col("_parts"))).drop("_source", "_parts")

    shards = dealt.groupBy("source", "shard").agg(F.sum("size").alias("size"))
    blocks = F.ceil(F.col("size") / block)
    named = targets.drop("rows").withColumnRenamed("source", "_source")
    seats = cut(_shard_seats(shards.join(named, shards.source.eqNullSafe(named["_source"])).select(
        "source", "shard", "size", blocks.alias("blocks"), (blocks * most).alias("most"), "seats", "source_size", "target")))

    stream = W.partitionBy("source", "shard").orderBy("_order", "doc_id", "_th").rowsBetween(W.unboundedPreceding, W.currentRow)
    laid = dealt.withColumn("_end", F.sum("size").over(stream)).withColumn("_start", F.col("_end") - F.col("size"))
    quota = seats.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "blocks", "seats", "source_size", "target")
    placed = laid.join(quota, laid.source.eqNullSafe(quota["_source"]) & (laid.shard == quota["_shard"]))
    own = [F.col("_row")[c].alias(c) for c in kept] if whole else ["doc_id", "source"]
    return placed.select(*own, "size", "source_size", "target", _taken(block).alias("taken"))


def _taken(block: int) -> Column:
    """Words of [start, end) in the chosen blocks, counted as often as chosen.

    Of n blocks, ``seats % n`` are chosen once more: block k when floor((k + 1) r / n) > floor(k r / n), shifted by a
    hash of the shard, which spreads the choice evenly. So the choices below block k are a difference of two floors
    and a document needs no list of its blocks.
    """
    blocks = F.greatest(F.col("blocks"), F.lit(1))
    shift = F.pmod(F.xxhash64("source", "shard"), blocks)
    rest = F.col("seats") % blocks
    chosen_before = lambda k: F.floor((k + shift) * rest / blocks) - F.floor(shift * rest / blocks)
    one = lambda k: chosen_before(k + 1) - chosen_before(k)

    def words_before(at: Column) -> Column:
        whole, inside = F.floor(at / block), at % block
        return chosen_before(whole) * block + one(whole) * inside

    times = F.floor(F.col("seats") / blocks)
    return (times * F.col("size") + words_before(F.col("_end")) - words_before(F.col("_start"))).cast("bigint")
