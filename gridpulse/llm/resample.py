"""Importance resampling towards a target distribution of hashed word features.

1. Every run of one or two words falls into a bucket. Bucket counts of the corpus and of the target are sums of one
   partial array per task; the gain of a bucket is the scaled log ratio of its smoothed shares.
2. A second pass looks gains up in that array: the weight of a document is the floored mean over its features, its
   score the weight plus seeded Gumbel noise. Scores are written once.
3. The draw takes the highest scores. Its cutoff comes from a search on numbers: each job counts, exactly, the rows at
   and above a few pivots and narrows the interval, first of scores, then of the doc_ids that tie, then of the rows.
4. Only drawn rows are range-partitioned and sorted; a rank is the place in a partition plus the sizes of those before.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridpulse.llm.terms import gram_crcs, spans
from gridpulse.llm.texthash import groups
from gridpulse.sources.scratch import cut

BUCKETS = 10_000
PERCENT, LEAST_WORDS, SEED = 25, 20, 7
PIVOTS = 15  # counts of one job of the search for the cutoff
_ROW_BITS = 33  # of monotonically_increasing_id: the place inside a partition


def _features(column: pa.Array, buckets: int):
    """(first row, last row + 1, words per text, buckets of all features, the text of each feature)."""
    for lo, hi, data, at in groups(column):
        lower, starts, ends, counts = spans(data, at)
        one, of_one, two, of_two = gram_crcs(lower, starts, ends, counts)
        both = np.concatenate([one, two]) % np.uint32(buckets)
        yield lo, hi, counts, both.astype(np.int64), np.concatenate([of_one, of_two])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features per bucket over all rows; buckets without any are missing."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for *_, found, _ in _features(b.column("text"), buckets):
                total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    text = texts.select(F.col("text").cast("string").alias("text"))
    return text.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln(share in the target / share in the corpus)) of every bucket, smoothed by one feature a bucket.

    One number per bucket comes to the driver, whatever the input: ``buckets`` is the bound.
    """
    have, want = bucket_counts(docs, buckets), bucket_counts(target, buckets)
    both = have.select("bucket", F.col("n").alias("s"), F.lit(0).cast("bigint").alias("t")).unionAll(
        want.select("bucket", F.lit(0).cast("bigint"), "n"))
    rows = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for r in rows:
        s[r.bucket], t[r.bucket] = r.s, r.t
    ratio = (t + 1.0) * (float(s.sum()) + buckets) / ((s + 1.0) * (float(t.sum()) + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 times a Gumbel variate) from the hash of the seed and the id; a null id counts as empty."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def scores(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    buckets = len(gain)

    def run(batches):
        table = shared.value
        for b in batches:
            for lo, hi, counts, found, owner in _features(b.column("text"), buckets):
                n = np.bincount(owner, minlength=hi - lo)
                total = np.zeros(hi - lo, np.int64)
                np.add.at(total, owner, table[found])
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), *map(pa.array, (counts, n.astype(np.int64), weight))],
                    ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weighed = rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def cutoff(rows: DataFrame, keys: list[str], take: int, pivots: int = PIVOTS) -> list[int]:
    """Of the ``take`` rows that are highest by integer ``keys``, the keys of the lowest; ``rows`` holds no fewer.

    A job counts the rows at and above each pivot; the interval that holds the cutoff is cut again until it is one
    value. Rows above that value are settled, the next key is searched among the rows that have it.
    """
    found = []
    for key in keys:
        low, high = rows.agg(F.min(key), F.max(key)).first()
        above = 0  # rows with a key above ``high``
        while low < high:
            marks = sorted({low + (high - low + 1) * i // (pivots + 1) for i in range(1, pivots + 1)} - {low})
            counts = rows.agg(*(F.count_if(F.col(key) >= F.lit(m)).alias(f"c{i}") for i, m in enumerate(marks))).first()
            enough = [i for i, n in enumerate(counts) if n >= take]  # counts fall along the marks
            at = enough[-1] if enough else -1
            if at + 1 < len(marks):
                above, high = counts[at + 1], marks[at + 1] - 1
            if at >= 0:
                low = marks[at]
        found.append(low)
        take -= above
        rows = rows.where(F.col(key) == F.lit(low))
    return found


def _at_least(keys: list[str], least: list[int]) -> Column:
    """Are the keys, read as one tuple, at or above ``least``."""
    holds = F.lit(True)
    for key, value in zip(reversed(keys), reversed(least)):
        holds = (F.col(key) > F.lit(value)) | ((F.col(key) == F.lit(value)) & holds)
    return holds


def ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds rank (1, 2, 3 ...) by descending keys: range partitions, places inside them, and sums of their sizes."""
    order = [F.col(k).desc() for k in keys]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(
        "_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per range partition
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    rank = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return placed.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn("rank", rank.cast("bigint")).drop(
        "_part", "_before", "_place")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null unless drawn).

    Of the N documents with at least ``least_words`` words, the floor(percent N / 100) highest scores are drawn, equal
    scores by ascending doc_id, null last. Null and empty texts have no features and a weight of 0. Repeated rows are
    documents of their own; where copies tie in everything, as many of them are drawn as fit. An empty target gives
    every bucket its smoothed share; an empty table of documents gives no rows. Other columns are ignored.
    """
    gain = gains(docs, target, buckets)
    rows = cut(scores(docs, gain, seed).withColumns({
        "_id": F.coalesce(F.bitwise_not("doc_id"), F.lit(-(1 << 63))), "_row": F.monotonically_increasing_id()}))
    able = rows.where(F.col("n_words") >= least_words)
    out = ["doc_id", "n_features", "weight", "score"]
    take = percent * able.count() // 100
    none = F.lit(None).cast("bigint").alias("rank")
    if not take:
        return rows.select(*out, none)
    keys = ["score", "_id", "_row"]
    drawn = (F.col("n_words") >= least_words) & _at_least(keys, cutoff(able, keys, take))
    return ranked(rows.where(drawn), keys).select(*out, "rank").unionAll(rows.where(~drawn).select(*out, none))
