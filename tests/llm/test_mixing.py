import numpy as np
from pyspark.sql import functions as F

from gridpulse.llm import mixing
from tests.llm import brute


def test_targets_and_taken(documents, texts):
    sources = {(r.doc_id, r.text): r.source for r in documents.select("doc_id", "text", "source").collect()}
    sizes = {}
    for i, t in texts:
        sizes[sources[i, t]] = sizes.get(sources[i, t], 0) + len(brute.WORD.findall(t or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= 2 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            free.discard(s)
    got = mixing.mix(documents).toPandas()
    assert len(got) == len(texts)
    assert (got["size"].sum(), (got.taken <= 2 * got["size"]).all(), (got.taken >= 0).all()) == (sum(sizes.values()), True, True)
    for s, rows in got.groupby(got.source.where(got.source.notna(), None), dropna=False):
        s = None if s != s else s
        assert (rows.source_size == sizes[s]).all() and np.allclose(rows.target, target[s])
        assert abs(rows.taken.sum() - target[s]) <= max(2 * mixing.BLOCK * (1 + sizes[s] // mixing.SHARD + 1), 0.02 * target[s])


def test_reruns_and_row_order_agree(documents):
    one = mixing.mix(documents).toPandas()
    two = mixing.mix(documents.orderBy("text").repartition(5)).toPandas()
    key = ["doc_id", "source", "size", "taken"]
    assert brute.by_none(map(tuple, one[key].astype(str).values)) == brute.by_none(map(tuple, two[key].astype(str).values))


def test_many_shards(documents):
    got = mixing.mix(documents, shard=500, block=10).toPandas()
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "max"), size=("size", "sum"))
    big = by[by["size"] > 1000]
    assert (abs(big.taken / big.target - 1) < 0.15).all() and (got.taken <= 2 * got["size"]).all()


def test_sainte_lague():
    votes = np.array([53.0, 24.0, 23.0])
    assert mixing.sainte_lague(votes, 7, np.array([9, 9, 9])).tolist() == [3, 2, 2]
    assert mixing.sainte_lague(votes, 7, np.array([2, 9, 9])).tolist() == [2, 3, 2]
    assert mixing.sainte_lague(np.array([1.0, 1.0, 0.0]), 3, np.array([5, 5, 5])).tolist() == [2, 1, 0]
    assert mixing.sainte_lague(votes, 0, np.array([9, 9, 9])).tolist() == [0, 0, 0]


def test_no_words(spark, empty_documents):
    assert mixing.mix(empty_documents).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert [(r.taken, r.target) for r in mixing.mix(blank).collect()] == [(0, 0.0), (0, 0.0)]


def highest_quotients(sizes, seats, caps):
    """Sainte-Lague one seat after another."""
    given = [0] * len(sizes)
    for _ in range(min(seats, sum(c for c, v in zip(caps, sizes) if v))):
        best = max((k for k in range(len(sizes)) if given[k] < caps[k] and sizes[k]), key=lambda k: (sizes[k] / (2 * given[k] + 1), -k))
        given[best] += 1
    return given


def test_seats_of_shards_in_two_levels(spark):
    rng = np.random.default_rng(8)
    size = [int(x) for x in rng.integers(1, 4000, 30)]
    shards = spark.createDataFrame(
        [(s, k, v, -(-v // 16), 2 * -(-v // 16), n, 0, 0.0) for s, n in (("a", 700), (None, 3), ("c", 10**9)) for k, v in enumerate(size)],
        "source string, shard bigint, size bigint, blocks bigint, most bigint, seats bigint, source_size bigint, target double")
    got = {(r.source, r.shard): r.seats for r in mixing._shard_seats(shards, seated=8).collect()}
    most = [2 * -(-v // 16) for v in size]
    parts = [range(k, min(k + 8, 30)) for k in range(0, 30, 8)]
    for source, seats in (("a", 700), (None, 3), ("c", 10**9)):
        upper = highest_quotients([sum(size[k] for k in p) for p in parts], min(seats, sum(most)), [sum(most[k] for k in p) for p in parts])
        want = [n for p, u in zip(parts, upper) for n in highest_quotients([size[k] for k in p], u, [most[k] for k in p])]
        assert [got[source, k] for k in range(30)] == want


def test_many_empty_and_many_equal_rows_are_spread(spark, monkeypatch):
    """No stream of a shard holds all rows of a source that has hardly any words, nor all copies of a text without id."""
    seen = []
    monkeypatch.setattr(mixing, "cut", lambda df, cut=mixing.cut: seen.append(cut(df)) or seen[-1])
    blank = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"), F.lit("a").alias("source"))
    copies = spark.range(40_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("two words").alias("text"), F.lit("b").alias("source"))
    out = mixing.mix(blank.unionAll(copies))
    assert out.count() == 240_000 and abs(out.agg(F.sum("taken")).first()[0] / 120_000 - 1) < 0.01
    sized, targets, _ = seen
    sizes = mixing._dealt(sized, 43).join(targets.select("source", F.ceil(F.col("rows") / mixing.SHARD_ROWS).alias("n")), "source").groupBy(
        "source", F.pmod("_deal", F.col("n") + 1)).count()
    assert sizes.agg(F.max("count")).first()[0] < 1.5 * mixing.SHARD_ROWS and sizes.count() == 14 + 4
