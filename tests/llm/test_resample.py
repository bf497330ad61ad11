import collections
import hashlib
import math
import zlib

import numpy as np
import pytest

from gridpulse.llm import resample
from gridpulse.llm.terms import gram_crcs, spans
from tests.llm import brute


def features(text):
    w = brute.TOKEN.findall(brute.lower(text))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])], len(w)


def expected(rows, target, percent=25, least=20):
    """rows: (doc_id, text), target: texts -> sorted (doc_id, n_features, weight, score, rank)."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = (collections.Counter(bucket(f) for x in texts for f in features(x)[0]) for texts in ([x for _, x in rows], target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10_000) / ((s[b] + 1.0) * (big_t + 10_000))))
    out = []
    for i, text in rows:
        found, n = features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = [r for r in out if r[4] >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    rank = {id(r): k + 1 for k, r in enumerate(drawn)}
    return brute.by_none([(*r[:4], rank.get(id(r))) for r in out])


def got(df):
    return brute.by_none([(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()])


def test_equals_brute_force(spark, sf, documents, texts):
    target = spark.read.parquet(f"{sf}/benchmark.parquet")
    want = expected(texts, [r.text for r in target.collect()])
    assert got(resample.resample(documents, target)) == want


def test_copies_that_tie_in_everything(spark, sf):
    """A third of all rows are copies without an id; as many are drawn as fit, each with a rank of its own."""
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(None, text)] * 40 + [(i, f"{text} only{i}") for i in range(60)] + [(5, f"{text} only5")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    target = spark.createDataFrame([("w1 w2",)], "text string")
    for percent in (10, 100):
        found = resample.resample(docs, target, percent=percent).collect()
        n = percent * len(rows) // 100
        assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, n + 1))
        drawn = sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])
        key = lambda r: (-r.score, r.doc_id is None, r.doc_id or 0)
        assert [key(r) for r in drawn] == sorted(key(r) for r in found)[:n]
        assert len(found) == len(rows)


@pytest.mark.parametrize("pivots", [3, 63])
def test_cutoff_is_the_nth_largest(spark, pivots):
    values = [int(v) for v in np.random.default_rng(3).integers(-2**62, 2**62, 200)] + [7] * 50 + [-2**63, 2**63 - 1]
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "a bigint, b bigint")
    order = sorted(((v, i) for i, v in enumerate(values)), reverse=True)
    for take in (2, 180):
        assert tuple(resample.cutoff(rows, ["a", "b"], take, pivots)) == order[take - 1]


def test_empty(spark, empty_documents, documents):
    none = empty_documents.select("text")
    assert resample.resample(empty_documents, none).count() == 0
    few = documents.where("doc_id between 0 and 40")
    assert got(resample.resample(few, none)) == expected([(r.doc_id, r.text) for r in few.collect()], [])
    assert {r["rank"] for r in resample.resample(few, none, least_words=10**9).collect()} == {None}


def test_crcs_of_long_words_and_grams():
    texts = ["Aa bB", "", "z" * 1000 + " é漢 " + "q" * 64 + "-" + "r" * 65, "x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.cumsum([0, *(len(t.encode()) for t in texts)])
    one, of_one, two, of_two = gram_crcs(*spans(data, at))
    for k, t in enumerate(texts):
        found, n = features(t)
        assert [*one[of_one == k], *two[of_two == k]] == [zlib.crc32(f.encode()) for f in found]
