import collections
import math

import numpy as np
import pytest

from gridpulse.llm import dual_tree
from tests.llm import brute


def expected(docs, items, k=10):
    """docs: (doc_id, text), items: (item_id, text) -> sorted (item_id, rank, doc_id, score)."""
    bags = [(i, collections.Counter(brute.TOKEN.findall(brute.lower(t)))) for i, t in docs]
    lengths = [sum(b.values()) for _, b in bags]
    n_docs, total = sum(n > 0 for n in lengths), sum(lengths)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        want, found = collections.Counter(brute.TOKEN.findall(brute.lower(text))), []
        for (i, bag), n in zip(bags, lengths):
            m = 25 + 75 * n * n_docs // total if total else 0
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                        for t, q in want.items() if t in bag)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return brute.by_none(out)


def got(df):
    return brute.by_none([(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()])


@pytest.mark.parametrize("settings", [{}, {"block_terms": 500}, {"vocabulary": 0}, {"k": 3}])
def test_equals_brute_force(spark, sf, documents, texts, settings, monkeypatch):
    monkeypatch.setattr(dual_tree, "TREE_DOCS", 64)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items += [(None, "lorem tiny"), (-1, None), (-2, " \n"), (-3, "no such words zzzzqq"), (-4, "Lorem lorem dolor TINY"), (-4, "tiny")]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    assert got(dual_tree.search(documents, frame, **settings)) == expected(texts, items, settings.get("k", 10))


def test_many_ties_go_to_the_smallest_ids(spark):
    docs = [(i, "same words here") for i in range(3000, 0, -1)] + [(None, "same words here")] * 5 + [(9999, "other text")]
    items = [(1, "words"), (2, "other"), (3, "words words same")]
    found = dual_tree.search(*(spark.createDataFrame(r, f"{c} bigint, text string") for r, c in ((docs, "doc_id"), (items, "item_id"))))
    assert got(found) == expected(docs, items)


def test_empty(spark, empty_documents, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    assert dual_tree.search(empty_documents, items).count() == 0
    found = dual_tree.search(docs, items.limit(0))
    assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_hold_for_all_below():
    rng = np.random.default_rng(4)
    first = np.arange(0, 601, 3)
    docs = dual_tree.Levels(first, np.tile([1, 4, 7], 200) + rng.integers(0, 2, 600), rng.integers(1, 99, 600), 4)
    dense = rng.integers(0, 9, 10)
    scores = docs.products(0, np.arange(200), dense)
    for level in range(1, len(docs.levels)):
        bound = docs.products(level, np.arange(docs.rows(level)), dense)
        for node in range(docs.rows(level)):
            assert scores[node * 4**level: (node + 1) * 4**level].max() <= bound[node]


def test_factor_is_exact_beyond_64_bits():
    n = np.array([0, 7, 10**9])
    want = [25 + 75 * int(x) * 10**10 // 10**13 for x in n]
    assert dual_tree._length_factor(n, 10**10, 10**13).tolist() == want
