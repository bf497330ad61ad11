import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridpulse.llm import near_dup
from gridpulse.llm.components import components, extended
from gridpulse.llm.texthash import shingle_hashes, word_hashes
from tests.llm import brute


def rows(df):
    return [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()]


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_equals_brute_force(documents, texts, words, percent):
    got = rows(near_dup.near_duplicates(documents, words, percent))
    want = [(i, n, c, True if i is None else k) for i, n, c, k in brute.near_documents(texts, words, percent)]
    assert brute.by_none(got) == brute.by_none(want)


def test_large_group_and_chain(spark):
    base = [f"w{i}" for i in range(120)]
    docs = [(i, " ".join([*base[: i % 3], f"x{i}", *base[i % 3 + 1:]])) for i in range(300)]
    got = rows(near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), 3, 85))
    assert {c for _, _, c, _ in got} == {0} and sum(k for *_, k in got) == 1


def test_pairs_in_a_crowded_region(spark):
    """A hundred pairs on one template: every document is 0.70 similar to all others, and 0.88 to its partner."""
    template = [f"t{k}" for k in range(300)]
    docs = [(i, " ".join([*template, *(f"p{i // 2}w{k}" for k in range(40)), *(f"d{i}w{k}" for k in range(24))])) for i in range(200)]
    got = rows(near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), 1, 80))
    assert all(c == i - i % 2 for i, _, c, _ in got)


def test_large_template_with_few_pairs(spark, monkeypatch):
    """1,200 documents on one template, 0.75 similar to all others; thirty have a partner. Links leave blocks, pairs don't."""
    monkeypatch.setattr(near_dup, "CHUNK", 100)
    template = [f"t{k}" for k in range(240)]
    own = lambda i: [f"d{i}w{k}" for k in range(40)]
    docs = [(i, " ".join(template + own(i))) for i in range(1200)]
    docs += [(5000 + i, " ".join(template + own(i)[:-4] + [f"e{i}w{k}" for k in range(4)])) for i in range(0, 1200, 40)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = near_dup.cut(near_dup.signatures(frame, 1))
    classes = near_dup.cut(marks.groupBy("n_shingles", "f1", "f2").agg(
        F.min(F.struct("doc_id", "th")).alias("one"), F.first("signature").alias("signature")).withColumn("rep", F.monotonically_increasing_id()))
    none = spark.createDataFrame([], "id bigint, component bigint")
    links = near_dup.crowded(classes, none, frame, 1, 80)
    assert 30 >= links.count() >= 28  # of all pairs the thirty links leave the blocks
    got = {i: c for i, _, c, _ in rows(near_dup.near_duplicates(frame, 1, 80))}
    assert all(got[i] == i for i in range(1200)) and all(got[5000 + i] == i for i in range(0, 1200, 40))


def test_depth_adapts_inside_a_block():
    """Classes that share the whole key are linked first, so a chain through them leaves nothing for shorter prefixes."""
    sets = pa.array([[1, 2, 3, 4, 5], [1, 2, 3, 4, 6], [1, 2, 3, 4, 5, 6], [7, 8]])
    deeper = np.array([[1, 1], [2, 2], [1, 1], [1, 1]])
    left = np.arange(4)
    assert near_dup._forest(left, left, deeper, np.arange(4), sets, 80) == [(0, 2), (1, 2)]
    assert near_dup._forest(left, left, deeper, np.array([0, 1, 0, 3]), sets, 80) == [(1, 2)]
    assert near_dup._forest(left[:2], left[2:], deeper, np.array([5, 5, 6, 6]), sets, 80) == [(0, 2)]


def test_two_texts_of_one_id(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(30)) for x in "ab")
    data = [(1, a), (5, a), (5, b), (7, b), (8, a + " more"), (8, a + " most")]
    found = near_dup.near_duplicates(spark.createDataFrame(data, "doc_id bigint, text string"), 3, 80)
    got = sorted((r.doc_id, r.component_id, r.kept) for r in found.collect())
    assert got == [(1, 1, True), (5, 1, False), (5, 5, True), (7, 5, False), (8, 1, False), (8, 1, False)]
    both = [(8, a + " more"), (8, a + " most")]
    found = near_dup.near_duplicates(spark.createDataFrame(both, "doc_id bigint, text string"), 3, 80)
    assert sorted((r.component_id, r.kept) for r in found.collect()) == [(8, False), (8, True)]


def test_recall_counts_links_between_components(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(60)) + f" end{i}") for i in range(20)], "doc_id bigint, text string")
    marks = near_dup.cut(near_dup.signatures(docs, 3))
    classes = near_dup.cut(marks.groupBy("n_shingles", "f1", "f2").agg(F.min(F.struct("doc_id", "th")).alias("one")).withColumn(
        "rep", F.monotonically_increasing_id()))
    none = spark.createDataFrame([], "id bigint, component bigint")
    every = classes.select(F.col("rep").alias("id"), F.lit(0).cast("bigint").alias("component"))
    assert near_dup.recall(docs, classes, none, 3, 80) == (380, 0)
    assert near_dup.recall(docs, classes, every, 3, 80, audited=5) == (95, 95)


def test_empty(empty_documents):
    assert near_dup.near_duplicates(empty_documents).count() == 0


def test_range_edges_are_seen(spark):
    """Neighbours that range partitioning puts into different partitions are compared all the same."""
    docs = [(i, " ".join(f"d{i // 2}w{k}" for k in range(40)) + (" tail" if i % 2 else "")) for i in range(200)]
    got = rows(near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), 3, 85))
    assert all(c == i - i % 2 for i, _, c, _ in got)


def test_shingles_follow_words():
    data = np.frombuffer("Ab c\tD e".encode() + "x y".encode(), np.uint8)
    words, counts = word_hashes(data, np.array([0, 8, 8, 11]))
    assert counts.tolist() == [4, 0, 2]
    again, _ = word_hashes(np.frombuffer(b"ab C d E", np.uint8), np.array([0, 8]))
    assert (words[:4] == again).all()
    _, n = shingle_hashes(words, counts, 3)
    assert n.tolist() == [2, 0, 1]


def test_near_copies_make_few_pairs(spark, monkeypatch):
    """Classes of one component are paired no further: next neighbours only, however many copies there are."""
    seen = []

    def likely(pairs, *rest):
        seen.append(pairs.count())
        return counted(pairs, *rest)

    counted = near_dup.likely
    monkeypatch.setattr(near_dup, "likely", likely)
    base = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join([*base[: i % 90], f"x{i}", *base[i % 90 + 1:]])) for i in range(400)]
    got = rows(near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), 3, 85))
    assert {c for _, _, c, _ in got} == {0} and len(got) == 400
    assert 0 < sum(seen) <= near_dup.TREES * 400


def test_steps_cover_the_neighbours(spark):
    """Pairs one step apart and those further on are all neighbours; with components, all that aren't in one."""
    docs = [(i, " ".join([f"t{k}" for k in range(60)] + [f"d{i}w{k}" for k in range(i % 7)])) for i in range(300)]
    marks = near_dup.cut(near_dup.signatures(spark.createDataFrame(docs, "doc_id bigint, text string"), 3))
    classes = near_dup.cut(marks.groupBy("n_shingles", "f1", "f2").agg(F.first("signature").alias("signature")).withColumn(
        "rep", F.monotonically_increasing_id()))
    pairs = lambda *args: {(r.a, r.b) for r in near_dup.candidates(classes, *args).collect()}
    first, further, every = (pairs(range(*r)) for r in ((1, 2), (2, 4), (1, 4)))
    assert first | further == every and {x for p in every for x in p} == {x for p in first for x in p}
    component = {r.rep: r.rep % 3 for r in classes.collect() if r.rep % 5}
    found = spark.createDataFrame(list(component.items()), "id bigint, component bigint")
    apart = {(a, b) for a, b in every if component.get(a, a) != component.get(b, b)}
    assert 0 < len(apart) < len(every) and pairs(range(1, 4), found) == apart


def test_components_take_further_links(spark):
    frame = lambda some: spark.createDataFrame(some, "a bigint, b bigint")
    found = components(frame([(5, 6), (6, 7), (1, 2), (20, 21)]))
    got = {r.id: r.component for r in extended(found, frame([(7, 2), (9, 5), (30, 31)])).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 6: 1, 7: 1, 9: 1, 20: 20, 21: 20, 30: 30, 31: 30}
    assert {r.id: r.component for r in extended(found, frame([])).collect()} == {5: 5, 6: 5, 7: 5, 1: 1, 2: 1, 20: 20, 21: 20}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 999)], "a bigint, b bigint")
    found = {r.id: r.component for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(201)}, 999: 999, 1000: 999}
    assert components(links.limit(0)).count() == 0
