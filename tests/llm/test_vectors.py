import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse.llm import vectors
from tests.llm import brute

SCHEMA = "vec_id bigint, embedding array<double>"


def rows(df):
    return [(r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BUCKET", 16)
    monkeypatch.setattr(vectors, "CHUNK", 32)
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((60, 32))
    near = [(i, centre[i // 2] + 0.1 * rng.standard_normal(32)) for i in range(120)]
    dense = [(200 + i, centre[0] + 0.15 * rng.standard_normal(32)) for i in range(100)]
    far = [(400 + i, rng.standard_normal(32)) for i in range(300)]
    data = [(i, [float(x) for x in v]) for i, v in [*near, *dense, *far]]
    data += [(None, data[0][1]), (-1, None), (-2, [0.0] * 32), (-3, [float("nan")] * 32), (-4, [1.0, 2.0]), (-5, [1.0, 2.0]), (-6, [2.0, 4.1]),
             (-6, [2.0, 4.1]), (-7, []), (-8, [None, 1.0]), (-9, [float("inf"), 1.0]), (-10, [1e300, 2e300]), (-11, [2e-300, 4e-300])]
    df = spark.createDataFrame(data, SCHEMA).withColumns({"rep": F.lit(1), "n": F.lit(2), "v": F.lit(3), "label": F.lit(4)})
    want = [(i, n, c, True if i is None else k) for i, n, c, k in brute.near_vectors(
        [(i, [x / 1e300 for x in v] if i == -10 else [x * 1e300 for x in v] if i == -11 else v) for i, v in data])]
    assert brute.by_none(rows(vectors.near_duplicates(df))) == brute.by_none(want)


def test_descent_finds_neighbours_of_neighbours(spark):
    angles = np.linspace(0, 0.8, 9)
    stored = vectors.classes(spark.createDataFrame([(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angles)], SCHEMA))[1]
    line = spark.createDataFrame([(i, i + 1, float(np.cos(0.1))) for i in range(8)] + [(i + 1, i, float(np.cos(0.1))) for i in range(8)], vectors._EDGES)
    found = {(r.a, r.b) for r in vectors.descend(line, stored).collect()}
    assert (0, 2) in found and (2, 0) in found and (0, 8) not in found


def test_links_across_dense_groups(spark):
    """Two groups of 20 fill every list with their own members; the 400 links across (0.955) are found all the same."""
    rng = np.random.default_rng(5)
    across, own = np.sqrt(0.955), np.sqrt(0.01)
    data = []
    for i in range(40):
        v = np.zeros(44)
        v[0], v[1 + i // 20], v[4 + i] = across, np.sqrt(0.99 - 0.955), own
        data.append((i, [float(x) for x in v * (1 + rng.random())]))
    got = rows(vectors.near_duplicates(spark.createDataFrame(data, SCHEMA), 0.95))
    assert sorted(got) == [(i, 39, 0, i == 0) for i in range(40)]


def test_recall_below_the_bound_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(vectors, "audit", lambda *_: 0.5)
    df = spark.createDataFrame([(i, [1.0, i / 1000]) for i in range(4)], SCHEMA)
    with pytest.raises(RuntimeError, match="recall of 0.500"):
        vectors.near_duplicates(df, rounds=1)


def test_audit_measures_recall(spark):
    stored = vectors.classes(spark.createDataFrame([(i, [1.0, i / 1000]) for i in range(10)], SCHEMA))[1]
    half = spark.createDataFrame([(i, 9 if i < 5 else 0) for i in range(10)], "rep bigint, links bigint")
    assert vectors.audit(stored, half, 0.95) == pytest.approx(0.5)


def test_empty(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = spark.createDataFrame([(1, None), (2, [])], SCHEMA)
    assert sorted(rows(vectors.near_duplicates(lone))) == [(1, 0, 1, True), (2, 0, 2, True)]
