"""Near-duplicate embeddings by NN-descent.

1. Equal vectors form one class; everything below sees a class once.
2. A first neighbour graph: classes that share a random-hyperplane code are compared in chunks of bounded size. The
   number of hyperplanes follows the number of classes, and the number of codes per class follows from it, so that two
   vectors at the threshold share a code with probability ``1 - MISS``.
3. NN-descent: the neighbours of a vertex, in both directions, are compared with each other, and every list keeps the
   best; until few lists change. A saturated list has no room for all links of its vertex, so wherever vectors are
   compared a spanning forest of their links is kept beside the lists: what links connect stays connected.
4. Edges at or above the threshold, checked in double precision, are links; components of links.
5. A list that is full of links is saturated: there are more links than it can hold. Lists are therefore enlarged to
   the whole component, in blocks of bounded size that are multiplied as matrices; only counts leave a block.
6. Recall is audited, of all links and per vector: a bounded sample of vectors is compared with all; below ``RECALL``
   another round starts from new hyperplanes and the graph so far, and after the last one it is an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from gridpulse.llm.components import components
from gridpulse.sources.scratch import cut

LIST = 12  # neighbours kept per vertex
FLOOR = 0.6  # weaker edges are not followed
CHUNK = 256  # vectors compared at once
BUCKET = 128  # vectors that a code should have
MISS = 0.002
RECALL, AUDIT, ROUNDS, DESCENTS = 0.95, 512, 3, 4

_EDGES = "a bigint, b bigint, sim double"
_FOUND = f"{_EDGES}, tie boolean"


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, dtype=float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    """Unit vectors of a batch from their packed form."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(n, -1)


def _edge_batch(a, b, sim, tie: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64()), pa.array(np.full(len(a), tie))], ["a", "b", "sim", "tie"])


def grouped(batches, keys: list[str]):
    """Groups of neighbouring rows with equal keys, across batches; each comes as one table."""
    held, at = [], None
    for b in batches:
        if not b.num_rows:
            continue
        values = list(zip(*(b.column(k).to_pylist() for k in keys)))
        starts = [0, *(i for i in range(1, len(values)) if values[i] != values[i - 1]), len(values)]
        for lo, hi in zip(starts, starts[1:]):
            if at is not None and values[lo] != at:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            at = values[lo]
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with their vector (null where it can't link), and the stored classes: rep, n, dim, unit (packed)."""
    array = F.col("embedding").cast("array<double>")
    fine = F.forall(array, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(array, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.when(F.coalesce(fine, F.lit(False)), array).alias("v"))
    equal = rows.where("v is not null and vec_id is not null").groupBy("v").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))

    def run(batches):
        for b in batches:
            units = [_unit([v])[0].tobytes() for v in b.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("rep"), b.column("n"), b.column("dim"), b.column("v"), pa.array(units, pa.binary())], ["rep", "n", "dim", "v", "unit"])

    sized = equal.select("rep", "n", F.size("v").alias("dim"), "v")
    return rows, cut(sized.mapInArrow(run, "rep bigint, n bigint, dim int, v array<double>, unit binary"))


def _codes(stored: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(rep, dim, unit, table, code): one row per class and table."""

    def run(batches):
        for whole in batches:
            for dim in sorted(set(whole.column("dim").to_pylist())):
                b = whole.filter(pa.array(np.equal(whole.column("dim").to_numpy(), dim)))
                x = _matrix(b.column("unit"), b.num_rows)
                planes = np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))
                signs = (x @ planes > 0).reshape(b.num_rows, tables, bits)
                codes = signs @ (1 << np.arange(bits, dtype=np.int64))
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays([
                        b.column("rep"), b.column("dim"), b.column("unit"), pa.array(np.full(b.num_rows, t, np.int32)),
                        pa.array(codes[:, t])], ["rep", "dim", "unit", "table", "code"])

    return stored.select("rep", "dim", "unit").mapInArrow(run, "rep bigint, dim int, unit binary, table int, code bigint")


def first_graph(stored: DataFrame, threshold: float, seed: int) -> DataFrame:
    """Edges between classes that share a code: the best of each row of a chunk, and a forest (tie) of its links."""
    n = stored.count()
    bits = max(4, math.ceil(math.log2(max(2, n / BUCKET))))
    share = (1 - math.acos(threshold) / math.pi) ** bits
    tables = math.ceil(math.log(MISS) / math.log(1 - share)) if share < 1 else 1
    coded = _codes(stored, bits, tables, seed)
    keys = ["dim", "table", "code"]
    hot = coded.groupBy(*keys).count().where(F.col("count") > CHUNK)
    dealt = coded.join(hot, keys, "left").withColumn("part", F.when(F.col("count").isNotNull(), F.pmod(
        F.xxhash64("rep", "table"), F.ceil(F.col("count") / CHUNK))).otherwise(0))

    def run(batches):
        for g in grouped(batches, [*keys, "part"]):
            ids, x = g.column("rep").to_numpy(), _matrix(g.column("unit"), g.num_rows)
            sims = x @ x.T  # a part is about a chunk
            yield _best(ids, ids, sims)
            yield _ties(ids, sims, threshold)

    cells = dealt.select(*keys, "part", "rep", "unit").repartition(*keys, "part").sortWithinPartitions(*keys, "part")
    return cells.mapInArrow(run, _FOUND)


def _best(rows: np.ndarray, ids: np.ndarray, sims: np.ndarray, keep: int = LIST) -> pa.RecordBatch:
    """Of each row the ``keep`` most similar others that reach the floor."""
    sims = np.where(rows[:, None] == ids[None, :], -2.0, sims)
    if sims.shape[1] > keep:
        top = np.argpartition(-sims, keep, axis=1)[:, :keep]
    else:
        top = np.broadcast_to(np.arange(sims.shape[1]), sims.shape)
    best = np.take_along_axis(sims, top, axis=1)
    r, c = np.nonzero(best >= FLOOR)
    return _edge_batch(rows[r], ids[top[r, c]], best[r, c], False)


def _ties(ids: np.ndarray, sims: np.ndarray, threshold: float) -> pa.RecordBatch:
    """A spanning forest of the links among ``ids``: fewer edges than vertices, the same components."""
    near = sims >= threshold
    np.fill_diagonal(near, False)
    unseen, left, right = np.ones(len(ids), bool), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in np.flatnonzero(near.any(axis=1)):
        queue = [start] if unseen[start] else []
        unseen[start] = False
        while queue:
            k = queue.pop()
            new = np.flatnonzero(near[k] & unseen)
            unseen[new] = False
            left.append(np.full(len(new), k))
            right.append(new)
            queue.extend(new)
    a, b = np.concatenate(left), np.concatenate(right)
    return _edge_batch(ids[a], ids[b], sims[a, b], True)


def _lists(edges: DataFrame) -> DataFrame:
    """(a, b, sim, tie, top): the best edges of every vertex (top), and all ties; an edge may be there as both."""
    single = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.max("tie").alias("tie"))
    order = W.partitionBy("a").orderBy(F.desc("sim"), "b")
    top = single.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= LIST).drop("_k")
    return top.withColumn("top", F.lit(True)).unionAll(single.where("tie").withColumn("top", F.lit(False)))


def descend(lists: DataFrame, stored: DataFrame, threshold: float = 0.95) -> DataFrame:
    """One round of neighbours of neighbours: new edges among the lists that meet at a vertex."""
    back = W.partitionBy("a").orderBy(F.desc("sim"), "b")
    reverse = lists.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim").withColumn(
        "_k", F.row_number().over(back)).where(F.col("_k") <= LIST).drop("_k")
    own = lists.select("a").distinct().select("a", F.col("a").alias("b"))
    meeting = lists.select("a", "b").unionAll(reverse.select("a", "b")).unionAll(own).distinct()
    units = stored.select(F.col("rep").alias("b"), "unit")

    def run(batches):
        for g in grouped(batches, ["a"]):
            ids, x = g.column("b").to_numpy(), _matrix(g.column("unit"), g.num_rows)
            sims = x @ x.T
            yield _best(ids, ids, sims)
            yield _ties(ids, sims, threshold)

    return meeting.join(units, "b").select("a", "b", "unit").repartition("a").sortWithinPartitions("a").mapInArrow(run, _FOUND)


def neighbour_graph(stored: DataFrame, threshold: float, seed: int, before: DataFrame | None = None) -> DataFrame:
    """Neighbour lists and ties after descents, until less than a thousandth of the entries is new."""
    found = ["a", "b", "sim", "tie"]
    edges = first_graph(stored, threshold, seed)
    lists = cut(_lists(edges if before is None else edges.unionAll(before.select(found))))
    for _ in range(DESCENTS):
        old = lists.where("top").select("a", "b", "sim")
        lists = cut(_lists(lists.select(found).unionAll(descend(old, stored, threshold))))
        new = lists.where("top")
        changed = new.join(old, ["a", "b"], "left_anti").count()
        if changed <= 0.001 * max(1, new.count()):
            break
    return lists


def block_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(rep, links): members of the same component at or above the threshold, by matrix blocks."""
    parts = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("parts"))
    dealt = members.join(parts, "component").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.least("part", j).alias("i"), F.greatest("part", j).alias("j")))
    spread = dealt.select("component", "rep", "n", "unit", "part", F.explode(cells).alias("cell")).select("component", "cell.i", "cell.j", "part", "rep", "n", "unit")
    keys = ["component", "i", "j"]

    def run(batches):
        for g in grouped(batches, keys):
            ids, n, part = (g.column(c).to_numpy() for c in ("rep", "n", "part"))
            x = _matrix(g.column("unit"), g.num_rows)
            i, j = g.column("i")[0].as_py(), g.column("j")[0].as_py()
            left, right = part == i, part == j
            near = x[left] @ x[right].T >= threshold
            if i == j:
                np.fill_diagonal(near, False)
            rows, links = [ids[left]], [near @ n[right]]
            if i != j:
                rows.append(ids[right])
                links.append(near.T @ n[left])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(rows)), pa.array(np.concatenate(links).astype(np.int64))], ["rep", "links"])

    counted = spread.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "rep bigint, links bigint")
    return counted.groupBy("rep").agg(F.sum("links").alias("links"))


def audit(stored: DataFrame, counts: DataFrame, threshold: float, queries: int = AUDIT) -> float:
    """Share of the true links of a sample of classes that were found, or the mean share of a class if that is less.

    The sample is bounded, so it is broadcast.
    """
    chosen = stored.orderBy(F.xxhash64("rep")).limit(queries)
    rows = chosen.select("rep", "dim", "unit").collect()
    shared = stored.sparkSession.sparkContext.broadcast([(r.rep, r.dim, bytes(r.unit)) for r in rows])

    def run(batches):
        sample = shared.value
        for whole in batches:
            for dim in sorted(set(whole.column("dim").to_pylist())):
                asked = [(rep, unit) for rep, d, unit in sample if d == dim]
                b = whole.filter(pa.array(np.equal(whole.column("dim").to_numpy(), dim)))
                if asked:
                    ids = np.array([rep for rep, _ in asked])
                    q = np.frombuffer(b"".join(unit for _, unit in asked)).reshape(len(asked), -1)
                    near = (q @ _matrix(b.column("unit"), b.num_rows).T >= threshold) & (ids[:, None] != b.column("rep").to_numpy()[None, :])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids), pa.array((near @ b.column("n").to_numpy()).astype(np.int64))], ["rep", "links"])

    true = stored.select("rep", "n", "dim", "unit").mapInArrow(run, "rep bigint, links bigint").groupBy("rep").agg(F.sum("links").alias("true"))
    hit = F.least("true", F.coalesce("links", F.lit(0)))
    found = true.where(F.col("true") > 0).join(counts, "rep", "left").agg(F.sum("true"), F.sum(hit), F.avg(hit / F.col("true"))).first()
    return min(found[1] / found[0], found[2]) if found[0] else 1.0


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, recall: float = RECALL, rounds: int = ROUNDS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Two vectors are linked at a cosine of at least ``threshold``. n_links counts the other rows linked directly,
    component_id is the smallest vec_id reachable. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do vectors of different lengths with each other; repeated rows are vectors of
    their own and link with each other; a row with a null vec_id links with nothing and is kept. Other columns are
    ignored; an empty table gives no rows. A result whose audited recall stays below ``recall`` is an error.
    """
    rows, stored = classes(vectors)
    graph, counts, found = None, None, None
    for k in range(rounds):
        graph = neighbour_graph(stored, threshold, k, graph)
        links = graph.where(F.col("sim") >= threshold).select("a", "b")
        found = components(links)
        members = stored.select("rep", "n", "unit").join(found, F.col("rep") == F.col("id")).select("component", "rep", "n", "unit")
        counts = cut(block_counts(members, threshold))
        reached = audit(stored, counts, threshold)
        if reached >= recall:
            break
    else:
        raise RuntimeError(f"recall of {reached:.3f} after {rounds} rounds, below {recall}")
    told = cut(stored.select("rep", "n", "v").join(found, F.col("rep") == F.col("id"), "left").join(counts, "rep", "left").select(
        "v", F.coalesce("component", "rep").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")))
    known = rows.join(told, (rows.v == told.v) & rows.vec_id.isNotNull(), "left")
    return known.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
