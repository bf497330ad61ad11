"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. One pass over the texts gives each document the size and a 128-bit fingerprint of its shingle set, and a MinHash
   signature. Documents with equal sets form a class at once (combined map-side, however many copies there are).
2. The signature is read as several short keys, one per tree. Each tree is one sorted order of the classes; the
   neighbours of a class in that order which share a long enough prefix of the key are candidates, those with the
   longest common prefix first. Orders are range-partitioned, so a region that holds a third of the rows is split
   like any other; rows at the edges of a range are compared in a second, small pass.
3. Candidates whose signatures agree too little are dropped, the others are confirmed on the full shingle sets.
4. Connected components of the links. Next neighbours come first; those further along an order are candidates only where
   they are still in different components, so a group of near copies gives no pairs beyond those that connect it.
5. A run of classes with one prefix that is longer than the neighbours reach is crowded. Where its classes are not all
   in one component yet, their full sets meet in salted blocks of bounded size. Inside a block the depth adapts: classes
   with the whole key in common are compared first, and shorter prefixes only between classes that are still apart, down
   to the least depth. All of these comparisons are exact. A block returns a spanning forest of its links, fewer rows
   than it has members; pairs never leave it.
6. Recall is audited: the links of sampled classes to all documents, by brute force, against the components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from gridpulse.llm.components import components, extended
from gridpulse.llm.packed import unpacked
from gridpulse.llm.texthash import groups, mix, shingle_hashes, word_hashes
from gridpulse.llm.vectors import grouped
from gridpulse.sources.scratch import cut

TREES = 16
DEPTH = 6  # MinHash values in the key of a tree
LEAST_DEPTH = 4  # common values that make neighbours candidates
NEIGHBOURS = 3  # how far along a sorted order candidates are taken
CHUNK, CHUNK_SHINGLES = 512, 1 << 20  # classes of a crowded run in a part, and their shingles; a block compares two parts
SLACK = 0.16  # neighbours may seem that much less similar by signature (over 4 standard deviations)
AUDITED, AUDIT_SHINGLES = 256, 4096  # classes that the audit compares with all documents, and the largest set among them
LEAST_RECALL, LEAST_PAIRS = 0.95, 50  # a lower recall over at least so many links is an error

_SIGNATURE = TREES * DEPTH
_RNG = np.random.default_rng(7)
_FACTORS = _RNG.integers(1, 2**63, _SIGNATURE, dtype=np.uint64) | np.uint64(1)
_SHIFTS = _RNG.integers(0, 2**63, _SIGNATURE, dtype=np.uint64)


def _sets(data, at, words):
    """Sorted distinct shingle hashes of each text of a group."""
    hashes, counts = word_hashes(data, at)
    shingles, n = shingle_hashes(hashes, counts, words)
    return shingles, n, [np.unique(s) for s in np.split(shingles, np.cumsum(n)[:-1])]


def _fingerprints(sets):
    with np.errstate(over="ignore"):
        one = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
        two = np.array([(s * (s | np.uint64(1)) ^ (s >> np.uint64(17))).sum(dtype=np.uint64) for s in sets], np.uint64)
    return one.view(np.int64), two.view(np.int64)


def _signatures(shingles: np.ndarray, n: np.ndarray) -> list[bytes | None]:
    """Big-endian MinHash values of each text; none without shingles."""
    rows = np.flatnonzero(n)
    if not len(rows):
        return [None] * len(n)
    first = (np.cumsum(n) - n)[rows]
    values = np.empty((len(rows), _SIGNATURE), np.uint32)
    for j in range(_SIGNATURE):
        h = shingles * _FACTORS[j]
        h += _SHIFTS[j]
        h >>= np.uint64(32)
        values[:, j] = np.minimum.reduceat(h, first)
    out: list[bytes | None] = [None] * len(n)
    for row, v in zip(rows, values.astype(">u4")):
        out[row] = v.tobytes()
    return out


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, th, n_shingles, f1, f2, signature) of every row; th is the hash of its text."""

    def run(batches):
        for b in batches:
            for lo, hi, data, at in groups(b.column("text")):
                shingles, n, sets = _sets(data, at, words)
                f1, f2 = _fingerprints(sets)
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").slice(lo, hi - lo), b.column("th").slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(f1), pa.array(f2), pa.array(_signatures(shingles, n), pa.binary()),
                ], ["doc_id", "th", "n_shingles", "f1", "f2", "signature"])

    return _rows(docs).mapInArrow(run, "doc_id bigint, th bigint, n_shingles bigint, f1 bigint, f2 bigint, signature binary")


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def candidates(classes: DataFrame, steps: range, found: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b), a < b, of classes ``steps`` places apart in some tree that share a long enough prefix.

    With components ``found``, only pairs of different ones. Whatever lies between two classes of one prefix shares it:
    each class of any pair is in a pair of one step.
    """
    spark = classes.sparkSession
    named = classes.select("rep", "signature", F.col("rep").alias("component"))
    if found is not None:
        named = _named(classes, found).select("rep", "signature", "component")

    def keys(batches):
        for b in batches:
            ids, n = b.column("rep"), b.num_rows
            values = np.frombuffer(b"".join(b.column("signature").to_pylist()), ">u4").reshape(n, TREES, DEPTH)
            for t in range(TREES):
                # classes with equal keys come in another order in every tree, so each meets many of a crowded region
                tie = mix(ids.to_numpy().view(np.uint64) * np.uint64(2 * t + 1) + np.uint64(t)) >> np.uint64(32)
                key = np.column_stack([values[:, t], tie.astype(np.uint32)]).astype(">u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, t, np.int32)), pa.array([k.tobytes() for k in key], pa.binary()), ids, b.column("component")],
                    ["tree", "key", "rep", "component"])

    def neighbours(edges: bool):
        def run(batches):
            kept, first, any_rows = None, [], False
            for b in batches:
                rows = _decoded(b)
                if not len(rows[0]):
                    continue
                if edges and len(first) == 0:
                    first = [tuple(x[:NEIGHBOURS] for x in rows)]
                    yield _edge(first[0])
                new = len(rows[0])
                if kept is not None:
                    rows = tuple(np.concatenate(x) for x in zip(kept, rows))
                yield _pairs(rows, len(rows[0]) - new, steps)
                kept, any_rows = tuple(x[-NEIGHBOURS:] for x in rows), True
            if edges and any_rows:
                yield _edge(kept)
        return run

    schema = "a bigint, b bigint, tree int, key binary, rep bigint, component bigint"
    rows = named.mapInArrow(keys, "tree int, key binary, rep bigint, component bigint")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(partitions, "tree", "key", "rep").sortWithinPartitions("tree", "key", "rep")
    inside = cut(ordered.mapInArrow(neighbours(True), schema))
    seam = inside.where("a is null").select("tree", "key", "rep", "component").distinct().coalesce(1)
    across = seam.sortWithinPartitions("tree", "key", "rep").mapInArrow(neighbours(False), schema)
    return inside.where("a is not null").select("a", "b").unionAll(across.select("a", "b")).distinct()


def _named(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``classes`` with their component; a class without links is its own."""
    labels = found.select(F.col("id").alias("_id"), F.col("component").alias("_component"))
    return classes.join(labels, F.col("rep") == F.col("_id"), "left").select(
        *classes.columns, F.coalesce("_component", "rep").alias("component"))


def _decoded(batch):
    keys = batch.column("key").cast(pa.binary()).to_pylist()
    values = np.frombuffer(b"".join(keys), ">u4").reshape(len(keys), DEPTH + 1)
    return batch.column("tree").to_numpy(), values, batch.column("rep").to_numpy(), batch.column("component").to_numpy()


def _edge(rows):
    tree, values, ids, component = rows
    none = pa.nulls(len(ids), pa.int64())
    return pa.RecordBatch.from_arrays(
        [none, none, pa.array(tree), pa.array([v.tobytes() for v in values], pa.binary()), pa.array(ids), pa.array(component)],
        ["a", "b", "tree", "key", "rep", "component"])


def _pairs(rows, done, steps):
    """Neighbours of which the later one lies at or after ``done``."""
    tree, values, ids, component = rows
    left, right = [], []
    for step in steps:
        at = np.arange(max(done, step), len(ids))
        same = (tree[at] == tree[at - step]) & (values[at, :LEAST_DEPTH] == values[at - step, :LEAST_DEPTH]).all(axis=1)
        at = at[same & (component[at] != component[at - step])]
        left.append(np.minimum(ids[at], ids[at - step]))
        right.append(np.maximum(ids[at], ids[at - step]))
    a, b = np.concatenate(left), np.concatenate(right)
    a, b = a[a != b], b[a != b]
    no_row = [pa.nulls(len(a), kind) for kind in (pa.int32(), pa.binary(), pa.int64(), pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *no_row], ["a", "b", "tree", "key", "rep", "component"])


def _prefixes(classes: DataFrame) -> DataFrame:
    """(tree, prefix, deeper, rep): one row per class and tree; ``prefix`` has the values that make candidates."""

    def run(batches):
        for b in batches:
            values = np.frombuffer(b"".join(b.column("signature").to_pylist()), ">u4").reshape(b.num_rows, TREES, DEPTH)
            for t in range(TREES):
                prefix, deeper = ([v.tobytes() for v in np.ascontiguousarray(part)] for part in (
                    values[:, t, :LEAST_DEPTH], values[:, t, LEAST_DEPTH:]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b.num_rows, t, np.int32)), pa.array(prefix, pa.binary()), pa.array(deeper, pa.binary()), b.column("rep")],
                    ["tree", "prefix", "deeper", "rep"])

    return classes.select("rep", "signature").mapInArrow(run, "tree int, prefix binary, deeper binary, rep bigint")


def crowded(classes: DataFrame, found: DataFrame, docs: DataFrame, words: int, percent: int, sets: DataFrame | None = None) -> DataFrame:
    """Exact links (a, b) that join the components of ``found`` inside runs that the neighbours don't cover.

    The links of a block are a spanning forest: every two classes of the run that are similar enough end up connected.
    ``sets`` are shingle sets of at least all classes with a neighbour, if the caller has them.
    """
    named = _named(classes, found).select("rep", "n_shingles", "component")
    keys = ["tree", "prefix"]
    places = cut(_prefixes(classes))
    # any two of a run of NEIGHBOURS + 1 classes are neighbours
    long_runs = cut(places.groupBy(*keys).count().where(F.col("count") > NEIGHBOURS + 1).drop("count"))
    members = cut(cut(places.join(long_runs, keys)).join(named, "rep"))
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / CHUNK, F.sum("n_shingles") / CHUNK_SHINGLES)).cast("int")
    runs = cut(members.groupBy(*keys).agg(
        F.min("component").alias("_first"), F.max("component").alias("_last"), parts.alias("parts"),
    ).where("_first <> _last").select(*keys, "parts"))
    part = F.pmod(F.xxhash64("rep", "tree"), F.col("parts")).cast("int")
    dealt = cut(members.join(runs, keys).withColumn("part", part))
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.least("part", j).alias("i"), F.greatest("part", j).alias("j")))
    if sets is None:
        sets = shingle_sets(dealt.select(F.col("rep").alias("id")).distinct(), classes, docs, words)
    full = dealt.join(sets, F.col("rep") == F.col("id"))
    block = [*keys, "i", "j"]
    spread = full.select(*keys, "part", "deeper", "rep", "component", "shingles", F.explode(cells).alias("cell")).select(
        *keys, "cell.i", "cell.j", "part", "deeper", "rep", "component", "shingles")

    def run(batches):
        for g in grouped(batches, block):
            part = g.column("part").to_numpy()
            left, right = (np.flatnonzero(part == g.column(c)[0].as_py()) for c in ("i", "j"))
            deeper = np.frombuffer(b"".join(g.column("deeper").to_pylist()), np.uint32).reshape(len(part), DEPTH - LEAST_DEPTH)
            flat = pa.concat_arrays(g.column("shingles").chunks) if isinstance(g.column("shingles"), pa.ChunkedArray) else g.column("shingles")
            joined = _forest(left, right, deeper, g.column("component").to_numpy(), flat, percent)
            ids = g.column("rep").to_numpy()
            a, b = (ids[[p[k] for p in joined]] if joined else ids[:0] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return spread.repartition(*block).sortWithinPartitions(*block).mapInArrow(run, "a bigint, b bigint").distinct()


def _forest(left, right, deeper, component, sets, percent) -> list[tuple[int, int]]:
    """Links between ``left`` and ``right`` that connect different components, deepest common prefixes first."""
    size = np.diff(sets.offsets.to_numpy())
    _, flat = np.unique(sets.flatten().to_numpy(), return_inverse=True)
    own = np.split(flat, np.cumsum(size)[:-1])
    first = np.cumsum(size[right]) - size[right]
    across = np.concatenate([own[r] for r in right]) if len(right) else flat[:0]
    marked = np.zeros(int(flat.max()) + 1 if len(flat) else 0, bool)
    label, same, joined = np.unique(component, return_inverse=True)[1], len(left) == len(right) and (left == right).all(), []
    for depth in range(deeper.shape[1], -1, -1):
        for k in left:
            apart = label[right] != label[k]
            if same:
                apart &= right > k
            equal = (deeper[right] == deeper[k])
            apart &= equal[:, :depth].all(axis=1) & (~equal[:, depth] if depth < deeper.shape[1] else True)
            # sets of very different sizes can't be similar enough
            apart &= np.minimum(size[right], size[k]) * 100 >= np.maximum(size[right], size[k]) * percent
            if not apart.any():
                continue
            marked[own[k]] = True
            if apart.mean() > 0.2:
                common = np.add.reduceat(marked[across], first, dtype=np.int64)[apart]
            else:
                common = np.array([marked[own[r]].sum() for r in right[apart]])
            marked[own[k]] = False
            able = right[apart]
            for r in able[common * 100 >= (size[able] + size[k] - common) * percent]:
                if label[r] != label[k]:
                    joined.append((int(k), int(r)))
                    label[label == label[r]] = label[k]
    return joined


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures agree in nearly enough places."""
    least = (percent / 100 - SLACK) * _SIGNATURE

    def run(batches):
        for b in batches:
            one, two = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(-1, _SIGNATURE) for c in ("sa", "sb"))
            keep = pa.array((one == two).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])

    one = classes.select(F.col("rep").alias("a"), F.col("signature").alias("sa"))
    two = classes.select(F.col("rep").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a bigint, b bigint")


def shingle_sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(id, shingles): the full shingle set of each class of ``ids``, from one of its texts; a written table."""

    def pack(batches):
        zip_ = zstandard.ZstdCompressor(level=1)
        for b in batches:
            # rows that repeat an id and its text are needed once
            seen = list({pair: k for k, pair in enumerate(zip(b.column("doc_id").to_pylist(), b.column("th").to_pylist()))}.values())
            few = b.take(pa.array(seen, pa.int64()))
            packed = [zip_.compress(t.as_buffer() if t.is_valid else b"") for t in few.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([few.column("doc_id"), few.column("th"), pa.array(packed, pa.binary())], ["doc_id", "th", "packed"])

    def run(batches):
        for b in batches:
            for lo, hi, data, at in groups(pa.array(unpacked(b.column("packed")), pa.large_binary())):
                sets = _sets(data, at, words)[2]
                values = pa.array(np.concatenate(sets).view(np.int64))
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(offsets), values)], ["id", "shingles"])

    # the ids grow with the input: never a broadcast, at any size
    wanted = classes.join(ids.select("id").hint("merge"), F.col("rep") == F.col("id")).select(
        F.col("one.doc_id").alias("doc_id"), F.col("one.th").alias("th"), "id")
    texts = _rows(docs).where("doc_id is not null").mapInArrow(pack, "doc_id bigint, th bigint, packed binary")
    needed = texts.join(wanted.hint("merge"), ["doc_id", "th"]).groupBy("doc_id", "th").agg(
        F.first("id").alias("id"), F.first("packed").alias("packed"))
    return cut(needed.select("id", "packed").mapInArrow(run, "id bigint, shingles array<bigint>"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union of the full shingle sets."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return pairs.join(one, "a").join(two, "b").where(common * 100 >= union * percent).select("a", "b").distinct()


def recall(docs: DataFrame, classes: DataFrame, found: DataFrame, words: int, percent: int,
           audited: int = AUDITED) -> tuple[int, int]:
    """Links of sampled classes to any other class, by brute force over all texts, and how many lie in one component.

    The sample is ``audited`` classes in order of a hash, none with more than ``AUDIT_SHINGLES`` shingles; their sets are
    what is broadcast. It is a measurement: nothing found here enters the result.
    """
    whole = _named(classes, found).select("n_shingles", "f1", "f2", "rep", "component")
    chosen = cut(classes.where(F.col("n_shingles") <= AUDIT_SHINGLES).orderBy(F.xxhash64("f1", "f2"), "f1").limit(audited).select(
        F.col("rep").alias("id")))
    sample = shingle_sets(chosen, classes, docs, words).join(whole, F.col("id") == F.col("rep")).select(
        "n_shingles", "f1", "f2", "component", "shingles").collect()
    if not sample:
        return 0, 0
    size = np.array([r.n_shingles for r in sample])
    flat = np.concatenate([np.array(r.shingles, np.int64).view(np.uint64) for r in sample])
    order = np.argsort(flat, kind="stable")
    held, first = np.unique(flat[order], return_index=True)
    shared = docs.sparkSession.sparkContext.broadcast((
        held, np.append(first, len(flat)), np.repeat(np.arange(len(size)), size)[order], size,
        {(r.n_shingles, r.f1, r.f2): k for k, r in enumerate(sample)}))

    def run(batches):
        held, first, owner, size, names = shared.value
        for b in batches:
            for _, _, data, at in groups(b.column("text")):
                sets = _sets(data, at, words)[2]
                n = np.array([len(s) for s in sets])
                flat = np.concatenate(sets)
                row = np.repeat(np.arange(len(n)), n)
                place = np.searchsorted(held, flat)
                hit = held[np.minimum(place, len(held) - 1)] == flat
                place, row = place[hit], row[hit]
                times = first[place + 1] - first[place]
                start = np.cumsum(times) - times
                other = owner[np.repeat(first[place] - start, times) + np.arange(int(times.sum()))]
                pair, common = np.unique(np.repeat(row, times) * len(size) + other, return_counts=True)
                row, other = pair // len(size), pair % len(size)
                near = common * 100 >= (n[row] + size[other] - common) * percent
                rows, at_row = np.unique(row[near], return_index=True)
                f1, f2 = _fingerprints([sets[r] for r in rows])
                lists = []
                for r, a, c, some in zip(rows, f1, f2, np.split(other[near], at_row[1:])):
                    itself = names.get((int(n[r]), int(a), int(c)), -1)
                    lists.append([int(k) for k in some if k != itself])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n[rows].astype(np.int64)), pa.array(f1), pa.array(f2), pa.array(lists, pa.list_(pa.int32()))], ["n_shingles", "f1", "f2", "near"])

    texts = _rows(docs).where("doc_id is not null").select("text")
    # copies of a class are one row
    seen = texts.mapInArrow(run, "n_shingles bigint, f1 bigint, f2 bigint, near array<int>").where("size(near) > 0").groupBy(
        "n_shingles", "f1", "f2").agg(F.first("near").alias("near"))
    named = F.broadcast(docs.sparkSession.createDataFrame(
        [(k, r.component) for k, r in enumerate(sample)], "k int, _own bigint"))  # one row per sampled class
    judged = seen.join(whole, ["n_shingles", "f1", "f2"]).select("component", F.explode("near").alias("k")).join(named, "k")
    out = judged.agg(F.count(F.lit(1)), F.count_if(F.col("component") == F.col("_own"))).first()
    return out[0], out[1]


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, th (hash of its text), n_shingles, component_id, kept.

    Documents are linked when the sets of their distinct ``words``-word shingles have a Jaccard similarity of at least
    ``percent`` hundredths; component_id is the smallest doc_id reachable by links. A document with fewer words has
    its whole word sequence as its one shingle; null and empty texts have no shingle and link with nothing, however
    many there are. Rows are documents: two texts of one doc_id are linked only if they are similar. Repeated rows of a
    doc_id and its text are all returned alike. kept marks the documents that carry the component's id; where different
    texts of one component share that id, one of them. A null doc_id links with nothing, has a null component and is
    kept. Other columns of ``docs`` are ignored. An empty table gives no rows. A recall of the links below
    ``LEAST_RECALL`` on the audited classes is an error.
    """
    marks = cut(signatures(docs, words))
    linked = marks.where("n_shingles > 0 and doc_id is not null")
    classes = cut(linked.groupBy("n_shingles", "f1", "f2").agg(
        F.min(F.struct("doc_id", "th")).alias("one"), F.first("signature").alias("signature"),
    ).withColumn("rep", F.monotonically_increasing_id()))
    pairs = cut(candidates(classes, range(1, 2)))
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b"))).distinct()
    sets = shingle_sets(ids, classes, docs, words)
    found = components(cut(confirmed(cut(likely(pairs, classes, percent)), sets, percent)))
    further = cut(likely(candidates(classes, range(2, NEIGHBOURS + 1), found), classes, percent))
    found = extended(found, cut(confirmed(further, sets, percent)))
    found = extended(found, cut(crowded(classes, found, docs, words, percent, sets)))
    n, held = recall(docs, classes, found, words, percent)
    if n >= LEAST_PAIRS and held < LEAST_RECALL * n:
        raise ValueError(f"only {held} of {n} audited links were found")
    joined = classes.join(found, classes.rep == found.id, "left").select(
        "n_shingles", "f1", "f2", "one", F.coalesce("component", "rep").alias("component"))
    least = joined.groupBy("component").agg(F.min("one").alias("least"))
    named = joined.join(least, "component").select(
        "n_shingles", "f1", "f2", F.col("least.doc_id").alias("component_id"), F.when(F.col("one") == F.col("least"), F.col("least.th")).alias("_chosen"))
    out = marks.select("doc_id", "th", "n_shingles", "f1", "f2").join(cut(named), ["n_shingles", "f1", "f2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    chosen = (F.col("doc_id") == F.col("component_id")) & ((F.col("n_shingles") == 0) | (F.col("th") == F.col("_chosen")))
    return out.select("doc_id", "th", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), "_chosen").select(
        "doc_id", "th", "n_shingles", "component_id",
        (F.col("doc_id").isNull() | F.coalesce(chosen, F.lit(False))).alias("kept"))
