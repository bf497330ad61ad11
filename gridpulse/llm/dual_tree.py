"""Ranked lexical search by dual trees: items and documents in hierarchies whose nodes hold coordinate maxima.

1. One pass over the texts writes an index row per document: its number of terms, and its distinct terms with their
   counts. Terms that no item holds are left out where the items' terms are few enough to be broadcast.
2. Document frequencies come from that index; an item becomes a sparse vector of weights, its repeats counted. Items are
   a stated query set: they go to the tasks in blocks of at most ``block_terms`` coordinates, each with its hierarchy.
3. A task builds a hierarchy over every few thousand documents of its share of the index. The product of two nodes'
   maxima bounds the score of every item below the one with every document below the other. Pairs of nodes are split
   from the roots down, best first, and a pair whose bound is under the weakest kth score of its items is dropped with
   all documents and items below it: no such document can be among the best of any of them.
4. A first run follows only the best node at each level, for every item and hierarchy; the kth best of all it finds is a
   floor that all hierarchies start from in the second run, which is exact. Each task returns at most k rows an item.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from gridpulse.llm.terms import hashes, spans
from gridpulse.llm.texthash import groups
from gridpulse.sources.scratch import cut

K = 10
K1_MILLE, B_PERCENT = 8, 75  # saturation (in eighths of a mille of the length factor) and length share of the score
VOCABULARY = 1 << 21  # distinct item terms that are broadcast to shorten the index; beyond it the index keeps all terms
BLOCK_TERMS = 1 << 20  # coordinates of the items of a block
TREE_DOCS, TREE_TERMS = 4096, 1 << 22  # documents and coordinates of a hierarchy
DOC_FAN, ITEM_FAN = 16, 8
_LAST = np.iinfo(np.int64).max  # stands for a null doc_id, which comes last among ties


def term_counts(texts: DataFrame, key: str, vocabulary: np.ndarray | None = None) -> DataFrame:
    """(key, n, terms, counts): number of terms with repeats; 64-bit hashes of distinct terms and how often they occur.

    With a sorted ``vocabulary`` only its terms are listed; n counts all.
    """
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        for b in batches:
            for lo, hi, data, at in groups(b.column("text")):
                lower, starts, ends, n = spans(data, at)
                term, owner = hashes(lower, starts, ends), np.repeat(np.arange(hi - lo), n)
                if known is not None:
                    place = np.searchsorted(known, term)
                    held = known[np.minimum(place, len(known) - 1)] == term if len(known) else np.zeros(len(term), bool)
                    term, owner = term[held], owner[held]
                order = np.lexsort((term, owner))
                term, owner = term[order], owner[order]
                first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (owner[1:] != owner[:-1]))[: len(term)])
                times = np.diff(np.append(first, len(term)))
                offsets = pa.array(np.searchsorted(owner[first], np.arange(hi - lo + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    b.column(key).slice(lo, hi - lo), pa.array(n.astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array(term[first])),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64)))], [key, "n", "terms", "counts"])

    rows = texts.select(F.col(key).cast("bigint").alias(key), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"{key} bigint, n bigint, terms array<bigint>, counts array<bigint>")


class Levels:
    """Sparse rows, and above them nodes of ``fan`` neighbours each with the maximum of every coordinate, up to a root."""

    def __init__(self, first: np.ndarray, columns: np.ndarray, values: np.ndarray, fan: int):
        self.fan, self.levels = fan, [(first, columns, values)]
        while len(first) > 2:
            row = np.repeat(np.arange(len(first) - 1) // fan, np.diff(first))
            order = np.lexsort((columns, row))
            row, columns, values = row[order], columns[order], values[order]
            start = np.flatnonzero(np.append(True, (columns[1:] != columns[:-1]) | (row[1:] != row[:-1])))
            row, columns, values = row[start], columns[start], np.maximum.reduceat(values, start)
            first = np.searchsorted(row, np.arange(-(-(len(first) - 1) // fan) + 1))
            self.levels.append((first, columns, values))

    def rows(self, level: int) -> int:
        return len(self.levels[level][0]) - 1

    def below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Children of nodes of ``level``, in the nodes' order."""
        found = (nodes[:, None] * self.fan + np.arange(self.fan)).ravel()
        return found[found < self.rows(level - 1)]

    def one(self, level: int, node: int) -> tuple[np.ndarray, np.ndarray]:
        first, columns, values = self.levels[level]
        return columns[first[node]: first[node + 1]], values[first[node]: first[node + 1]]

    def products(self, level: int, nodes: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Inner product of each node with a dense vector."""
        first, columns, values = self.levels[level]
        length = first[nodes + 1] - first[nodes]
        start = np.cumsum(length) - length
        at = np.repeat(first[nodes] - start, length) + np.arange(int(length.sum()))
        return np.add.reduceat(dense[columns[at]] * values[at], start)


class Search:
    """Best documents of each item of a block, over any number of document hierarchies."""

    def __init__(self, items: Levels, width: int, floors: np.ndarray, k: int):
        self.items, self.k = items, k
        self.weakest = np.maximum(floors, 1)  # scores below are of no use; 0 never is
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * items.rows(0)
        self._dense = np.zeros(width, np.int64)

    def _bounds(self, level, node, docs, doc_level, nodes):
        columns, values = self.items.one(level, node)
        self._dense[columns] = values
        found = docs.products(doc_level, nodes, self._dense)
        self._dense[columns] = 0
        return found

    def _add(self, item, scores, ids):
        old_scores, old_ids = self.best[item]
        scores, ids = np.append(old_scores, scores), np.append(old_ids, ids)
        keep = np.lexsort((ids, -scores))[: self.k]
        self.best[item] = scores[keep], ids[keep]
        if len(keep) == self.k:
            self.weakest[item] = max(self.weakest[item], scores[keep[-1]])

    def probe(self, docs: Levels, ids: np.ndarray):
        """Scores along the best path from the root, for every item."""
        for item in range(self.items.rows(0)):
            nodes = np.zeros(1, np.int64)
            for level in range(len(docs.levels) - 1, -1, -1):
                bound = self._bounds(0, item, docs, level, nodes)
                if level:
                    nodes = docs.below(level, nodes[[int(bound.argmax())]])
            useful = bound >= self.weakest[item]
            self._add(item, bound[useful], ids[nodes[useful]])

    def run(self, docs: Levels, ids: np.ndarray):
        """All documents, as pairs of nodes from the two roots down."""
        self._visit(len(self.items.levels) - 1, 0, docs, len(docs.levels) - 1, np.zeros(1, np.int64), ids)

    def _visit(self, level, node, docs, doc_level, nodes, ids):
        bound = self._bounds(level, node, docs, doc_level, nodes)
        reach = self.items.fan ** level
        weakest = lambda: self.weakest[node * reach: (node + 1) * reach].min()
        able = np.flatnonzero(bound >= weakest())
        able = able[np.argsort(-bound[able], kind="stable")]
        if not len(able):
            return  # every pair below is too weak
        if level == doc_level == 0:
            self._add(node, bound[able], ids[nodes[able]])
        elif doc_level and (not level or doc_level >= level):
            for some in np.split(able, [1]):  # the best first: what it gives may rule out the others
                some = some[bound[some] >= weakest()]
                if len(some):
                    self._visit(level, node, docs, doc_level - 1, docs.below(doc_level, nodes[some]), ids)
        else:
            for child in self.items.below(level, np.array([node])).tolist():
                self._visit(level - 1, child, docs, doc_level, nodes[able], ids)


def _length_factor(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """100 - b + (b * n * documents) div total, exact."""
    if len(n) and int(n.max()) * B_PERCENT * documents >= 1 << 63:
        share = np.array([B_PERCENT * int(x) * documents // total for x in n], np.int64)
    else:
        share = B_PERCENT * n * documents // max(total, 1)
    return 100 - B_PERCENT + share


def _item_levels(rows) -> tuple[np.ndarray, Levels, np.ndarray]:
    """Keys of the items, their hierarchy, and the sorted terms that its columns stand for."""
    flat = np.array([t for r in rows for t in r.terms], np.int64)
    vocabulary = np.unique(flat)
    columns = np.searchsorted(vocabulary, flat)
    values = np.array([w for r in rows for w in r.weights], np.int64)
    first = np.cumsum([0, *(len(r.terms) for r in rows)])
    # items whose heaviest term is the same are neighbours
    heaviest = [columns[a + int(values[a:b].argmax())] for a, b in zip(first, first[1:])]
    order = sorted(range(len(rows)), key=lambda i: (heaviest[i], rows[i].item))
    at = np.concatenate([np.arange(first[i], first[i + 1]) for i in order])
    ends = np.cumsum([0, *(first[i + 1] - first[i] for i in order)])
    return np.array([rows[i].item for i in order], np.int64), Levels(ends, columns[at], values[at], ITEM_FAN), vocabulary


def _trees(batches, vocabulary: np.ndarray, documents: int, total: int):
    """Document hierarchies (levels, ids) over the rows of a task; documents without a term of the block have no part."""
    kept: list[tuple] = []
    rows = terms = 0
    for b in batches:
        for lo in range(0, b.num_rows, TREE_DOCS):
            part = b.slice(lo, TREE_DOCS)
            term = part.column("terms").flatten().to_numpy()
            offsets = part.column("terms").offsets.to_numpy()
            owner = np.repeat(np.arange(part.num_rows), np.diff(offsets))
            place = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
            held = vocabulary[place] == term
            n = part.column("n").to_numpy()
            factor = _length_factor(n, documents, total)[owner[held]]
            tf = part.column("counts").flatten().to_numpy()[held]
            value = 1_000_000_000 * tf // (1000 * tf + K1_MILLE * factor)
            ids = part.column("doc_id").fill_null(_LAST).to_numpy()
            kept.append((ids, owner[held] + rows, place[held], value))
            rows, terms = rows + part.num_rows, terms + len(value)
            if rows >= TREE_DOCS or terms >= TREE_TERMS:
                yield from _tree(kept)
                kept, rows, terms = [], 0, 0
    yield from _tree(kept)


def _tree(parts):
    ids, owner, column, value = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 4
    if not len(owner):
        return
    # documents whose strongest coordinate is the same are neighbours
    strongest = np.full(len(ids), -1)
    order = np.lexsort((column, value, owner))
    last = np.flatnonzero(np.append(owner[order][1:] != owner[order][:-1], True))
    strongest[owner[order][last]] = column[order][last]
    present = np.flatnonzero(strongest >= 0)
    ranked = present[np.lexsort((ids[present], strongest[present]))]
    place = np.empty(len(ids), np.int64)
    place[ranked] = np.arange(len(ranked))
    order = np.lexsort((column, place[owner]))
    first = np.searchsorted(place[owner][order], np.arange(len(ranked) + 1))
    yield Levels(first, column[order], value[order], DOC_FAN), ids[ranked]


def _best(index: DataFrame, block, floors: np.ndarray, stats: tuple[int, int], k: int, probe: bool) -> DataFrame:
    """(item, doc_id, score): each task's best rows of every item of the block, none below its floor."""
    shared = index.sparkSession.sparkContext.broadcast((block, floors))

    def run(batches):
        (keys, items, vocabulary), start = shared.value
        search = Search(items, len(vocabulary), start, k)
        for docs, ids in _trees(batches, vocabulary, *stats):
            (search.probe if probe else search.run)(docs, ids)
        size = [len(s) for s, _ in search.best]
        score, ids = (np.concatenate([np.zeros(0, np.int64), *(b[j] for b in search.best)]) for j in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(keys, size)), pa.array(ids, mask=ids == _LAST), pa.array(score)], ["item", "doc_id", "score"])

    return index.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _ranked(best: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _vectors(items: DataFrame, frequency: DataFrame, documents: int) -> DataFrame:
    """(item, terms, weights) of the items' terms that some document holds."""
    weight = F.floor(1000 * F.log((2.0 * documents + 2) / (2.0 * F.col("df") + 1))).cast("bigint")
    rows = items.select("item", F.explode(F.arrays_zip("terms", "counts")).alias("_t")).select(
        "item", F.col("_t.terms").alias("term"), F.col("_t.counts").alias("times"))
    valued = rows.join(frequency, "term").withColumn("weight", weight * F.col("times"))
    return valued.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("_v")).select(
        "item", F.col("_v.term").alias("terms"), F.col("_v.weight").alias("weights"))


def search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS, vocabulary: int = VOCABULARY) -> DataFrame:
    """Each item's ``k`` highest-scoring documents: item_id, rank, doc_id, score (above 0).

    Equal scores go by ascending doc_id, null last. Every row of ``items`` is an item of its own, whatever its id; items
    and documents without terms (null, empty) match nothing. Repeated documents are ranked each. Terms are told apart by
    64 bits. An empty table on either side gives no rows; other columns are ignored.
    """
    named = cut(items.select("item_id", F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("item")))
    queries = cut(term_counts(named, "item"))
    distinct = queries.select(F.explode("terms").alias("term")).distinct()
    known = None
    if distinct.count() <= vocabulary:
        known = np.sort(np.array([r.term for r in distinct.collect()], np.int64))
    index = cut(term_counts(docs, "doc_id", known))
    stats = index.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    vectors = cut(_vectors(queries, frequency, stats[0]))
    size = vectors.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = -(-2 * size // block_terms)
    found = []
    for number in range(blocks):
        rows = vectors.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect()
        if not rows:
            continue
        block = _item_levels(rows)
        floors = np.zeros(len(rows), np.int64)
        first = _ranked(_best(index, block, floors, stats, k, probe=True), k).where(F.col("rank") == k)
        reached = {r.item: r.score for r in first.select("item", "score").collect()}
        floors = np.array([reached.get(i, 0) for i in block[0].tolist()], np.int64)
        found.append(cut(_best(index, block, floors, stats, k, probe=False)))
    if not found:
        return named.limit(0).select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score"))
    best = found[0]
    for more in found[1:]:
        best = best.unionAll(more)
    ids = named.select("item_id", "item")
    return _ranked(best, k).join(ids, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def sql(k: int = K) -> str:
    """The same ranking for a second engine."""
    words = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH tokens AS (SELECT doc_id, unnest({words}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY doc_id),
stats AS (SELECT count(*) AS documents, sum(n) AS total FROM lengths),
wanted AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({words}) AS term FROM benchmark) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, stats WHERE term IN (SELECT term FROM wanted) GROUP BY term),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // total)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id), stats GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {k}"""
