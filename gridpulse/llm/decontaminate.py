"""Benchmark decontamination with a positional inverted index.

The index is written once for all texts, whatever the benchmark: a row per segment (documents of together about
``SEGMENT_BYTES``, or one longer text) holds the segment's terms in order, and for each the sorted list of the places
where it stands. Matching reads only the index. The windows of the benchmark are looked up by their rarest term in the
corpus; the lists of their other terms, less their offsets, are intersected with that list from the next rarest on, all
windows of a segment at once. So a window costs as much as its rarest term, and a segment without that term nothing.

Segments follow the documents, so no posting is shuffled and a term that is in every document is as many bounded lists as
there are segments. Terms are told apart by 64 bits of hash. The benchmark is a stated query set: it goes to the tasks in
blocks of at most ``block_bytes`` of text, so what is broadcast is bounded whatever its size; frequencies of a block's
terms are one small row per term.

A row of the index is large. It is written in row groups and pages of a few rows, and read in a session of its own that
hands a few rows at a time to Python, so that a task holds a few megabytes of it however much its part of the table has.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpulse.llm import terms
from gridpulse.llm.texthash import groups
from gridpulse.sources.scratch import cut

WINDOW = 10  # words
BLOCK_BYTES = 16 << 20
SEGMENT_BYTES = 512 << 10
CANDIDATES = 1 << 20  # places that are looked at in one go; more of a segment are taken in turn
SLOP = 30  # words around the rarest term that a proximity match may span, each way
HELD_BYTES = 4 << 20  # of index rows that a task holds at once, beyond one row; row groups and batches close there

_INDEX = "doc_ids array<bigint>, ths array<bigint>, n_words array<int>, terms array<bigint>, counts array<int>, positions array<int>"
_HITS = "doc_id bigint, th bigint, n_words bigint, spans array<struct<start:int,end:int>>, items array<string>, near array<string>"


@dataclass
class Windows:
    """Distinct windows of one length, as numbers of their terms."""

    terms: np.ndarray  # window x word, from the rarest term on once they are ordered
    offsets: np.ndarray  # where those words stand in the window
    owner_ends: np.ndarray
    owners: np.ndarray  # numbers of the items that have the window


def _arrays(lists, dtype) -> pa.Array:
    offsets = np.cumsum([0, *(len(a) for a in lists)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, dtype), *lists]).astype(dtype)))


def _ranges(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All of ``first[i] .. first[i] + count[i] - 1``, and the i of each."""
    owner = np.repeat(np.arange(len(count)), count)
    return np.arange(len(owner)) - (np.cumsum(count) - count)[owner] + first[owner], owner


def item_windows(items: list[tuple[str, str | None]], window: int) -> tuple[np.ndarray, list[Windows], list[str]]:
    """Hashes of the terms in order, windows by length, and item ids in order."""
    names = sorted({item for item, _ in items})
    number = {name: k for k, name in enumerate(names)}
    texts = [(text or "").encode() for _, text in items]
    at = np.cumsum([0, *map(len, texts)])
    lower, starts, ends, counts = terms.spans(np.frombuffer(b"".join(texts), np.uint8), at)
    known, words = np.unique(terms.hashes(lower, starts, ends), return_inverse=True)
    item = np.array([number[name] for name, _ in items], np.int64)
    first = np.cumsum(counts) - counts
    found = []
    for length in np.unique(np.minimum(counts, window)):
        if not length:
            continue
        held = np.flatnonzero(np.minimum(counts, window) == length)
        begin, owner = _ranges(first[held], counts[held] - length + 1)
        distinct, which = np.unique(words[begin[:, None] + np.arange(length)], axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), item[held][owner]], 1), axis=0)
        found.append(Windows(distinct, np.broadcast_to(np.arange(length), distinct.shape),
                             np.searchsorted(pairs[:, 0], np.arange(len(distinct)), "right"), pairs[:, 1]))
    return known, found, names


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Items in blocks of bounded text, fetched one block at a time."""
    sized = cut(benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")))
    total = sized.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-total * 2 // block_bytes))
    for k in range(n):
        part = sized.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r.item, r.text) for r in part.collect() if r.item is not None]


def _reader(spark: SparkSession) -> SparkSession:
    """A session like the caller's, whose batches for Python close at ``HELD_BYTES`` instead of at rows by the thousand."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", HELD_BYTES)
    return own


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Positional postings of every term: a row per segment of documents.

    ``doc_ids``, ``ths`` (hash of the text) and ``n_words`` are the segment's documents in turn. ``terms`` are hashes in
    order, ``counts`` how many places each has, and ``positions`` these places, counted in words through the segment.
    """

    def run(batches):
        for b in batches:
            ids, ths = b.column("doc_id"), b.column("th")
            for lo, hi, data, at in groups(b.column("text"), segment_bytes):
                lower, starts, ends, counts = terms.spans(data, at)
                hashes = terms.hashes(lower, starts, ends)
                order = np.argsort(hashes, kind="stable")
                held, count = np.unique(hashes[order], return_counts=True)
                own = pa.array([0, hi - lo], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(own, ids.slice(lo, hi - lo)), pa.ListArray.from_arrays(own, ths.slice(lo, hi - lo)),
                    _arrays([counts], np.int32), _arrays([held], np.int64), _arrays([count], np.int32), _arrays([order], np.int32),
                ], ["doc_ids", "ths", "n_words", "terms", "counts", "positions"])

    text = F.col("text").cast("string")
    key = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    # Parquet looks at sizes only after a hundred rows unless told to
    sizes = {"parquet.block.size": str(HELD_BYTES), "parquet.page.size.row.check.min": "1"}
    return cut(key.mapInArrow(run, _INDEX), _reader(docs.sparkSession), sizes)


def _places(known: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Where the known hashes are among the held ones, -1 for none; both are in order."""
    if not len(held):
        return np.full(len(known), -1)
    at = np.minimum(np.searchsorted(held, known), len(held) - 1)
    return np.where(held[at] == known, at, -1)


def frequencies(index: DataFrame, known: np.ndarray) -> np.ndarray:
    """How often each of the known terms occurs in the corpus."""
    shared = index.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        total = np.zeros(len(shared.value), np.int64)
        for b in batches:
            for held, counts in zip(b.column("terms"), b.column("counts")):
                at = _places(shared.value, held.values.to_numpy())
                total[at >= 0] += counts.values.to_numpy()[at[at >= 0]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    out = np.zeros(len(known), np.int64)
    for term, n in index.select("terms", "counts").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return out


def _from_rarest(windows: list[Windows], frequency: np.ndarray) -> list[Windows]:
    """Windows whose terms all occur, their words from the rarest on."""
    rank = np.empty(len(frequency), np.int64)
    rank[np.argsort(frequency, kind="stable")] = np.arange(len(frequency))
    out = []
    for w in windows:
        kept = np.flatnonzero((frequency[w.terms] > 0).all(1))
        order = np.argsort(rank[w.terms[kept]], axis=1, kind="stable")
        begin = np.concatenate([[0], w.owner_ends[:-1]])[kept]
        count = w.owner_ends[kept] - begin
        out.append(Windows(np.take_along_axis(w.terms[kept], order, 1).astype(np.int32), order.astype(np.int32),
                           np.cumsum(count), w.owners[_ranges(begin, count)[0]].astype(np.int32)))
    return out


class _Segment:
    """Postings of one segment, for the terms of a block."""

    def __init__(self, known, n_words, held, counts, positions):
        self.bounds = np.concatenate([[0], np.cumsum(n_words, dtype=np.int64)])
        self._ends = np.cumsum(counts, dtype=np.int64)
        self._counts, self._positions = counts, positions
        self._keys = (np.repeat(np.arange(len(held)), counts) << 32) | positions  # in order
        self._place = _places(known, held)

    def candidates(self, windows: Windows):
        """(windows, places of their rarest term, documents) in bounded portions."""
        lead = self._place[windows.terms[:, 0]] if len(windows.terms) else np.zeros(0, np.int64)
        here = np.flatnonzero(lead >= 0)
        here = here[(self._place[windows.terms[here]] >= 0).all(1)]
        count = self._counts[lead[here]].astype(np.int64)
        portion = np.cumsum(count) // CANDIDATES
        for part in np.split(np.arange(len(here)), np.flatnonzero(np.diff(portion)) + 1) if len(here) else ():
            at, owner = _ranges((self._ends[lead[here]] - count)[part], count[part])
            centre = self._positions[at].astype(np.int64)
            yield here[part][owner], centre, np.searchsorted(self.bounds, centre, "right") - 1

    def has(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Does the term stand somewhere from ``low`` to ``high``, both included."""
        key = self._place[term] << 32
        at = np.searchsorted(self._keys, key | low)
        return (at < len(self._keys)) & (self._keys[np.minimum(at, len(self._keys) - 1)] <= (key | high))


def _find(segment: _Segment, windows: Windows, slop: int):
    """(window, document, start in the segment) of exact phrases, and (window, document) of proximity matches."""
    exact, near = [], []
    length = windows.terms.shape[1]
    reach = max(slop, length - 1)  # a phrase is within reach of its rarest term
    for w, centre, doc in segment.candidates(windows):
        low, high = segment.bounds[doc], segment.bounds[doc + 1] - 1
        for k in range(1, length):
            ok = segment.has(windows.terms[w, k], np.maximum(centre - reach, low), np.minimum(centre + reach, high))
            w, centre, doc, low, high = w[ok], centre[ok], doc[ok], low[ok], high[ok]
        near.append(np.stack([w, doc], 1))
        start = centre - windows.offsets[w, 0]
        ok = (start >= low) & (start + length - 1 <= high)
        w, doc, start = w[ok], doc[ok], start[ok]
        for k in range(1, length):
            place = start + windows.offsets[w, k]
            ok = segment.has(windows.terms[w, k], place, place)
            w, doc, start = w[ok], doc[ok], start[ok]
        exact.append(np.stack([w, doc, start], 1))
    return (np.concatenate([np.zeros((0, 3), np.int64), *exact]), np.concatenate([np.zeros((0, 2), np.int64), *near]))


def _items_of(windows: Windows, w: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Distinct (document, item) of found windows."""
    pairs = np.unique(np.stack([doc, w], 1), axis=0)
    begin = np.concatenate([[0], windows.owner_ends[:-1]])[pairs[:, 1]] if len(pairs) else np.zeros(0, np.int64)
    at, owner = _ranges(begin, windows.owner_ends[pairs[:, 1]] - begin)
    return np.stack([pairs[owner, 0], windows.owners[at]], 1)


def _by_document(rows: list[np.ndarray], width: int, n_docs: int) -> tuple[pa.Array, np.ndarray]:
    """List offsets per document and the distinct rows in order; the first column is the document."""
    rows = np.unique(np.concatenate([np.zeros((0, width), np.int64), *rows]), axis=0)
    return pa.array(np.searchsorted(rows[:, 0], np.arange(n_docs + 1)).astype(np.int32)), rows


def match(index: DataFrame, known: np.ndarray, windows: list[Windows], names: list[str], slop: int) -> DataFrame:
    """Spans of exact phrases, items with a phrase, and items with a proximity match, per indexed document."""
    shared = index.sparkSession.sparkContext.broadcast((known, _from_rarest(windows, frequencies(index, known)), names))

    def run(batches):
        known, windows, names = shared.value
        names = pa.array(names, pa.string())
        for b in batches:
            for k in range(b.num_rows):
                row = {c: b.column(c)[k].values for c in b.schema.names}
                segment = _Segment(known, *(row[c].to_numpy() for c in ("n_words", "terms", "counts", "positions")))
                spans, items, near = [], [], []
                for part in windows:
                    exact, close = _find(segment, part, slop)
                    start = exact[:, 2] - segment.bounds[exact[:, 1]]
                    spans.append(np.stack([exact[:, 1], start, start + part.terms.shape[1]], 1))
                    items.append(_items_of(part, exact[:, 0], exact[:, 1]))
                    near.append(_items_of(part, close[:, 0], close[:, 1]))
                n_docs = len(row["doc_ids"])
                span_at, spans = _by_document(spans, 3, n_docs)
                item_at, items = _by_document(items, 2, n_docs)
                near_at, near = _by_document(near, 2, n_docs)
                bounds = [pa.array(spans[:, c].astype(np.int32)) for c in (1, 2)]
                yield pa.RecordBatch.from_arrays([
                    row["doc_ids"], row["ths"], row["n_words"].cast(pa.int64()),
                    pa.ListArray.from_arrays(span_at, pa.StructArray.from_arrays(bounds, ["start", "end"])),
                    pa.ListArray.from_arrays(item_at, names.take(pa.array(items[:, 1]))),
                    pa.ListArray.from_arrays(near_at, names.take(pa.array(near[:, 1]))),
                ], ["doc_id", "th", "n_words", "spans", "items", "near"])

    return index.mapInArrow(run, _HITS)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP,
                  block_bytes: int = BLOCK_BYTES, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row per document: doc_id, th (hash of its text), n_words, n_hit, items, near_items (sorted item ids), contaminated.

    A word is hit inside an exact occurrence of ``window`` consecutive item words (of a whole item, where it is shorter);
    ``near_items`` have a window whose terms all lie within ``slop`` words (or the window's length) of an occurrence of the
    rarest of them, but no exact one, and do not contaminate. Null and empty texts have no words and no hits; items without
    words match nothing; a null item_id names no item. Repeated rows are all returned; a null doc_id keeps its row; an empty
    table on either side is fine. Other columns are ignored.
    """
    index = build_index(docs, segment_bytes)
    found = None
    blocks = 0
    for items in _blocks(benchmark, block_bytes):
        part = cut(match(index, *item_windows(items, window), slop), docs.sparkSession)
        found, blocks = part if found is None else found.unionAll(part), blocks + 1
    if blocks > 1:  # one row per document and block: put the blocks of a document together, repeated rows included
        found = found.groupBy("doc_id", "th", "n_words").agg(
            F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("near")))).alias("near"),
            (F.count(F.lit(1)) / blocks).cast("int").alias("_rows"),
        ).withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("_rows"))))
    n_hit = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")),
        lambda a, s: F.struct(F.greatest(a["end"], s["end"]).alias("end"),
                              (a["hit"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).alias("hit")),
        lambda a: a["hit"].cast("bigint"))
    return found.select(
        "doc_id", "th", "n_words", n_hit.alias("n_hit"), "items", F.array_except("near", "items").alias("near_items"),
    ).withColumn("contaminated", F.col("n_hit") > 0)
