"""Exact removal of long repeated substrings, by a sparse enhanced suffix array.

A suffix array over every byte would move many times the corpus. Instead, suffixes are taken at anchors only: the
anchor of a ``length``-byte window is its leftmost smallest ``GRAM``-byte hash, a function of the window's content, so
equal windows have their anchors at the same place inside. Neighbouring windows share an anchor; a run of them is one
entry (document, anchor, bytes to its left, bytes to its right).

1. Entries whose gram occurs once in the corpus are dropped: none of their windows occurs elsewhere.
2. Entries with equal gram and equal whole text are one context. A context with two occurrences or more is repeated
   as a whole.
3. The different contexts of a gram are a bucket of the suffix array: all suffixes that start with that gram. It is
   sorted, its longest-common-prefix array is scanned with a stack, and every interval of the prefix tree is tested for
   left extension: suffixes in an interval of depth R whose left texts agree for at least ``length`` - R bytes are a
   repeat group, and all of its occurrences get their span. The bucket sees each context once, so its size does not
   follow the number of copies. Buckets beyond ``bucket`` contexts are resolved window by window with a shuffle.
4. Spans are merged per document and cut out.

Texts are compressed before the two shuffles that move them. Hot grams and contexts are counted with map-side
combining and joined back by skew-aware joins of written tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridpulse.llm.packed import packed_texts, unpacked
from gridpulse.llm.texthash import Rolling, groups
from gridpulse.sources.scratch import cut

GRAM = 80
PIECE_BYTES = 1 << 22  # longer texts are hashed in pieces of that many windows
BUCKET = 32768  # contexts of one gram that a task sorts


def _base(docs: DataFrame) -> DataFrame:
    """Rows with a key that holds for null and repeated ids: doc_id and a hash of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.xxhash64(text).alias("th"), text.alias("text"))


def _smallest(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` values in a row."""
    n = len(keys)
    size = -(-n // w) * w
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1: n])


def find_anchors(data: np.ndarray, at: np.ndarray, length: int, gram: int):
    """(text index, anchor, first window, end of last window, gram hash, context hash), positions in ``data``."""
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    rolling = Rolling(data)
    grams = rolling.windows(gram)
    keys = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_smallest(keys, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    step = np.zeros(n + 1, np.int32)
    long_enough = np.flatnonzero(np.diff(at) >= length)
    step[at[long_enough]] += 1
    step[at[long_enough + 1] - length + 1] -= 1
    inside = np.cumsum(step[:n]) > 0
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(fresh)
    over = inside.copy()
    over[:-1] &= ~inside[1:] | (anchor[1:] != anchor[:-1])
    end = np.flatnonzero(over) + length
    at_anchor = anchor[first]
    return np.searchsorted(at, first, "right") - 1, at_anchor, first, end, grams[at_anchor], rolling.spans(first, end)


def entries(base: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per anchor and run of windows: doc_id, th, place (anchor, left, right in one number), hk, hc."""

    def run(batches):
        for b in batches:
            ids, ths = b.column("doc_id"), b.column("th")
            for lo, hi, data, at in groups(b.column("text")):
                for s in range(0, max(1, len(data)), PIECE_BYTES) if hi - lo == 1 else (0,):
                    part = data[s: s + PIECE_BYTES + length - 1] if hi - lo == 1 else data
                    bounds = np.array([0, len(part)]) if hi - lo == 1 else at
                    text, a, first, end, hk, hc = find_anchors(part, bounds, length, gram)
                    if not len(a):
                        continue
                    local = a - bounds[text] + s
                    place = (local << 16) | ((a - first) << 8) | (end - a)
                    rows = pa.array(lo + text)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(rows), ths.take(rows), pa.array(place), pa.array(hk.view(np.int64)), pa.array(hc.view(np.int64))],
                        ["doc_id", "th", "place", "hk", "hc"])

    return base.mapInArrow(run, "doc_id bigint, th bigint, place bigint, hk bigint, hc bigint")


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(lcp: list[int]):
    """(depth, first, last) of the common-prefix intervals of a sorted bucket, inner ones first.

    ``lcp[i]`` is shared by suffixes i and i + 1. The scan keeps the open intervals on a stack.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp, 0]):
        left = i
        while stack and stack[-1][0] > depth:
            closed, left = stack.pop()
            yield closed, left, i
        if depth and (not stack or stack[-1][0] < depth):
            stack.append((depth, left))


def bucket_spans(contexts: list[bytes], lefts: list[int], length: int, gram: int) -> list[tuple[int, int, int]]:
    """(context, bytes left of the anchor, bytes right of it) of repeats of at least ``length`` bytes.

    ``contexts`` are different texts with the same gram at ``lefts``.
    """
    ahead = [c[at:] for c, at in zip(contexts, lefts)]
    behind = [c[:at][::-1] for c, at in zip(contexts, lefts)]
    order = sorted(range(len(contexts)), key=ahead.__getitem__)
    lcp = [_common(ahead[i], ahead[j]) for i, j in zip(order, order[1:])]
    found = []
    for depth, first, last in intervals(lcp):
        if depth < gram:
            continue
        least = length - depth
        inner = sorted(order[first: last + 1], key=behind.__getitem__)
        shared = [0, *(_common(behind[i], behind[j]) for i, j in zip(inner, inner[1:])), 0]
        for k, member in enumerate(inner):
            extent = max(shared[k], shared[k + 1])
            if extent >= least:
                found.append((member, extent, depth))
    return found


def _place(name="place"):
    place = F.col(name)
    return F.shiftright(place, 16), F.shiftright(place, 8).bitwiseAND(255), place.bitwiseAND(255)


def _with_texts(base: DataFrame, wanted: DataFrame, how: str) -> DataFrame:
    """Packed texts joined to one row per document key; null ids meet null ids."""
    right = wanted.withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    texts = packed_texts(base)
    on = texts.doc_id.eqNullSafe(right["_id"]) & (texts.th == right["_th"])
    return texts.join(right, on, how).drop("_id", "_th")


def _contexts(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """The text of each context of ``wanted``, cut from its document."""

    def run(batches):
        for b in batches:
            places, texts, rows = b.column("places"), [], []
            flat, ends = places.flatten(), places.offsets.to_numpy()
            values = flat.field("place").to_numpy(zero_copy_only=False)
            for row, text in enumerate(unpacked(b.column("packed"))):
                for v in values[ends[row] - ends[0]: ends[row + 1] - ends[0]].tolist():
                    a = v >> 16
                    texts.append(text[a - (v >> 8 & 255): a + (v & 255)])
                    rows.append(row)
            columns = [*(b.column(c).take(pa.array(rows, pa.int64())) for c in ("doc_id", "th")), *(flat.field(c) for c in ("place", "hk", "n", "m"))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary())], ["doc_id", "th", "place", "hk", "n", "m", "context"])

    per_doc = wanted.groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("place", "hk", "n", "m")).alias("places"))
    return _with_texts(base, per_doc, "inner").mapInArrow(
        run, "doc_id bigint, th bigint, place bigint, hk bigint, n bigint, m bigint, context binary")


def _bucket_repeats(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans of once-occurring contexts, from the suffix-array buckets."""

    def flush(hk, rows):
        rows = list(dict.fromkeys(rows))  # rows repeated as a whole give a context twice
        spans = bucket_spans([r[4] for r in rows], [r[2] >> 8 & 255 for r in rows], length, gram)
        for i, left, right in spans:
            doc, th, place, n, _ = rows[i]
            if n == 1:
                yield doc, th, (place >> 16) - left, (place >> 16) + right

    def run(batches):
        hk, rows = None, []
        for b in batches:
            out = []
            for k, *row in zip(*(b.column(c).to_pylist() for c in ("hk", "doc_id", "th", "place", "n", "context"))):
                if k != hk:
                    out.extend(flush(hk, rows))
                    hk, rows = k, []
                rows.append(tuple(row))
            yield _span_batch(out)
        yield _span_batch(list(flush(hk, rows)))

    columns = contexts.select("hk", "doc_id", "th", "place", "n", "context")
    ordered = columns.repartition("hk").sortWithinPartitions("hk")
    return ordered.mapInArrow(run, "doc_id bigint, th bigint, start bigint, end bigint")


def _span_batch(rows):
    names = ["doc_id", "th", "start", "end"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names)


def _window_repeats(contexts: DataFrame, length: int) -> DataFrame:
    """The same for buckets too large to sort in a task: windows are hashed, counted and joined back."""

    def run(batches):
        for b in batches:
            ids, ths, ends = b.column("doc_id"), b.column("th"), np.cumsum([0, *(len(c) for c in b.column("context").to_pylist())])
            data = np.frombuffer(b"".join(b.column("context").to_pylist()), np.uint8)
            places, hk = b.column("place").to_numpy(), b.column("hk").to_numpy()
            counts = np.diff(ends) - length + 1
            row = np.repeat(np.arange(len(counts)), counts)
            k = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            first = ends[row] + k
            start = (places[row] >> 16) - (places[row] >> 8 & 255) + k
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(row)), ths.take(pa.array(row)), pa.array(start), pa.array(hk[row]),
                pa.array(Rolling(data).spans(first, first + length).view(np.int64)),
                pa.array(b.column("n").to_numpy()[row]),
            ], ["doc_id", "th", "start", "hk", "wh", "n"])

    windows = cut(contexts.dropDuplicates(["hk", "doc_id", "th", "place"]).mapInArrow(
        run, "doc_id bigint, th bigint, start bigint, hk bigint, wh bigint, n bigint"))
    again = cut(windows.groupBy("hk", "wh").count().where("count > 1").select("hk", "wh"))
    return windows.where("n = 1").join(again, ["hk", "wh"], "left_semi").select(
        "doc_id", "th", "start", (F.col("start") + length).alias("end"))


def repeated_spans(docs: DataFrame, length: int = 200, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, th, start, end): byte spans covered by a ``length``-byte string that starts elsewhere too; may overlap.

    ``th`` tells rows of one doc_id with different texts apart.
    """
    base = _base(docs)
    found = entries(base, length, gram)
    grams = cut(found.groupBy("hk").count().where("count > 1").select("hk"))
    shared = cut(found.join(grams, "hk", "left_semi"))
    contexts = cut(shared.groupBy("hk", "hc").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "place")).alias("one")))
    anchor, left, right = _place()
    whole = shared.join(contexts.where("n > 1").select("hk", "hc"), ["hk", "hc"], "left_semi").select(
        "doc_id", "th", (anchor - left).alias("start"), (anchor + right).alias("end"))
    buckets = cut(contexts.groupBy("hk").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    several = contexts.join(buckets, "hk").select("one.doc_id", "one.th", "one.place", "hk", "n", "m")
    texts = cut(_contexts(base, several))
    spans = whole.unionAll(_bucket_repeats(texts.where(F.col("m") <= bucket), length, gram))
    if not texts.where(F.col("m") > bucket).isEmpty():
        spans = spans.unionAll(_window_repeats(texts.where(F.col("m") > bucket), length))
    return spans


def remove_repeats(docs: DataFrame, length: int = 200, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, spans (start, end), kept (binary).

    Texts are taken as UTF-8 bytes, whole; matches never cross documents, and strings are judged on the input, not on
    what is left. A null text is empty; texts shorter than ``length`` lose nothing. Rows repeated as a whole are copies
    of each other like any two equal texts, and all are returned; a null doc_id keeps its row. Other columns are
    ignored; an empty table gives no rows. ``kept`` may end inside a character, so it is binary.
    """

    def run(batches):
        for b in batches:
            n_bytes, removed, spans, kept = [], [], [], []
            for text, some in zip(unpacked(b.column("packed")), b.column("spans").to_pylist()):
                merged = []
                for s in sorted(some or (), key=lambda s: s["start"]):
                    if merged and s["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["end"])
                    else:
                        merged.append([s["start"], s["end"]])
                edges = [0, *(x for m in merged for x in m), len(text)]
                n_bytes.append(len(text))
                removed.append(sum(e - s for s, e in merged))
                spans.append([{"start": s, "end": e} for s, e in merged])
                kept.append(b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2])))
            struct = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                pa.array([len(s) for s in spans], pa.int64()), pa.array(spans, struct), pa.array(kept, pa.binary()),
            ], ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    spans = repeated_spans(docs, length, gram, bucket).groupBy("doc_id", "th").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"))
    return _with_texts(_base(docs), spans, "left").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
             "spans array<struct<start:bigint,end:bigint>>, kept binary")
