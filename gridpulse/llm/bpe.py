"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

1. Texts become arrays of code points, and these, by one table lookup, arrays of symbols: space, other white space,
   letter, number, other, apostrophe of a contraction, each with what follows it where that matters.
2. The splitting pattern is an automaton of eight states. A symbol is a function from state to state, and so is any run
   of symbols; there are few such functions, so composing two of them is one lookup. Blocks of symbols are reduced by
   that product, an associative scan over the blocks gives the state at the start of each, and a replay of all blocks
   side by side marks where pieces start. No regular expression sees a text, however long a text or a run in it is.
3. The byte slices between marks are merged pair by pair, lowest rank first, and looked up in a cache from then on.
4. Every token keeps the offset of its end, so decoding writes all tokens of a text into place at once.

Which code points are letters, numbers and white space is asked of the tokenizer library on the driver, once, so both
follow one version of Unicode. The ranks of the vocabulary are read on the driver and broadcast (``RANKS_LIMIT``).
"""

from __future__ import annotations

import base64
import heapq
from itertools import chain, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridpulse.llm.texthash import groups

RANKS_LIMIT = 64 << 20  # bytes of a vocabulary file that may be broadcast
CACHE_PIECES, CACHE_BYTES = 1 << 18, 64  # merged pieces a task remembers, and the longest of them
BLOCK = 256  # symbols
HEAP_FROM = 48  # bytes of a piece from which pairs are merged through a heap

# Symbols. The second of a pair is followed by something that is not white space.
END, SPACE, SPACE_LAST, BLANK, BLANK_LAST, LETTER, NUMBER, OTHER, SHORT, LONG = range(10)
# States: nothing open, a lone space, white space, letters, numbers, others, and one or two letters of a contraction to go.
CLOSED, ALONE, WHITE, LETTERS, NUMBERS, OTHERS, ONE_MORE, TWO_MORE = range(8)

# Contractions that are pieces of their own, by what follows the apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_POINTS = 0x110000  # also the mark between texts


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a piece starts here, by symbol and state."""
    step, starts = np.zeros((10, 8), np.uint8), np.ones((10, 8), bool)
    step[END] = CLOSED
    for symbol in (SPACE, BLANK):  # more white space follows, or the text ends
        step[symbol], starts[symbol, WHITE] = WHITE, False
    step[SPACE_LAST], step[BLANK_LAST] = ALONE, CLOSED
    for symbol, state in ((LETTER, LETTERS), (NUMBER, NUMBERS), (OTHER, OTHERS), (SHORT, OTHERS), (LONG, OTHERS)):
        step[symbol] = state
        starts[symbol, [state, ALONE]] = False
    for symbol, state in ((SHORT, ONE_MORE), (LONG, TWO_MORE)):  # a contraction only where a piece starts
        step[symbol] = np.where(starts[symbol], state, step[symbol])
    step[LETTER, [ONE_MORE, TWO_MORE]] = CLOSED, ONE_MORE
    starts[LETTER, [ONE_MORE, TWO_MORE]] = False
    return step, starts


def _products(step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that runs of symbols make: function of each symbol, product table, and their values.

    Function 0 is the identity; ``product[f, g]`` is f first, then g.
    """
    known: dict[bytes, int] = {bytes(range(8)): 0}
    values = [np.arange(8, dtype=np.uint8)]
    for f in values:  # grows while it is read
        for g in step:
            h = g[f]
            if h.tobytes() not in known:
                known[h.tobytes()] = len(values)
                values.append(h)
    table = np.array(values)
    product = np.array([[known[g[f].tobytes()] for g in table] for f in table], np.uint16)
    return np.array([known[s.tobytes()] for s in step], np.uint16), product, table


def unicode_classes() -> np.ndarray:
    """(first code point, class) of runs of one class; classes are SPACE, BLANK, LETTER, NUMBER and OTHER."""
    import tiktoken

    every = [*range(0xD800), *range(0xE000, _POINTS)]
    text = "".join(map(chr, every))
    single = {bytes([b]): b for b in range(256)}
    classes = np.full(_POINTS, OTHER, np.uint8)
    for kind, pattern in ((BLANK, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        own = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        matched = bytes(own.encode_ordinary(text)).decode()
        classes[np.frombuffer(matched.encode("utf-32-le"), np.uint32)] = kind
    classes[32] = SPACE
    first = np.flatnonzero(np.diff(classes, prepend=255))
    return np.column_stack([first, classes[first]])


def class_table(runs: np.ndarray) -> np.ndarray:
    """Class of every code point, and END for the mark between texts."""
    lengths = np.diff(runs[:, 0], append=_POINTS)
    return np.append(np.repeat(runs[:, 1], lengths), END).astype(np.uint8)


class Splitter:
    """Starts of pieces in arrays of code points."""

    def __init__(self, runs: np.ndarray):
        self._classes = class_table(runs)
        self._step, self._starts = _machine()
        self._function, self._product, self._values = _products(self._step)
        self._short = [ord(c) for c in CONTRACTIONS if len(c) == 1]
        self._long = [tuple(map(ord, c)) for c in CONTRACTIONS if len(c) == 2]

    def symbols(self, points: np.ndarray) -> np.ndarray:
        found = self._classes[points]
        follows = np.append(found[1:], END)
        full = (follows >= LETTER)  # something that is not white space comes next
        found = found + (full & ((found == SPACE) | (found == BLANK)))
        at = np.flatnonzero(points == 39)
        if len(at):
            padded = np.append(points, [_POINTS, _POINTS])
            one, two = padded[at + 1], padded[at + 2]
            found[at[np.isin(one, self._short)]] = SHORT
            for a, b in self._long:
                found[at[(one == a) & (two == b)]] = LONG
        return found

    def starts(self, points: np.ndarray) -> np.ndarray:
        """Does a piece start at each code point; marks between texts count as starts."""
        n = len(points)
        blocks = -(-n // BLOCK)
        symbols = np.full(blocks * BLOCK, END, np.uint8)
        symbols[:n] = self.symbols(points)
        columns = np.ascontiguousarray(symbols.reshape(blocks, BLOCK).T)
        whole = np.zeros(blocks, np.uint16)
        for c in columns:  # product of each block
            whole = self._product[whole, self._function[c]]
        shift = 1
        while shift < blocks:  # inclusive scan: product of all blocks up to here
            whole[shift:] = self._product[whole[:-shift], whole[shift:]]
            shift *= 2
        state = np.append(np.uint8(CLOSED), self._values[whole[:-1], CLOSED])
        out = np.empty((BLOCK, blocks), bool)
        for j, c in enumerate(columns):
            out[j] = self._starts[c, state]
            state = self._step[c, state]
        return out.T.reshape(-1)[:n]


def piece_ends(splitter: Splitter, data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Byte bounds of the pieces of each UTF-8 text ``data[at[i]:at[i + 1]]``, from 0 to its length."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    firsts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # first byte of every code point
    edge = np.searchsorted(firsts, at)
    marked = np.insert(points, edge[1:], _POINTS)
    begins = np.flatnonzero(splitter.starts(marked))
    text = np.searchsorted(edge[1:] + np.arange(len(at) - 1), begins, "left")  # a mark belongs to the text it ends
    bounds = firsts[begins - text]
    cuts = np.searchsorted(text, np.arange(len(at)))
    return [bounds[cuts[k]: cuts[k + 1]] - at[k] for k in range(len(at) - 1)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Tokens of a piece: neighbours are joined, lowest rank first, leftmost first among equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return (whole,)
    return _merge_long(piece, ranks) if len(piece) >= HEAP_FROM else _merge_short(piece, ranks)


def _merge_short(piece, ranks):
    bounds = list(range(len(piece) + 1))
    none = len(ranks) + 256
    pair = [ranks.get(piece[i: i + 2], none) for i in range(len(piece) - 1)]
    while pair and (best := min(pair)) != none:
        i = pair.index(best)
        del bounds[i + 1], pair[i]
        if i < len(pair):
            pair[i] = ranks.get(piece[bounds[i]: bounds[i + 2]], none)
        if i:
            pair[i - 1] = ranks.get(piece[bounds[i - 1]: bounds[i + 1]], none)
    return tuple(ranks[piece[a:b]] for a, b in pairwise(bounds))


def _merge_long(piece, ranks):
    """The same in n log n: a heap of pairs by (rank, place); an entry is void when its bytes are no pair any more."""
    n = len(piece)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n  # by first byte of a part

    def pair(i):
        if end[i] < n and (rank := ranks.get(piece[i: end[end[i]]])) is not None:
            return rank, i, end[end[i]]

    heap = [p for i in range(n - 1) if (p := pair(i))]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not alive[i] or middle >= n or end[middle] != stop:
            continue
        alive[middle], end[i] = False, stop
        if stop < n:
            before[stop] = i
        for j in (before[i], i):
            if j >= 0 and (p := pair(j)):
                heapq.heappush(heap, p)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i: end[i]]])
        i = end[i]
    return tuple(out)


def read_ranks(path: str) -> bytes:
    """Content of a rank file: a line has a token in base64 and its rank."""
    content = Path(path).read_bytes()
    if len(content) > RANKS_LIMIT:
        raise ValueError(f"{path} has {len(content)} bytes, more than the {RANKS_LIMIT} that are broadcast")
    return content


def _ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def _bytes_of(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in a row, and first byte and length by id; an id without token has length -1."""
    size = max(ranks.values(), default=-1) + 1
    first, length = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    at = 0
    for token, rank in ranks.items():
        first[rank], length[rank] = at, len(token)
        at += len(token)
    return np.frombuffer(b"".join(ranks), np.uint8), first, length


def encode(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, ids (array of int), ends (array of int: offset in bytes after each token).

    The same ids as the tokenizer library gives for the ranks in ``path`` without special tokens. Null and empty texts
    have no ids; texts are encoded whole, however long; repeated rows and null doc_ids stay; other columns are ignored;
    an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(path), unicode_classes()))

    def run(batches):
        content, runs = shared.value
        ranks, splitter, cache = _ranks(content), Splitter(runs), {}
        length = _bytes_of(ranks)[2]

        def tokens(piece):
            found = merge(piece, ranks)
            if len(piece) <= CACHE_BYTES:
                if len(cache) >= CACHE_PIECES:  # what is common comes back at once
                    cache.clear()
                cache[piece] = found
            return found

        for b in batches:
            for lo, hi, data, at in groups(b.column("text")):
                ids, ends = [], []
                for k, bounds in enumerate(piece_ends(splitter, data, at)):
                    raw = data[at[k]: at[k + 1]].tobytes()
                    pieces = [raw[a:b] for a, b in pairwise(bounds.tolist())]
                    found = [t if (t := cache.get(p)) is not None else tokens(p) for p in pieces]
                    ids.append(np.fromiter(chain.from_iterable(found), np.int32))
                    ends.append(np.cumsum(length[ids[-1]]))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), _lists(ids), _lists(ends)], ["doc_id", "ids", "ends"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, ends array<int>")


def _lists(arrays) -> pa.Array:
    offsets = np.cumsum([0, *(len(a) for a in arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *arrays]).astype(np.int32)))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds the column decoded (binary) to rows with ids and ends; all other columns stay.

    Offsets say where each token's bytes go. Ids that the vocabulary lacks, or tokens that do not fit their offsets, are
    an error; null arrays count as empty.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))
    others = encoded.columns

    def run(batches):
        data, first, length = _bytes_of(_ranks(shared.value))
        for b in batches:
            ids, ends = (pa.array(b.column(c)) if isinstance(b.column(c), pa.ChunkedArray) else b.column(c) for c in ("ids", "ends"))
            out = []
            for i, e in zip(ids, ends):
                own = i.values.to_numpy(zero_copy_only=False) if i.is_valid else np.zeros(0, np.int32)
                stop = e.values.to_numpy(zero_copy_only=False) if e.is_valid else np.zeros(0, np.int32)
                if len(own) != len(stop) or (len(own) and (own.min() < 0 or own.max() >= len(length))):
                    raise ValueError("ids and offsets are not those of this vocabulary")
                size = length[own]
                start = stop - size
                if (size < 0).any() or (start != np.append(0, stop[:-1])[: len(stop)]).any():
                    raise ValueError("tokens do not fit their offsets")
                place = np.repeat(first[own] - start, size) + np.arange(int(stop[-1]) if len(stop) else 0)
                out.append(data[place].tobytes())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in others), pa.array(out, pa.binary())], [*others, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{kinds}, decoded binary")


def ids_text(ids: Column) -> Column:
    """Decimal ids with one space between them."""
    return F.array_join(ids.cast("array<string>"), " ")
