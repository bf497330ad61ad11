"""Words of ASCII letters, digits and all characters above ASCII, A-Z lower-cased, as byte spans of Arrow text groups."""

from __future__ import annotations

import zlib

import numpy as np

from gridpulse.llm.texthash import Rolling

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
for _first, _last in ((48, 57), (65, 90), (97, 122), (128, 255)):
    _INSIDE[_first: _last + 1] = True
# Step table of the CRC-32 of zlib, from its polynomial.
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & np.uint32(1), (_CRC >> np.uint32(1)) ^ np.uint32(0xEDB88320), _CRC >> np.uint32(1))
_ONES = np.uint32(0xFFFFFFFF)
_STEPS = 64  # bytes of a word that are folded for all words at once; longer words go on alone


def spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of the words, and words per text, of texts ``data[at[i]:at[i + 1]]``."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return data, none, none, np.zeros(len(at) - 1, np.int64)
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)  # a text starts or ends here
    edge[at] = True
    before, after = np.concatenate([[False], inside]), np.concatenate([inside, [False]])
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return _LOWER[data], starts, ends, np.diff(np.searchsorted(starts, at))


def hashes(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    return Rolling(lower).spans(starts, ends).view(np.int64) if len(starts) else np.zeros(0, np.int64)


def crc_after(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 registers after the bytes of the spans, from the registers ``state`` before them."""
    length = ends - starts
    order = np.argsort(-length, kind="stable")  # spans that still have bytes are a prefix
    out, first, left = state[order], starts[order], length[order]
    for j in range(min(int(left[0]) if len(left) else 0, _STEPS)):
        n = int(np.searchsorted(-left, -j, "left"))
        out[:n] = _CRC[(out[:n] ^ data[first[:n] + j]) & np.uint32(255)] ^ (out[:n] >> np.uint32(8))
    for k in range(int(np.searchsorted(-left, -_STEPS, "left"))):
        rest = data[first[k] + _STEPS: first[k] + left[k]].tobytes()
        out[k] = zlib.crc32(rest, int(out[k] ^ _ONES)) ^ 0xFFFFFFFF
    back = np.empty_like(out)
    back[order] = out
    return back


def gram_crcs(lower, starts, ends, counts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 of every word, and of every two neighbouring words of a text joined by one space; each with its text."""
    owner = np.repeat(np.arange(len(counts)), counts)
    one = crc_after(np.full(len(starts), _ONES, np.uint32), lower, starts, ends)
    next_to = np.flatnonzero(owner[1:] == owner[:-1])
    space = one[next_to]
    space = _CRC[(space ^ np.uint32(32)) & np.uint32(255)] ^ (space >> np.uint32(8))
    two = crc_after(space, lower, starts[next_to + 1], ends[next_to + 1])
    return one ^ _ONES, owner, two ^ _ONES, owner[next_to]
