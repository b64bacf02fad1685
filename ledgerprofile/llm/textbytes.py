"""UTF-8 texts of an Arrow batch as flat numpy arrays: words, word hashes, shingles.

Helpers for the operators that run numpy inside Spark tasks.  A batch is handled in slices
of about ``SLICE_BYTES`` of text so that the working arrays stay small whatever the batch
holds; one text longer than that is a slice of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

# Odd 64-bit multipliers of the mixing function and of the word polynomial.
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NEXT = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX_A
    x ^= x >> np.uint64(27)
    x *= _MIX_B
    x ^= x >> np.uint64(31)
    return x


def flat(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    n = len(texts)
    off = np.frombuffer(offsets, np.int64)[texts.offset: texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes each (one row at least)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Byte spans of the words (maximal runs of ``is_word`` bytes inside one text).

    Returns (starts, ends, first): word ``k`` of text ``d`` has the index ``first[d] + k``.
    """
    inside = is_word[data]
    begins, stops = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        heads = offsets[:-1][np.diff(offsets) > 0]
        begins[heads] = inside[heads]
        tails = heads[heads > 0] - 1
        stops[tails] = inside[tails]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def byte_values(seed: int, fold_ascii: bool = True) -> np.ndarray:
    """A random 64-bit value per byte; with ``fold_ascii`` A-Z take the values of a-z."""
    v = np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
    if fold_ascii:
        v[65:91] = v[97:123]
    return v


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte run ``starts[k]:ends[k]`` (sorted, disjoint runs)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    edges = np.concatenate(([0], np.cumsum(lens)))
    at = np.arange(edges[-1]) - np.repeat(edges[:-1], lens)
    powers = np.full(int(lens.max()), _BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    terms = values[data[np.repeat(starts, lens) + at]]
    terms *= powers[at]
    return mix64(np.add.reduceat(terms, edges[:-1]) + lens.astype(np.uint64))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``width``-word windows; fewer words but some: the whole sequence as one."""
    n = len(words)
    if not n:
        return words
    width = min(width, n)
    out = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        out *= _NEXT
        out += words[k: n - width + 1 + k]
    return mix64(out + np.uint64(width))


# Word classes of the contracts.
SPACE_SEPARATED = np.ones(256, bool)
SPACE_SEPARATED[[32, 9, 10, 11, 12, 13]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


class HashIndex:
    """Positions of distinct 64-bit keys, looked up for whole arrays at once."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.rows = np.full(1 << bits, -1, np.int32)
        self.keys = np.zeros(1 << bits, np.uint64)
        keys = keys.astype(np.uint64)
        pending, slots = np.arange(len(keys)), self._home(keys)
        while len(pending):
            free = np.flatnonzero(self.rows[slots] < 0)
            _, first = np.unique(slots[free], return_index=True)
            won = free[first]
            self.rows[slots[won]] = pending[won]
            self.keys[slots[won]] = keys[pending[won]]
            lost = np.ones(len(pending), bool)
            lost[won] = False
            pending, slots = pending[lost], (slots[lost] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _BASE) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is none of the index."""
        slots = self._home(keys)
        rows = self.rows[slots]
        open_ = np.flatnonzero((rows >= 0) & (self.keys[slots] != keys))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            rows[open_] = self.rows[slots[open_]]
            open_ = open_[(rows[open_] >= 0) & (self.keys[slots[open_]] != keys[open_])]
        return rows
