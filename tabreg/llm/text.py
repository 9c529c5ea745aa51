"""Vectorised words of whole texts, on the bytes of an Arrow string column.

Every function works on a slice of documents at a time: the UTF-8 bytes of the
slice are one NumPy array, words are found by a 256-entry separator table and
hashed to 64 bits with a running polynomial, so no Python string is built. All
separators are ASCII, so a byte table is exact on UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19      # text bytes handled at once (about 20 times that in arrays); one longer text is a slice of its own

SPACES = [0x20, *range(0x09, 0x0E)]                                   # [^\x20\x09-\x0D]+
NOT_ALNUM = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]   # after lower-casing A-Z

U = np.uint64
_R = 0x9E3779B97F4A7C15 & ~7 | 5           # odd, 5 mod 8: powers stay distinct
_R_INV = pow(_R, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective): spreads every input bit over the word."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r^0..r^(n-1) and the inverses, mod 2^64; grown by doubling and kept."""
    if "p" not in _POW or len(_POW["p"]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for key, r in (("p", _R), ("q", _R_INV)):
            out, have = np.ones(size, U), 1
            while have < size:
                out[have:2 * have] = out[:have] * U(pow(r, have, 1 << 64))
                have *= 2
            _POW[key] = out
    return _POW["p"], _POW["q"]


def separators(codes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(codes)] = True
    return table


class Words:
    """Words of one slice: ``hash`` per word, ``first[d]:first[d+1]`` are the
    words of document d, ``begin``/``end`` their byte offsets in ``data``. A-Z count
    as a-z where ``fold``."""

    __slots__ = ("data", "begin", "end", "hash", "first", "offsets", "_run")

    def __init__(self, data, offsets, sep: np.ndarray, fold: bool = True):
        low = _LOWER[data] if fold else data
        n = len(low)
        self.data, self.offsets = data, offsets
        word = ~sep[low]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True                     # a text's first byte, and the end
        prev = np.empty(n, bool)
        prev[1:] = word[:-1]
        if n:
            prev[0] = False
        self.begin = np.flatnonzero(word & (~prev | edge[:n]))
        follow = np.zeros(n, bool)
        follow[:-1] = word[1:]
        self.end = np.flatnonzero(word & (~follow | edge[1:])) + 1
        p, q = _powers(max(n, 1))
        run = np.zeros(n + 1, U)
        np.cumsum(_BYTES[low] * p[:n], out=run[1:])
        h = (run[self.end] - run[self.begin]) * q[self.begin]
        self.hash = mix(h + (self.end - self.begin).astype(U) * U(0xD6E8FEB86659FD93))
        self.first = np.searchsorted(self.begin, offsets)
        self._run = run

    def heads(self, p: int) -> np.ndarray:
        """A hash of the first p bytes of each word (all, if it has fewer)."""
        stop = np.minimum(self.begin + p, self.end)
        return mix((self._run[stop] - self._run[self.begin]) * _powers(len(self._run))[1][self.begin])


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if not len(col):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets, raw


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, offsets from 0, bytes) of consecutive documents of about ``limit`` bytes."""
    offsets, raw = text_buffers(col)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, offsets[lo:hi + 1] - offsets[lo], raw[offsets[lo]:offsets[hi]]
        lo = hi


_SHINGLE = [0x8CB92BA72F3D8DD7, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]


def shingles(h: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of one document's word
    hashes; fewer words give the whole sequence as one, no words none."""
    n = len(h)
    if not n:
        return np.zeros(0, U)
    width = min(n, k)
    out = np.full(n - width + 1, U(width * 0x9FB21C651E98DF25 % (1 << 64)), U)
    for i in range(width):
        out += h[i:n - width + 1 + i] * U(_SHINGLE[i % 5] + 2 * (i // 5))
    return np.unique(mix(out))
