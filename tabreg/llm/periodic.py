"""Periodic run detection by block convolution.

A run is a stretch of consecutive words with smallest period q and at least
``max(MIN_WORDS, MIN_PERIODS * q)`` words that no neighbouring word extends.

At the scale L = 8, 16, 32, ... a text is cut into aligned blocks of L words. A run of
period q in [L, 2L) (below 2L for L = 8) holds a whole block whose copy q words later
is in the run as well: the starts s .. e - q are 2q >= 2L words or more (16 at least
for L = 8). So it is enough to find, for each block, the distances in that range at
which it occurs again: the sums of squared differences with all places of the window
that follows, ``sum a^2 + sum b^2 - 2 sum a b``, by a number-theoretic transform
modulo a prime. Words stand for residues, so an equal place gives exactly 0; a chance 0
fails the comparison of the words that follows. Each distance seeds an extension to
both sides, which gives the maximal stretch of that period.

Two exact rules keep the work small. At scale L only blocks are transformed all of
whose words lie in 8-grams that the text has again less than 2L words later (a block
of a run does). What lies in a run already found, block and copy, has only multiples
of its period.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as X
from .common import batch, map_batches

MIN_WORDS, MIN_PERIODS = 24, 3
GRAM = 8                   # also the smallest block
CELLS = 1 << 20            # residues transformed at once, or one block's window if that is longer

P = 15 * (1 << 27) + 1     # prime; transforms of up to 2^27 places
_ROOT = 31                 # a primitive root of P
U = np.uint64
_P = U(P)
_SEP = X.separators(X.SPACES)
_TWIDDLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}

_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct([
    ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])


def _twiddles(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n / 2 powers of a primitive n-th root of unity, and of its inverse."""
    if n not in _TWIDDLES:
        out = []
        for root in (pow(_ROOT, (P - 1) // n, P), pow(_ROOT, (P - 1) // n * (n - 1), P)):
            w, have = np.ones(max(1, n // 2), U), 1
            while have < len(w):
                w[have:2 * have] = w[:have] * U(pow(root, have, P)) % _P
                have *= 2
            out.append(w)
        _TWIDDLES[n] = out[0], out[1]
    return _TWIDDLES[n]


def ntt(a: np.ndarray) -> np.ndarray:
    """Transform of each row, in bit-reversed order (decimation in frequency)."""
    rows, n = a.shape
    a = a.copy()
    size = n
    while size > 1:
        half = size // 2
        v = a.reshape(rows, n // size, 2, half)
        lo, hi = v[:, :, 0], v[:, :, 1]
        s = lo + hi
        d = (lo + (_P - hi)) * _twiddles(size)[0] % _P
        v[:, :, 0], v[:, :, 1] = np.minimum(s, s - _P), d      # s - P wraps round where s < P
        size = half
    return a


def intt(a: np.ndarray) -> np.ndarray:
    """Inverse of ``ntt`` (decimation in time, from bit-reversed order)."""
    rows, n = a.shape
    a = a.copy()
    size = 2
    while size <= n:
        half = size // 2
        v = a.reshape(rows, n // size, 2, half)
        lo, hi = v[:, :, 0].copy(), v[:, :, 1] * _twiddles(size)[1] % _P
        s, d = lo + hi, lo + (_P - hi)
        v[:, :, 0], v[:, :, 1] = np.minimum(s, s - _P), np.minimum(d, d - _P)
        size *= 2
    return a * U(pow(n, -1, P)) % _P


def occurrences(x: np.ndarray, begin: np.ndarray, size: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance): the blocks ``x[b:b + size]``, b in ``begin``, occur ``distance``
    words later, for the distances ``first`` to ``2 * size - 1``. ``x`` holds residues;
    a place behind its end is 0."""
    wide = 3 * size - first                    # the window: from the first distance to the end of the last
    n = 1 << (wide - 1).bit_length()           # cyclic length: what wraps round falls on no distance asked for
    take = max(1, CELLS // n)
    found_b, found_d = [], []
    for at in range(0, len(begin), take):
        b = begin[at:at + take]
        place = b[:, None] + np.arange(first, 3 * size)
        w, head = np.zeros((len(b), n), U), np.zeros((len(b), n), U)
        w[:, :wide] = np.where(place < len(x), x[np.minimum(place, len(x) - 1)], U(0))
        block = x[b[:, None] + np.arange(size)]
        head[:, (-np.arange(size)) % n] = block                # reversed, so that the product is a correlation
        both = intt(ntt(w) * ntt(head) % _P)[:, :2 * size - first]
        square = np.zeros((len(b), wide + 1), U)
        np.cumsum(w[:, :wide] * w[:, :wide] % _P, axis=1, out=square[:, 1:])
        later = square[:, size:size + 2 * size - first] - square[:, :2 * size - first]
        own = (block * block % _P).sum(axis=1)
        r, d = np.nonzero((own[:, None] + later + U(2) * (_P - both)) % _P == 0)
        found_b.append(b[r])
        found_d.append(d + first)
    none = np.zeros(0, np.int64)
    return np.concatenate(found_b or [none]), np.concatenate(found_d or [none])


def extend(x: np.ndarray, at: int, d: int) -> tuple[int, int]:
    """[i, j) around ``at``: the largest stretch with x[k] == x[k + d] for all its k."""
    j, step, top = at, 64, len(x) - d
    while j < top:
        m = min(step, top - j)
        differ = np.flatnonzero(x[j:j + m] != x[j + d:j + d + m])
        if len(differ):
            j += int(differ[0])
            break
        j, step = j + m, step * 2
    i, step = at, 64
    while i > 0:
        m = min(step, i)
        differ = np.flatnonzero(x[i - m:i] != x[i - m + d:i + d])
        if len(differ):
            i -= m - 1 - int(differ[-1])
            break
        i, step = i - m, step * 2
    return i, j


def recurrence(h: np.ndarray) -> np.ndarray:
    """For each ``GRAM``-gram, how many words later the text has it again (len(h), if never)."""
    n = len(h)
    g = np.zeros(n - GRAM + 1, U)
    for i in range(GRAM):
        g = g * U(0x9E3779B97F4A7C15) + h[i:n - GRAM + 1 + i]
    order = np.argsort(g, kind="stable")
    s = g[order]
    again = np.flatnonzero(s[1:] == s[:-1])
    out = np.full(len(g), n)
    out[order[again]] = order[again + 1] - order[again]
    return out


def _covered(near: np.ndarray, n: int) -> np.ndarray:
    """How many of the first i words lie in a gram marked ``near``, for i = 0 .. n."""
    mark = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(near)
    mark[at] += 1
    mark[at + GRAM] -= 1
    return np.concatenate([[0], np.cumsum(np.cumsum(mark[:-1]) > 0)])


class _Runs:
    """Runs found so far, and whether a stretch lies in one of them."""

    def __init__(self):
        self.found: dict[tuple[int, int], int] = {}

    def freeze(self):
        ends = sorted(self.found)
        self.start = np.array([s for s, _ in ends], np.int64)
        self.reach = np.maximum.accumulate(np.array([e for _, e in ends], np.int64)) if ends else self.start

    def hold(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(len(i), bool)
        at = np.searchsorted(self.start, i, "right") - 1
        return (at >= 0) & (self.reach[at] >= j)


def find_runs(h: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text of word hashes, by start, then period."""
    n = len(h)
    if n < MIN_WORDS:
        return []
    again = recurrence(h)
    least = int(again.min())
    if MIN_PERIODS * least > n:
        return []
    x = h % U(P - 1) + U(1)                       # never 0, which is the padding
    runs = _Runs()
    size = GRAM
    while size == GRAM or MIN_PERIODS * size <= n:
        if least < 2 * size:                      # a run's grams occur again a period later, or sooner
            covered = _covered(again < 2 * size, n)
            begin = np.arange(0, n - size, size)
            begin = begin[covered[begin + size] - covered[begin] == size]
            runs.freeze()                         # periods below size: all that a stretch in one of them can add
            begin = begin[~runs.hold(begin, begin + 3 * size)]      # are multiples of its period
            if len(begin):
                b, d = occurrences(x, begin, size, 1 if size == GRAM else size)
                new = ~runs.hold(b, b + d + size)
                b, d = b[new], d[new]
                order = np.lexsort((b, d))
                _seeds(h, b[order], d[order], runs.found)
        size *= 2
    return sorted((s, e - s, q) for (s, e), q in runs.found.items())


def _seeds(h: np.ndarray, b: np.ndarray, d: np.ndarray, runs: dict) -> None:
    """Extend seeds in the order of their distances; the smallest distance of a stretch is its period."""
    k = 0
    while k < len(b):
        at, q = int(b[k]), int(d[k])
        i, j = extend(h, at, q)
        if j + q - i >= max(MIN_WORDS, MIN_PERIODS * q):
            runs.setdefault((i, j + q), q)
        k += 1
        if j > at:                                # the next seeds of this distance lie in the same stretch
            last = k + int(np.searchsorted(d[k:], q, "right"))
            k += int(np.searchsorted(b[k:last], j, "left"))


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Periodic tails for a tenth of all documents, by their ids: which word each
    place takes, or None for all as they are (so without a doc_id or words)."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def _collapsed(words: list[bytes], runs) -> bytes:
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for s, m, q in runs:
            drop[s + q] += 1
            drop[s + m] -= 1
        drop = np.cumsum(drop)
        words = [words[i] for i in np.flatnonzero(drop[:-1] == 0)]
    return b" ".join(words)


def _detect(batches: Iterator[pa.RecordBatch], rewrite):
    for b in batches:
        ids = b.column(0).to_pylist()
        for lo, hi, offsets, data in X.slices(b.column(1)):
            w = X.Words(data, offsets, _SEP, fold=False)
            raw, out = data.tobytes(), []
            for i in range(hi - lo):
                h = w.hash[w.first[i]:w.first[i + 1]]
                words = raw[offsets[i]:offsets[i + 1]].split()     # bytes.split() takes the same white space
                order = rewrite(ids[lo + i], len(words)) if rewrite else None
                if order is not None:
                    h, words = h[order], [words[k] for k in order]
                runs = find_runs(h)
                out.append((ids[lo + i], len(words), [{"start": s, "length": m, "period": q} for s, m, q in runs],
                            _collapsed(words, runs).decode()))
            yield batch(_OUT, *zip(*out))


def periodic_runs(docs: DataFrame, rewrite=None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs`` (doc_id, text).

    ``runs`` lists every run as (start, length, period), by start, then period;
    ``collapsed`` is the text without the words that any run holds after its first
    period, joined by single spaces. ``rewrite(doc_id, n)`` may name the word that
    each place takes. Null or empty text: no words, no runs, empty. Rows are judged one
    by one, so null and repeated ids, ties and repeated rows keep their own rows; an
    empty table gives an empty table. Texts of any length are taken whole: memory is
    a few arrays of the longest text. Extra columns are ignored.
    """
    docs = docs.selectExpr("cast(doc_id as long) AS doc_id", "cast(text as string) AS text")
    return map_batches(docs, lambda it: _detect(it, rewrite),
                       "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
