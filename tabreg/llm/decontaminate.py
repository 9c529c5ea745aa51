"""Benchmark decontamination by CGK embedding, bit-sampling LSH and edit distance.

Texts are sequences of word hashes (ASCII punctuation and case do not count). A
passage leaks an item if at most ``EDITS`` of the item's words are edited.

* **Embedding.** A CGK walk reads a sequence and at each step writes the word it stands
  on, then stays or moves on by a random bit of that word and step. Equal sequences give
  equal walks; after an edit two walks differ until they fall into step again, so a small
  edit distance becomes a small Hamming distance.
* **Windows.** ``WALKS`` walks start at each word of a text and at each word of an item, so
  a window of the item's size that starts anywhere in a passage meets the rest of its item.
* **Sampling.** Each walk is sampled by ``TABLES`` keys of three of its steps, drawn from its
  first 5, 8 and 12. An item key counts only if its steps stand on three different places.
  Recall at the full ``EDITS`` is 0.99 or more at each length that the tests measure.
* **Short items**, of fewer than ``SHORT`` words, have too few words to sample: of k + 1
  pieces that do not overlap, one is untouched by k edits, so exact pieces find them all.
* **Verification.** All proposals of a slice of text are verified together: equal words
  first, then a lower bound by absent words, then the smallest edit distance between the
  item and any passage of the window.

Keys of a block of items (``BLOCK`` words of them, about 0.2 KB each) are broadcast; further
blocks are further passes, one after another. Nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as X
from .common import batch, keep_rows, map_batches, write_table

EDITS = 0.2              # edits allowed, as a share of the item's words
SHORT = 10               # items of fewer words are searched by exact pieces
WALKS = 4
TABLES = (5, 8, 12)      # keys of a walk: three of its first so many steps
BLOCK = 250_000          # words of items in one broadcast: at most 48 MB of keys
WINDOWS = 1 << 16        # walks held at once
CELLS = 1 << 21          # words, or pairs of words, of proposals verified at once

U = np.uint64
_SEP = X.separators(X.NOT_ALNUM)
_OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()), ("edits", pa.int64()),
                  ("n_words", pa.int64())])


def pieces(n: int) -> list[tuple[int, int]]:
    """(first word, words) of the pieces of an item of n words: one more than its edits."""
    at = np.linspace(0, n, int(EDITS * n) + 2).astype(int).tolist()
    return [(a, b - a) for a, b in zip(at, at[1:])]


def runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words."""
    out = np.full(max(len(h) - n + 1, 0), U(n))
    for i in range(n if len(out) else 0):
        out += h[i:i + len(out)] * U(X._SHINGLE[i])
    return X.mix(out)


class Lookup:
    """Rows of a fixed table by 64-bit hash: a bit table, then a search."""

    def __init__(self, hashes: np.ndarray, *columns: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.sorted, self.columns = hashes[order], [c[order] for c in columns]
        size = min(max(int(16 * len(hashes)).bit_length(), 10), 26)
        self._shift = U(64 - size)
        self._bits = np.zeros(1 << size, bool)
        self._bits[(hashes >> self._shift).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """(index in ``h``, columns): every table row of every hash."""
        maybe = np.flatnonzero(self._bits[(h >> self._shift).astype(np.int64)])
        lo = np.searchsorted(self.sorted, h[maybe], "left")
        n = np.searchsorted(self.sorted, h[maybe], "right") - lo
        row = np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)
        return np.repeat(maybe, n), *(c[row] for c in self.columns)


def walk(h: np.ndarray, r: int, windows: int, n: int = TABLES[-1]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, places), each (n, windows): walk r from each of the first ``windows`` words."""
    symbol = X.mix(h + U((r + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    symbol = np.concatenate([symbol, np.zeros(1, U)])      # past the end: stays there
    out, places = np.empty((n, windows), U), np.empty((n, windows), np.int32)
    pos = np.arange(windows, dtype=np.int32)
    for j in range(n):
        places[j] = pos
        out[j] = symbol[pos]
        pos += ((out[j] >> U(j)) & U(1)).astype(np.int32)
    return out, places


def sampled(r: int) -> list[list[int]]:
    """The steps that each key of walk r reads: fixed draws."""
    rng = np.random.RandomState(r)
    return [sorted(rng.choice(span, 3, replace=False).tolist()) for span in TABLES]


def keys(symbols: np.ndarray, r: int):
    """(steps, key of each window) of each table of walk r."""
    for t, steps in enumerate(sampled(r)):
        own = np.full(symbols.shape[1], U(r * len(TABLES) + t))
        for i, j in enumerate(steps):
            own += symbols[j] * U(X._SHINGLE[i])
        yield steps, X.mix(own)


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(smallest edit distance between ``item`` and any part of ``text``, end of that part)."""
    at = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, symbol in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        np.minimum(row[:-1] + (text != symbol), row[1:] + 1, out=new[1:])
        row = np.minimum.accumulate(new - at) + at
    end = int(row.argmin())
    return int(row[end]), end


def distances(item: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``edit_distance`` of many pairs at once: (pairs, words) each."""
    at = np.arange(text.shape[1] + 1)
    row = np.zeros((len(item), len(at)), np.int64)
    for i in range(item.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        np.minimum(row[:, :-1] + (text != item[:, i:i + 1]), row[:, 1:] + 1, out=new[:, 1:])
        row = np.minimum.accumulate(new - at, axis=1) + at
    end = row.argmin(1)
    return row[np.arange(len(row)), end], end


def absent(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How many of each item's words its text lacks: a lower bound of their edit distance."""
    return (~(item[:, :, None] == text[:, None, :]).any(2)).sum(1)


class ItemIndex:
    """A block of items: keys of their walks, and pieces of the short ones by their number of words."""

    def __init__(self, ids: list[int], words: list[np.ndarray], short: int = SHORT):
        self.ids, self.words = ids, words
        self.sizes = np.array([len(w) for w in words], np.int64)
        held: dict = {}
        found: list = []
        for i, w in enumerate(words):
            if len(w) < short:
                for at, n in pieces(len(w)):
                    held.setdefault(n, []).append((runs(w[at:at + n], n)[0], i, at))
                continue
            for r in range(WALKS):
                symbols, places = walk(w, r, len(w))
                for (a, b, c), key in keys(symbols, r):
                    own = np.flatnonzero((places[a] < places[b]) & (places[b] < places[c]) & (places[c] < len(w)))
                    found.append((key[own], np.full(len(own), i, np.int32), own.astype(np.int32)))
        self.pieces = {n: Lookup(*(np.array(x, t) for x, t in zip(zip(*rows), (U, np.int32, np.int32))))
                       for n, rows in held.items()}
        self.walks = Lookup(*(np.concatenate(x) for x in zip(*found))) if found else None

    def hits(self, w: X.Words) -> tuple[np.ndarray, ...]:
        """(start of the item in the slice, item, document): distinct proposals for a text slice."""
        got = []
        for n, known in self.pieces.items():
            at, item, place = known.find(runs(w.hash, n))
            got.append((at, item, place))
        if self.walks:
            for lo in range(0, len(w.hash), WINDOWS):
                windows = min(WINDOWS, len(w.hash) - lo)
                for r in range(WALKS):
                    symbols, _ = walk(w.hash[lo:lo + windows + TABLES[-1]], r, windows)
                    for _, key in keys(symbols, r):
                        at, item, place = self.walks.find(key)
                        got.append((at + lo, item, place))
        at, item, place = (np.concatenate(x).astype(np.int64) for x in zip(*got))
        doc = np.searchsorted(w.first, at, "right") - 1
        start = at - place
        longest = int(self.sizes.max())       # a start may lie before its document: keep documents apart
        _, own = np.unique((start + (2 * doc + 1) * longest) * len(self.ids) + item, return_index=True)
        return start[own], item[own], doc[own]

    def verified(self, w: X.Words, start: np.ndarray, item: np.ndarray, doc: np.ndarray):
        """(proposals that hold their item, their edits, end of the passage) of proposals whose items
        have one length."""
        n = int(self.sizes[item[0]])
        slack = int(EDITS * n)
        first, last = w.first[doc], w.first[doc + 1]
        words = np.stack([self.words[i] for i in item.tolist()])
        near = np.arange(-slack, n + slack)   # starts shift by the edits before the piece
        at = start[:, None] + near
        inside = (at >= first[:, None]) & (at < last[:, None])
        # words outside the document differ from all of the item's, and cost an edit each
        text = np.where(inside, w.hash[np.clip(at, 0, len(w.hash) - 1)], U(0))
        same = (text[:, slack:slack + n] == words).all(1)
        edits, stop = np.zeros(len(item), np.int64), start + n
        left = np.flatnonzero(~same)
        if n * len(near) > CELLS:             # one proposal of a very long item
            for x in left.tolist():
                edits[x], stop[x] = edit_distance(words[x], text[x])
        else:
            edits[left] = absent(words[left], text[left])
            left = left[edits[left] <= slack]
            edits[left], stop[left] = distances(words[left], text[left])
        stop[left] += start[left] - slack
        good = np.flatnonzero(edits <= slack)
        return good, edits[good], np.minimum(stop[good], last[good])


def _found(col: pa.Array, index: ItemIndex):
    """(documents in the slice, {(document, item): (edits, start word)}) of each slice."""
    for lo, hi, offsets, data in X.slices(col):
        w = X.Words(data, offsets, _SEP)
        best: dict = {}
        start, item, doc = index.hits(w) if index.ids and len(w.hash) else (np.zeros(0, np.int64),) * 3
        size = index.sizes[item]
        for n in np.unique(size).tolist():
            own = np.flatnonzero(size == n)
            step = max(CELLS // (n * (n + 2 * int(EDITS * n))), 1)
            for x in range(0, len(own), step):
                part = own[x:x + step]
                good, edits, stop = index.verified(w, start[part], item[part], doc[part])
                at = np.maximum(stop - n, w.first[doc[part][good]]) - w.first[doc[part][good]]
                for key in zip(doc[part][good].tolist(), item[part][good].tolist(), edits.tolist(), at.tolist()):
                    best[key[:2]] = min(best.get(key[:2], (1 << 60, 0)), key[2:])
        yield hi - lo, best


def _search(batches, shared):
    index: ItemIndex = shared.value
    for b in batches:
        at = 0
        for n, best in _found(b.column(1), index):
            if best:
                doc = b.column(0).slice(at, n).to_pylist()
                yield batch(_OUT, *zip(*[(doc[d], index.ids[i], start, edits, len(index.words[i]))
                                         for (d, i), (edits, start) in sorted(best.items())]))
            at += n


def item_words(texts: list[str]) -> list[np.ndarray]:
    out = []
    for _, _, offsets, data in X.slices(pa.array(texts, pa.string())):
        w = X.Words(data, offsets, _SEP)
        out += [w.hash[w.first[i]:w.first[i + 1]] for i in range(len(offsets) - 1)]
    return out


def indexes(benchmark: DataFrame, block: int = BLOCK):
    """Broadcast indexes of the items, a block of words at a time."""
    sc = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .filter("text is not null")
    ids, words, size = [], [], 0
    for r in items.toLocalIterator():
        w = item_words([r["text"]])[0]
        if not len(w):
            continue
        if ids and size + len(w) > block:
            yield sc.broadcast(ItemIndex(ids, words))
            ids, words, size = [], [], 0
        ids.append(r["item_id"])
        words.append(w)
        size += len(w)
    if ids:
        yield sc.broadcast(ItemIndex(ids, words))


def leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, start_word, edits, n_words): each text that holds an item.

    One row for each row of ``docs`` (doc_id, text) and item (item_id, text) found,
    with the smallest edit distance over the text and about where the passage starts.
    Null, empty and wordless texts and items match nothing. Rows with repeated
    doc_ids or item_ids are searched each by itself, null ids included; extra
    columns are ignored; empty tables give an empty table.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, start_word long, edits long, n_words long"
    out = last = None
    for shared in indexes(benchmark, block):
        if last is not None:                  # a further block: the one before is written and let go
            out = _written(last, out)
        last = shared, map_batches(src, lambda it, s=shared: _search(it, s), schema)
    if last is None:
        return docs.sparkSession.createDataFrame([], schema)
    return last[1] if out is None else out.unionByName(last[1])


def _written(part, out: DataFrame | None) -> DataFrame:
    shared, rows = part
    rows = write_table(rows, "leaks")
    shared.unpersist()
    return rows if out is None else out.unionByName(rows)


def _clean(cols, shared):
    for c in cols:
        mask = [np.zeros(0, bool)]
        for n, best in _found(c, shared.value):
            own = np.ones(n, bool)
            own[[d for d, _ in best]] = False
            mask.append(own)
        yield np.concatenate(mask)


def accepted(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    last = None
    for shared in indexes(benchmark, block):
        if last is not None:                  # as in ``leaks``
            docs = write_table(docs, "clean")
            last.unpersist()
        docs = keep_rows(docs, lambda cols, s=shared: _clean(cols, s))
        last = shared
    return docs
