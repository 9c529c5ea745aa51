"""License scans by a positional index of rare words.

A template is a licence notice (a word sequence) with a mandatory key phrase. The
postings list, for each word, the templates whose key phrase has it as its rarest word
in the corpus (highest IDF), with its place there. A file's words are looked up once;
each posting of a hit proposes a start of one template's phrase, and the phrase's next
rarest words confirm or drop all proposals together, at their relative positions, until
the whole phrase is verified. So every place of a phrase is found, common words are
only looked at where a rare one stands, and a template none of whose rarest words
occurs costs nothing. The words of the notice around a verified phrase give the score:
the IDF share of the notice that is there.

Two narrow passes: document frequencies of the template words (partial counts
summed; as many rows as template words), then the scan.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as X
from .common import batch, map_batches

# Label, notice, key phrase. The first three are the base phrases.
BASE = [("cc-by", "cc by", "cc by"), ("gpl", "general public license", "general public license"),
        ("reserved", "all rights reserved", "all rights reserved")]
TEMPLATES = BASE + [
    ("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    ("apache", "licensed under the apache license version", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd", "cc by nd"),
    ("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    ("gpl", "this work is licensed under the gnu general public license version", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted free of charge"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("apache", "you may not use this file except in compliance with the license", "except in compliance with the license"),
    ("artistic", "under the terms of the artistic license", "artistic license"),
    ("boost", "distributed under the boost software license version", "boost software license"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain",
     "dedicated the work to the public domain"),
    ("cddl", "subject to the terms of the common development and distribution license", "common development and distribution license"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("eupl", "licensed under the european union public licence", "european union public licence"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license",
     "gnu free documentation license"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
     "general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "for any purpose with or without fee is hereby granted"),
    ("ms-pl", "licensed under the microsoft public license", "microsoft public license"),
    ("odbl", "made available under the open database license", "open database license"),
    ("ofl", "licensed under the sil open font license version", "sil open font license"),
    ("psf", "python software foundation license version", "python software foundation license"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable",
     "without any express or implied warranty"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
]

PROPOSALS = 2_000_000      # held at once by a task, and cells of its score table

U = np.uint64
_SEP = X.separators(X.NOT_ALNUM)


def hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return X.Words(data, np.array([0, len(data)]), _SEP).hash


class Index:
    """Word ids, and each template's notice and key phrase as word ids."""

    def __init__(self, templates):
        self.words = sorted({w for _, notice, key in templates for w in (notice + " " + key).split()})
        self.labels = [t[0] for t in templates]
        number = {w: i for i, w in enumerate(self.words)}
        self.notices = [[number[w] for w in t[1].split()] for t in templates]
        self.keys = [[number[w] for w in t[2].split()] for t in templates]
        # where the key phrase stands in its notice
        self.at = [next(i for i in range(len(n)) if n[i:i + len(k)] == k) for n, k in zip(self.notices, self.keys)]
        h = hash_words(self.words)
        order = np.argsort(h)
        self._hash, self._id = h[order], order
        self._bits = np.zeros(1 << 16, bool)
        self._bits[(h >> U(48)).astype(np.int64)] = True

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Word id of each hash, -1 for words of no template."""
        out = np.full(len(h), -1, np.int32)
        maybe = np.flatnonzero(self._bits[(h >> U(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self._hash, h[maybe]), len(self._hash) - 1)
        hit = self._hash[at] == h[maybe]
        out[maybe[hit]] = self._id[at[hit]]
        return out

    def post(self, idf: np.ndarray) -> None:
        """Builds the postings: templates by the rarest word of their key phrase."""
        self.idf = idf
        rank = [sorted(range(len(k)), key=lambda j: (-idf[k[j]], j)) for k in self.keys]
        width = max(map(len, self.keys))
        # each phrase's words and their places, rarest first; -1 after its last
        self.place = np.array([r + [-1] * (width - len(r)) for r in rank])
        self.word = np.array([[k[j] for j in r] + [-1] * (width - len(r)) for k, r in zip(self.keys, rank)])
        self.size = np.array([len(k) for k in self.keys])
        self.posted = np.argsort(self.word[:, 0], kind="stable")
        self.first = np.searchsorted(self.word[self.posted, 0], np.arange(len(self.words) + 1))
        self.offset = np.array(self.at)
        long = max(map(len, self.notices))
        self.notice = np.array([n + [-1] * (long - len(n)) for n in self.notices])
        self.weight = np.where(self.notice >= 0, idf[self.notice], 0.0)

    def scan(self, w: X.Words):
        """(template, document, start, score) of every verified key phrase, as arrays, some
        hits at a time. Starts are counted in the slice."""
        ids = self.ids(w.hash)
        hits = np.flatnonzero(ids >= 0)
        fan = np.diff(self.first)[ids[hits]]
        hits, fan = hits[fan > 0], fan[fan > 0]
        ends, at = np.cumsum(fan), 0
        while at < len(hits):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PROPOSALS, "right")))
            yield self._verify(w, ids, hits[at:to], fan[at:to])
            at = to

    def _verify(self, w: X.Words, ids: np.ndarray, hits: np.ndarray, fan: np.ndarray):
        nth = np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan)
        t = self.posted[np.repeat(self.first[ids[hits]], fan) + nth]
        d = np.repeat(np.searchsorted(w.first, hits, "right") - 1, fan)
        start = np.repeat(hits, fan) - self.place[t, 0]
        ok = (start >= w.first[d]) & (start + self.size[t] <= w.first[d + 1])
        t, d, start = t[ok], d[ok], start[ok]
        for j in range(1, self.word.shape[1]):
            more = np.flatnonzero(self.size[t] > j)
            if not len(more):
                break
            ok = np.ones(len(t), bool)
            ok[more] = ids[start[more] + self.place[t[more], j]] == self.word[t[more], j]
            t, d, start = t[ok], d[ok], start[ok]
        score = np.zeros(len(t))
        step = max(1, PROPOSALS // self.notice.shape[1])
        for lo in range(0, len(t), step):
            u, e = t[lo:lo + step], d[lo:lo + step][:, None]
            pos = (start[lo:lo + step] - self.offset[u])[:, None] + np.arange(self.notice.shape[1])
            inside = (pos >= w.first[e]) & (pos < w.first[e + 1])
            there = inside & (ids[np.clip(pos, 0, len(ids) - 1)] == self.notice[u])
            score[lo:lo + step] = np.where(there, self.weight[u], 0.0).sum(axis=1) / self.weight[u].sum(axis=1)
        return t, d, start, score


_COUNTS = pa.schema([("word", pa.int32()), ("n", pa.int64())])
_ROWS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                   ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                   ("places", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())])))])


def _doc_counts(batches, templates):
    index = Index(templates)
    total, docs = np.zeros(len(index.words), np.int64), 0
    for b in batches:
        for lo, hi, offsets, data in X.slices(b.column(1)):
            w = X.Words(data, offsets, _SEP)
            ids = index.ids(w.hash)
            hits = np.flatnonzero(ids >= 0)
            doc = np.searchsorted(w.first, hits, "right") - 1
            pair = np.unique(doc * len(index.words) + ids[hits])
            total += np.bincount(pair % len(index.words), minlength=len(index.words))
            docs += hi - lo
    if docs:
        yield batch(_COUNTS, np.arange(-1, len(index.words), dtype=np.int32), np.concatenate([[docs], total]))


def _scan(batches, templates, n_base, idf):
    index = Index(templates)
    index.post(idf)
    for b in batches:
        for lo, hi, offsets, data in X.slices(b.column(1)):
            w = X.Words(data, offsets, _SEP)
            n = hi - lo
            places: list[list] = [[] for _ in range(n)]
            base: list[list] = [[] for _ in range(n)]
            score = np.zeros(n)
            for t, d, start, share in index.scan(w):
                np.maximum.at(score, d, share)
                for k, doc, s in zip(t.tolist(), d.tolist(), (start - w.first[d]).tolist()):
                    places[doc].append((index.labels[k], s))
                    if k < n_base:
                        base[doc].append((index.labels[k], s))
            starts = [[s for _, s in x] for x in base]
            yield batch(_ROWS, b.column(0).slice(lo, n), np.diff(w.first), [len(x) for x in base],
                        [min(x, default=None) for x in starts], [max(x, default=None) for x in starts],
                        [",".join(sorted({k for k, _ in x})) for x in base], [",".join(sorted({k for k, _ in x})) for x in places],
                        np.clip(score, 0, 1),
                        [[{"label": k, "start": s} for k, s in sorted(set(x), key=lambda p: (p[1], p[0]))] for x in places])


def scan(docs: DataFrame, templates=TEMPLATES, n_base: int = len(BASE)) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    places) of every row's whole text; the first ``n_base`` templates are the base.

    Null, empty and wordless texts: no words, no places, empty labels, null first
    and last word, score 0. Equal IDFs are looked up in the phrase's order; every
    order finds the same places. Repeated rows each get a row, null doc_ids too;
    extra columns are left out. ``places`` lists (label, start word) by start.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = map_batches(src, lambda it: _doc_counts(it, templates), "word int, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()          # a row for each template word
    df = {r["word"]: r["n"] for r in counts}
    idf = np.array([np.log((1 + df.get(-1, 0)) / (1 + df.get(i, 0))) + 1 for i in range(len(Index(templates).words))])
    return map_batches(src, lambda it: _scan(it, templates, n_base, idf),
                       "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                       "labels string, score double, places array<struct<label:string,start:long>>")
