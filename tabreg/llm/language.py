"""Language identification by nearest centroid.

A text is a TF-IDF vector, of length one, of hashed byte 2- and 3-grams of its
lower-cased letters (every run of other ASCII characters counts as one space).
Each language has several centroids: spherical k-means over a sample of its
labelled texts. The language of the closest centroid by cosine is predicted; a
text further from it than all but a few of that language's own texts, by a wide
margin, is rejected.

IDF counts every row that may be learned from (one pass, partial counts summed).
The centroids are fitted on ``SAMPLE`` texts of each language, the first by the
hash of doc_id. The model has languages * CLUSTERS vectors; prediction is one
narrow pass over whole texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as X
from .common import batch, keep_rows, map_batches

DIM = 1 << 13
CLUSTERS = 4
SAMPLE = 400             # texts of each language that its centroids are fitted on
ROUNDS = 8
REJECT_QUANTILE, REJECT_MARGIN = 0.005, 0.4     # rejected: cosine below margin * that quantile of the sample's
HELD_OUT = 4             # crc32(doc_id) mod 4 = 2 is held out
UNKNOWN = "und"

U = np.uint64
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def grams(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed n-grams of a slice, cut): document d has ``grams[cut[d]:cut[d+1]]``."""
    n = len(data)
    c = _FOLD[data]
    # capital letters of the Latin-1 range: C3 80..9E but 97
    up = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    c[up] += 0x20
    doc_first = np.zeros(n + 1, bool)
    doc_first[offsets] = True
    doc_first = doc_first[:n]
    blank = c == 0x20
    keep = np.ones(n, bool)
    keep[1:] = ~(blank[1:] & blank[:-1]) | doc_first[1:]
    before = np.concatenate([[0], np.cumsum(keep)])
    cut = before[offsets]
    c = c[keep].astype(np.int64)
    # a gram must end inside its document
    m = len(c)
    last = np.repeat(cut[1:], np.diff(cut))              # end of each position's document
    at = np.arange(m)
    two = np.flatnonzero(at + 2 <= last)
    three = np.flatnonzero(at + 3 <= last)
    g2 = c[two] << 8 | c[two + 1]
    g3 = c[three] << 16 | c[three + 1] << 8 | c[three + 2] | 1 << 25
    pos = np.concatenate([two, three])
    g = X.mix(np.concatenate([g2, g3]).astype(U)) >> U(64 - 13)
    # 2-grams and 3-grams of a document are two runs: give both cuts
    return g.astype(np.int64), np.stack([np.searchsorted(two, cut), len(two) + np.searchsorted(three, cut)]) \
        if len(pos) else np.zeros((2, len(cut)), np.int64)


def term_counts(offsets: np.ndarray, data: np.ndarray):
    """The DIM counts of every document of a slice."""
    g, cut = grams(offsets, data)
    for d in range(len(offsets) - 1):
        yield np.bincount(g[cut[0, d]:cut[0, d + 1]], minlength=DIM) + np.bincount(g[cut[1, d]:cut[1, d + 1]], minlength=DIM)


def vectors(offsets, data, idf: np.ndarray) -> np.ndarray:
    out = np.empty((len(offsets) - 1, DIM), np.float32)
    for d, c in enumerate(term_counts(offsets, data)):
        out[d] = np.log1p(c)
    out *= idf
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-12)


def has_letter(offsets, data) -> np.ndarray:
    """Whether each document of a slice has a letter of any script."""
    letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    out = letters[offsets[1:]] > letters[offsets[:-1]]
    wide = np.concatenate([[0], np.cumsum(data >= 0x80)])
    for d in np.flatnonzero(~out & (wide[offsets[1:]] > wide[offsets[:-1]])):
        out[d] = any(ch.isalpha() for ch in data[offsets[d]:offsets[d + 1]].tobytes().decode())
    return out


def _doc_counts(batches):
    schema = pa.schema([("gram", pa.int32()), ("n", pa.int64())])
    total, docs = np.zeros(DIM, np.int64), 0
    for b in batches:
        for _, _, offsets, data in X.slices(b.column(0)):
            for c in term_counts(offsets, data):
                total += c > 0
                docs += 1
    at = np.flatnonzero(total)
    if docs:
        yield batch(schema, np.concatenate([at, [-1]]).astype(np.int32), np.concatenate([total[at], [docs]]))


def cluster(x: np.ndarray, k: int = CLUSTERS, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means; starts from texts furthest from the earlier starts."""
    centre = x.mean(axis=0)
    start = [int(np.argmax(x @ centre))]
    while len(start) < min(k, len(x)):
        start.append(int(np.argmin((x @ x[start].T).max(axis=1))))
    c = x[start]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


def _fit_language(pdf: pd.DataFrame, idf: np.ndarray) -> pd.DataFrame:
    pdf = pdf.sort_values(["rank", "text"])
    x = np.concatenate([vectors(o, d, idf) for _, _, o, d in X.slices(pa.array(pdf["text"].tolist(), pa.string()))])
    c = cluster(x)
    floor = REJECT_MARGIN * float(np.quantile((x @ c.T).max(axis=1), REJECT_QUANTILE))
    return pd.DataFrame([(pdf["lang"].iloc[0], c.astype("<f4").tobytes(), floor)], columns=["lang", "centroids", "floor"])


class Model:
    """Languages, their centroids' rows and rejection floors, and the IDF."""

    def __init__(self, langs, centroids, owner, floors, idf):
        self.langs, self.centroids, self.owner, self.floors, self.idf = langs, centroids, owner, floors, idf


def _learnable(docs: DataFrame) -> DataFrame:
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")) \
        .filter((code % HELD_OUT != 2) & F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from text and lang of the rows that are not held out."""
    spark = docs.sparkSession
    known = _learnable(docs)
    counts = map_batches(known.select("text"), _doc_counts, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    df, n = np.zeros(DIM), 0
    for r in counts.collect():                               # DIM + 1 rows
        if r["gram"] < 0:
            n = r["n"]
        else:
            df[r["gram"]] = r["n"]
    if not n:
        return Model([], np.zeros((0, DIM), np.float32), np.zeros(0, int), np.zeros(0), np.ones(DIM, np.float32))
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    # sample: first by hash; a threshold on the hash keeps all but a few rows out of the shuffle
    rank = F.abs(F.xxhash64("doc_id", F.lit(1)) / F.lit(float(1 << 63)))
    sizes = known.groupBy("lang").count().withColumn("top", F.least(F.lit(1.0), 2.0 * sample / F.col("count")))
    few = known.withColumn("rank", rank).join(F.broadcast(sizes.select("lang", "top")), "lang").filter("rank <= top")
    few = few.withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy("rank", "doc_id", "text"))) \
        .filter(F.col("_r") <= sample)
    rows = few.select("lang", "rank", "text").groupBy("lang") \
        .applyInPandas(lambda pdf: _fit_language(pdf, idf), "lang string, centroids binary, floor double").collect()
    rows.sort(key=lambda r: r["lang"])                       # one row a language
    parts = [np.frombuffer(r["centroids"], "<f4").reshape(-1, DIM) for r in rows]
    return Model([r["lang"] for r in rows], np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts]),
                 np.array([r["floor"] for r in rows]), idf)


def _judge(col: pa.Array, m: Model):
    """(languages, scores, rejected) of each slice of a text column."""
    for lo, hi, offsets, data in X.slices(col):
        letter = has_letter(offsets, data)
        lang, score, out = [UNKNOWN] * (hi - lo), np.zeros(hi - lo), ~letter
        for at in range(0, hi - lo if m.langs else 0, 128):          # 4 MB of vectors at once
            end = min(at + 128, hi - lo)
            sim = vectors(offsets[at:end + 1] - offsets[at], data[offsets[at]:offsets[end]], m.idf) @ m.centroids.T
            best = sim.argmax(axis=1)
            top = np.clip(sim[np.arange(end - at), best], 0, 1)
            own = m.owner[best]
            for i in np.flatnonzero(letter[at:end]):
                lang[at + i], score[at + i] = m.langs[own[i]], top[i]
                out[at + i] = top[i] < m.floors[own[i]]
        yield lang, score, out


def _predict(batches, shared):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
    for b in batches:
        at = 0
        for lang, score, out in _judge(b.column(1), shared.value):
            yield batch(schema, b.column(0).slice(at, len(lang)), lang, score, out)
            at += len(lang)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return keep_rows(docs, lambda cols: (np.concatenate([~out for _, _, out in _judge(c, shared.value)] or [[]]) for c in cols))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row's whole text.

    Null text and text without a letter: ``und``, score 0, rejected. A model that
    learned nothing predicts ``und`` for every text and rejects only those. Equal
    cosines go to the language first in order. A null doc_id is not held out.
    Repeated rows each get a row; extra columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = map_batches(src, lambda it: _predict(it, shared), "doc_id long, lang_pred string, score double, rejected boolean")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT == 2
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
