"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words, and the first four, five and six bytes of
its words (inflected forms of one stem meet there), hashed to ``BUCKETS``.
The score is the sigmoid of

    w0 + sum_i w_i + sum_{i<j} <v_i, v_j>

over the terms of the text: the pair part learns that two terms together mean
more, or less, than their sum. Weights are learned by FTRL-proximal with an L1
penalty, so most are exactly zero, and only terms with a weight have a factor:
a long text does not gather noise.

The model is fitted on at most ``SAMPLE`` labelled rows of each class, the first
by the hash of doc_id among the rows that may be learned from; w0 is then moved
part of the way to the class shares of all of those rows. Scoring is one narrow pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as X
from .common import batch, keep_rows, map_batches

BUCKETS = 1 << 18
FACTORS = 4
SAMPLE = 4000            # labelled rows of each class that the model is fitted on, at most
EPOCHS = 4
PREFIXES = (4, 5, 6)
L1, L2, ALPHA, BETA = 8.0, 1.0, 0.2, 1.0
PRIOR = 0.5              # part of the way from the sample's class shares to all rows' that w0 moves
RATE_V, L2_V = 0.02, 1e-3
HELD_OUT = 5             # crc32(doc_id) mod 5 = 0 is held out

U = np.uint64
_SEP = X.separators(X.NOT_ALNUM)


def terms(w: X.Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every word and word beginning of a slice; not distinct."""
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    out, docs = [w.hash], [doc]
    for p in PREFIXES:
        long = np.flatnonzero(w.end - w.begin > p)
        out.append(X.mix(w.heads(p)[long] + U(p)))
        docs.append(doc[long])
    return np.concatenate(docs), (np.concatenate(out) >> U(64 - 18)).astype(np.int64)


def _features(batches):
    schema = pa.schema([("toxic", pa.int32()), ("terms", pa.binary())])
    for b in batches:
        y = b.column(1).to_pylist()
        for lo, hi, offsets, data in X.slices(b.column(0)):
            doc, bucket = terms(X.Words(data, offsets, _SEP))
            pair = np.unique(doc * BUCKETS + bucket)
            cut = np.searchsorted(pair, np.arange(hi - lo + 1) * BUCKETS)
            rows = [(pair[cut[i]:cut[i + 1]] % BUCKETS).astype("<i4").tobytes() for i in range(hi - lo)]
            yield batch(schema, y[lo:hi], rows)


class Model:
    """w0, w, v of the machine; v is zero wherever w is."""

    def __init__(self, w0: float = 0.0, w=None, v=None):
        self.w0 = w0
        self.w = np.zeros(BUCKETS) if w is None else w
        self.v = np.zeros((BUCKETS, FACTORS)) if v is None else v

    def scores(self, n: int, doc: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Of n documents, from (document, bucket) rows that need not be distinct."""
        known = self.w[bucket] != 0
        pair = np.unique(doc[known] * BUCKETS + bucket[known])
        d, i = pair // BUCKETS, pair % BUCKETS
        z = self.w0 + np.bincount(d, self.w[i], minlength=n)
        for f in range(FACTORS):
            v = self.v[i, f]
            z += 0.5 * (np.bincount(d, v, minlength=n) ** 2 - np.bincount(d, v * v, minlength=n))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(rows: list[tuple[int, np.ndarray]], share: float) -> Model:
    """``rows``: (label, distinct buckets); ``share``: of label 1 among all rows
    that may be learned from. One class only: its share is every score."""
    model = Model()
    odds = lambda p: np.log(max(p, 1e-9) / max(1 - p, 1e-9))
    seen = np.mean([y for y, _ in rows]) if rows else 0.0
    if not 0 < seen < 1:
        model.w0 = float(np.clip(odds(share), -20, 20)) if rows else -20.0
        return model
    rng = np.random.RandomState(7)
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    w, v = model.w, model.v
    gv = np.zeros((BUCKETS, FACTORS))
    start = rng.normal(0, 0.02, (BUCKETS, FACTORS))
    w0, n0 = 0.0, 1.0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            y, i = rows[k]
            zi = z[i]
            wi = np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))
            w[i] = wi
            on = i[wi != 0]
            fresh = on[~v[on].any(axis=1)]
            v[fresh] = start[fresh]
            vo = v[on]
            total = vo.sum(axis=0)
            s = w0 + wi.sum() + 0.5 * float((total * total - (vo * vo).sum(axis=0)).sum())
            g = 1 / (1 + np.exp(-np.clip(s, -60, 60))) - y
            n0 += g * g
            w0 -= 0.1 * g / np.sqrt(n0)
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * wi
            n[i] += g * g
            if len(on):
                grad = g * (total - vo) + L2_V * vo
                gv[on] += grad * grad
                v[on] = vo - RATE_V * grad / np.sqrt(1e-4 + gv[on])
    v[w == 0] = 0
    model.w0 = w0 + float(np.clip(odds(share) - odds(seen), -3, 3)) * PRIOR
    return model


def _scores(col: pa.Array, m: Model):
    """Scores of each slice of a text column."""
    for lo, hi, offsets, data in X.slices(col):
        yield m.scores(hi - lo, *terms(X.Words(data, offsets, _SEP)))


def _score(batches, model):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    m = Model(*model.value)
    for b in batches:
        at = 0
        for s in _scores(b.column(1), m):
            yield batch(schema, b.column(0).slice(at, len(s)), s)
            at += len(s)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are predicted not toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast((model.w0, model.w, model.v))

    def masks(cols):
        m = Model(*shared.value)
        for c in cols:
            yield np.concatenate([s < 0.5 for s in _scores(c, m)] or [[]])
    return keep_rows(docs, masks)


def held_out(key: str, mod: int):
    return F.crc32(F.col(key).cast("string").cast("binary")) % mod


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the labelled documents that are not held out."""
    known = labels.filter("doc_id is not null and toxic is not null") \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")) \
        .filter(held_out("doc_id", HELD_OUT) != 0)
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi").cache()
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    picked = None
    for y in sizes:
        part = known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    if picked is None:
        return fit([], 0.0)
    # one text for each id, however many rows repeat it: the sample bounds what is collected
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))     # 2 * sample ids
    rows = map_batches(texts.select("text", "toxic"),
                       _features, "toxic int, terms binary").collect()
    known.unpersist()
    rows = sorted((r["toxic"], bytes(r["terms"])) for r in rows)
    return fit([(1 if y > 0 else 0, np.frombuffer(t, "<i4")) for y, t in rows],
               sum(c for y, c in sizes.items() if y > 0) / max(1, sum(sizes.values())))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row's whole text.

    Null, empty and wordless texts have the score of no terms, sigmoid(w0). A null
    doc_id is not held out. Repeated rows each get a row; extra columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.w0, model.w, model.v))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = map_batches(src, lambda it: _score(it, shared), "doc_id long, score double")
    return out.select("doc_id", F.coalesce(held_out("doc_id", HELD_OUT) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
