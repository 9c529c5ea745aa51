"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model is a byte n-gram model of order ``ORDER``, so it sees spelling, case and
punctuation, not only words. Trusted text is the documents labelled quality 1, but
for a fifth held out for the thresholds. Everything is counted over all of it:

* 5-gram counts of each task, summed; lower orders count distinct left neighbours;
* discounts D1, D2, D3+ of each order from its counts of counts;
* per context its total and its numbers of followers seen once, twice, more often;
* probabilities by joins: a gram with its context, and with its own suffix one order down.

A document's log probability is a sum over its bytes, and a byte's lookups (its
gram of each order, and the back-off weights of its contexts) of order 3 and more all
have the same two previous bytes. So the model is sharded by them into blocks of about
``BLOCK_ROWS`` rows, written to the shared folder; each task opens the block that it
needs there, and nothing of the model passes through the driver. More blocks are more
passes over the texts, whose partial sums are added.

Perplexity is per byte. A document is kept if it is at most the ``QUANTILE`` of the
held-out trusted documents of its language (of all, for a language without any).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from ..sources.files import open_fs, qualified
from . import text as X
from .common import batch, keep_ids, map_batches, write_table

ORDER = 5
QUANTILE = 0.99
BLOCK_ROWS = 3_000_000   # model rows of one block: 36 MB, and 96 MB of hash table in a worker
HELD_OUT = 5             # crc32(doc_id) mod 5 = 0: for thresholds, not for counts
CHUNK_TYPES = 2_000_000  # distinct grams whose counts a task holds at once
START = 2                # a byte that stands before a text's first

U = np.uint64
_GRAMS = pa.schema([("gram", pa.int64()), ("n", pa.int64())])


def grams(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram of ``ORDER`` bytes ending at each byte, document of each byte) of a slice."""
    n, docs = len(data), len(offsets) - 1
    pad = ORDER - 1
    doc = np.repeat(np.arange(docs), np.diff(offsets))
    b = np.full(n + pad * docs, START, U)
    at = np.arange(n) + pad * (doc + 1)
    b[at] = data
    g = np.zeros(n, U)
    for j in range(ORDER):
        g |= b[at - j] << U(8 * j)
    return g, doc


def _count(batches):
    held: list = []
    size = 0

    def merged():
        g, c = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        u, at = np.unique(g, return_inverse=True)
        return u, np.bincount(at, c, len(u)).astype(np.int64)

    def rows(u, c):
        for at in range(0, len(u), 100_000):
            yield batch(_GRAMS, u[at:at + 100_000].view(np.int64), c[at:at + 100_000])

    for b in batches:
        for _, _, offsets, data in X.slices(b.column(0)):
            u, c = np.unique(grams(offsets, data)[0], return_counts=True)
            held.append((u, c))
            size += len(u)
            if size >= CHUNK_TYPES:
                u, c = merged()
                if len(u) >= CHUNK_TYPES // 2:
                    yield from rows(u, c)
                    held, size = [], 0
                else:
                    held, size = [(u, c)], len(u)
    if held:
        yield from rows(*merged())


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Chen and Goodman's D1, D2, D3+; where a count of counts is 0, i - 1/2."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    own = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.5, 3 - 4 * y * n4 / n3 if n3 else 2.5]
    return tuple(float(min(max(d, 0.05), i + 1 - 0.05)) for i, d in enumerate(own))


def model(trusted: DataFrame) -> DataFrame:
    """(order, gram, logp, loggap): every seen gram of each order with its log
    probability, and every context with its log back-off weight (a row of its
    gram; one of the two is null). ``trusted`` has a column text."""
    spark = trusted.sparkSession
    top = map_batches(trusted.select("text"), _count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    tables = {ORDER: write_table(top, "grams")}
    for k in range(ORDER - 1, 0, -1):                    # distinct left neighbours of each suffix
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
        tables[k] = write_table(tables[k + 1].groupBy(suffix.alias("gram")).agg(F.count("*").alias("n")), "grams")
    out, below = [], spark.createDataFrame([(0, 1 / 256)], "gram long, p double")
    for k in range(1, ORDER + 1):
        t = tables[k].withColumn("context", F.shiftrightunsigned("gram", 8)) \
            .withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)))
        cc = {r["n"]: r["c"] for r in t.filter("n <= 4").groupBy("n").agg(F.count("*").alias("c")).collect()}
        d = discounts(*(cc.get(i, 0) for i in (1, 2, 3, 4)))
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        context = write_table(t.groupBy("context").agg((F.sum(cut) / F.sum("n")).alias("gap"), F.sum("n").alias("total")), "contexts")
        p = t.join(context, "context").join(below.select(F.col("gram").alias("suffix"), F.col("p").alias("lower")), "suffix")
        below = write_table(p.select("gram", ((F.col("n") - cut) / F.col("total") + F.col("gap") * F.col("lower")).alias("p")), "probs")
        out.append(below.select(F.lit(k).alias("order"), "gram", F.log("p").alias("logp"), F.lit(None).cast("double").alias("loggap")))
        out.append(context.select(F.lit(k).alias("order"), F.col("context").alias("gram"), F.lit(None).cast("double").alias("logp"),
                                  F.log("gap").alias("loggap")))
    rows = out[0]
    for o in out[1:]:
        rows = rows.unionByName(o)
    return rows


class Table:
    """Values by 64-bit key: an open-addressing hash table of NumPy arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.mask = U(size - 1)
        self.keys, self.values = np.zeros(size, U), np.zeros(size, np.float32)
        at, left = X.mix(keys) & self.mask, np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] == 0
            slot, first = np.unique(at[left[free]], return_index=True)
            put = left[free][first]
            self.keys[slot], self.values[slot] = keys[put], values[put]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + U(1)) & self.mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, NaN for keys that are not there."""
        out = np.full(len(keys), np.nan, np.float32)
        at, left = X.mix(keys) & self.mask, np.arange(len(keys))
        while len(left):
            own = self.keys[at[left]]
            hit = own == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (own != 0)]
            at[left] = (at[left] + U(1)) & self.mask
        return out


def _key(order: int, gram, kind: int):
    return gram | U((kind << 3 | order) << 48)


class Block:
    """The rows of a block: grams (kind 1) and contexts (kind 2) of all orders."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, block: int = 0, blocks: int = 1):
        self.table = Table(keys, values)
        self.own = None if blocks == 1 else block_of_pair(np.arange(1 << 16), blocks) == block

    @classmethod
    def read(cls, path: str, block: int, blocks: int) -> Block:
        """Built in a task from the block's folder of the written model."""
        fs, root = open_fs(path)
        folder = f"{root}/block={block}"
        if fs.get_file_info(folder).type == pafs.FileType.NotFound:
            return cls(np.zeros(0, U), np.zeros(0, np.float32), block, blocks)
        t = pads.dataset(folder, filesystem=fs, format="parquet").to_table(columns=["key", "val"])
        return cls(t.column("key").to_numpy().view(U), t.column("val").to_numpy(), block, blocks)

    def logs(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Log probability of each document's bytes that belong to this block."""
        g, doc = grams(offsets, data)
        if self.own is not None:
            own = self.own[(g >> U(8) & U(0xffff)).astype(np.int64)]
            g, doc = g[own], doc[own]
        logs = np.zeros(len(g))
        left = np.arange(len(g))
        for k in range(ORDER, 0, -1):
            low = g[left] & U((1 << 8 * k) - 1)
            p = self.table.get(_key(k, low, 1))
            seen = ~np.isnan(p)
            logs[left[seen]] += p[seen]
            left, low = left[~seen], low[~seen]
            if not len(left):
                break
            gap = self.table.get(_key(k, low >> U(8), 2))
            logs[left] += np.where(np.isnan(gap), 0, gap)         # an unseen context passes all on
        logs[left] += np.log(1 / 256)
        return np.bincount(doc, logs, len(offsets) - 1)


_SUMS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("lang", pa.string()), ("n_bytes", pa.int64()), ("logp", pa.float64())])


def _sums(batches, path, at, blocks):
    block = None
    for b in batches:
        if block is None:
            block = Block.read(path, at, blocks)
        for lo, hi, offsets, data in X.slices(b.column(3)):
            yield batch(_SUMS, *(b.column(i).slice(lo, hi - lo) for i in range(3)), np.diff(offsets), block.logs(offsets, data))


def block_of_pair(pair, blocks: int):
    """Block of the two previous bytes; NumPy arrays and columns alike."""
    return pair * 40503 % 65521 % blocks


def write_blocks(rows: DataFrame, limit: int = BLOCK_ROWS) -> tuple[str, int]:
    """Writes the model as (key, val) by block of about ``limit`` rows, in folders
    ``block=...`` of the shared folder; returns that path and the number of blocks.
    Only the count of rows reaches the driver. Orders 1 and 2 (66,000 rows at most)
    lie in every block, longer grams and contexts in that of their two previous bytes."""
    blocks = max(1, -(-rows.count() // limit))
    of_gram = F.col("loggap").isNull()
    pair = F.when(of_gram, F.shiftrightunsigned("gram", 8)).otherwise(F.col("gram")).bitwiseAND(F.lit(0xffff))
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    at = F.when(F.col("order") <= 2, every).otherwise(F.array(block_of_pair(pair, blocks).cast("int")))
    key = F.col("gram").bitwiseOR(F.shiftleft((F.when(of_gram, 1).otherwise(2) * 8 + F.col("order")).cast("long"), 48))
    flat = rows.select(key.alias("key"), F.coalesce("logp", "loggap").cast("float").alias("val"), F.explode(at).alias("block"))
    path = shared_path(rows.sparkSession, "blocks")
    flat.repartition(blocks, "block").write.partitionBy("block").parquet(path)
    return qualified(rows.sparkSession, path), blocks


def log_probabilities(docs: DataFrame, rows: DataFrame, limit: int = BLOCK_ROWS) -> DataFrame:
    """(row, doc_id, lang, n_bytes, logp) of each row of ``docs`` under a model."""
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                      F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    path, blocks = write_blocks(rows, limit)
    out = None
    for at in range(blocks):
        part = map_batches(src, lambda it, at=at: _sums(it, path, at, blocks), "row long, doc_id long, lang string, n_bytes long, logp double")
        out = part if out is None else out.unionByName(part)
    if blocks > 1:
        out = out.groupBy("row", "doc_id", "lang", "n_bytes").agg(F.sum("logp").alias("logp"))
    return out


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, lang, n_bytes, perplexity, threshold, keep) of every row.

    Null and empty texts: perplexity null, not kept. A null lang is a language of its
    own. Repeated labels count as trusted if any is. Without trusted text every byte
    has probability 1/256, and without held-out trusted text nothing is rejected.
    Rows with a null or repeated doc_id stay; extra columns are left out.
    """
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    trusted = texts.filter("doc_id is not null").filter(part != 0)
    learn = good.filter(part != 0)

    rows = write_table(model(keep_ids(trusted, learn, "doc_id")), "model")
    scored = log_probabilities(docs, rows)
    scored = scored.withColumn("perplexity", F.when(F.col("n_bytes") > 0, F.exp(-F.col("logp") / F.col("n_bytes"))))
    scored = write_table(scored.select("doc_id", "lang", "n_bytes", "perplexity"), "perplexity")
    held = scored.filter(part == 0).join(good, "doc_id", "left_semi").filter("perplexity is not null")
    at = F.percentile_approx("perplexity", quantile, 10000)
    by_lang = held.groupBy("lang").agg(at.alias("own"))
    anywhere = held.agg(at).first()[0]                       # one number
    out = scored.join(by_lang, scored["lang"].eqNullSafe(by_lang["lang"]), "left").drop(by_lang["lang"])
    threshold = F.coalesce(F.col("own"), F.lit(anywhere).cast("double"))
    return out.select("doc_id", "lang", "n_bytes", "perplexity", threshold.alias("threshold"),
                      F.coalesce(F.col("perplexity") <= F.coalesce(threshold, F.lit(float("inf"))), F.lit(False)).alias("keep"))
