"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors of one label are normalised in double precision. A table's key is the
label and ``k`` quantised Gaussian projections ``floor((a . x + b) / W)``; rows
that share a key are candidates, checked by exact cosine. For unit vectors cosine
c is the distance sqrt(2 - 2c), so the chance p1 that one projection agrees at
the threshold, and p2 at distance 1, are known. ``k`` grows with the logarithm of
the rows, so that unrelated rows share a key about once, and the number of tables
is chosen so that a pair just at the threshold is found with chance ``RECALL``.

Equal vectors of a label are one node with a multiplicity. A bucket of more than
``BLOCK`` nodes is split into blocks by a hash of the node, and every pair of its
blocks is one group of at most about 2 * BLOCK nodes, so no group is unbounded. In a
group the cosines are matrix products; a pair is counted only in the first table
where its keys agree, so link counts need no list of pairs. A group gives a link
count for each node and one edge to each node's smallest linked neighbour chain,
not all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, map_batches, write_table
from .graph import components

COSINE = 0.98
WIDTH = 0.8
RECALL = 0.995
BLOCK = 1024
SEED = 20240

_NODE = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("unit", pa.binary())])


def agree(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised projection is equal at a Euclidean distance."""
    r = width / distance
    phi = 0.5 * (1 + math.erf(-r / math.sqrt(2)))
    return 1 - 2 * phi - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(rows: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(projections in a key, tables) for so many rows of one label."""
    near, far = agree(math.sqrt(2 - 2 * cosine)), agree(1.0)
    k = max(1, math.ceil(math.log(max(rows, 2)) / math.log(1 / far)))
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near ** k)))


def projections(dim: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.RandomState(SEED + dim)
    return rng.normal(size=(dim, k * tables)), rng.uniform(0, WIDTH, k * tables)


def keys(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """(rows, tables) 64-bit keys."""
    a, b = projections(unit.shape[1], k, tables)
    q = np.floor((unit @ a + b) / WIDTH).astype(np.int64).reshape(len(unit), tables, k)
    from . import text as X
    h = np.zeros(q.shape[:2], np.uint64)
    for i in range(k):
        h = X.mix(h * np.uint64(0x9E3779B97F4A7C15) + q[:, :, i].astype(np.uint64) + np.uint64(i + 1))
    return h.view(np.int64)


def _units(batches):
    """Normalised vectors; null, zero and non-finite ones are left out."""
    for b in batches:
        ids, labels, out = b.column(0).to_pylist(), b.column(2).to_pylist(), []
        for i, label, vec in zip(ids, labels, b.column(1)):
            if not vec.is_valid or vec.values.null_count:
                continue
            x = vec.values.to_numpy(zero_copy_only=False).astype(np.float64)
            top = np.abs(x).max() if len(x) else 0.0
            if not np.isfinite(x).all() or top == 0:
                continue
            x = x / top                                      # no overflow or underflow in the norm
            out.append((i, label, (x / math.sqrt(float(x @ x))).astype("<f8").tobytes()))
        if out:
            yield batch(_NODE, *zip(*out))


_HASHED = pa.schema([("node", pa.int64()), ("label", pa.string()), ("weight", pa.int64()), ("unit", pa.binary()),
                     ("keys", pa.binary())])


def _hashed(batches, k, tables):
    """Packed keys of every table; vectors of one dimension are hashed together."""
    for b in batches:
        if not len(b):
            continue
        raw, out = b.column("unit").to_pylist(), [b""] * len(b)
        for width in {len(r) for r in raw}:
            at = [i for i, r in enumerate(raw) if len(r) == width]
            got = keys(np.frombuffer(b"".join(raw[i] for i in at), "<f8").reshape(len(at), -1), k, tables) ^ width
            for i, own in zip(at, got):
                out[i] = own.astype("<i8").tobytes()
        yield batch(_HASHED, *(b.column(c) for c in ("node", "label", "weight", "unit")), out)


_BUCKETS = pa.schema([("node", pa.int64()), ("label", pa.string()), ("t", pa.int32()), ("key", pa.int64())])


def _buckets(batches):
    """One row for each node and table."""
    for b in batches:
        if not len(b):
            continue
        own = np.frombuffer(b"".join(b.column("keys").to_pylist()), "<i8").reshape(len(b), -1)
        tables = own.shape[1]
        at = np.repeat(np.arange(len(b)), tables)
        yield batch(_BUCKETS, b.column("node").take(pa.array(at)), b.column("label").take(pa.array(at)),
                    np.tile(np.arange(tables, dtype=np.int32), len(b)), own.ravel())


def _links(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Link counts and spanning edges of one group: the pairs of one block, or
    between two blocks, of one bucket that no earlier table has."""
    t, x, y = (int(pdf[c].iloc[0]) for c in ("t", "x", "y"))
    pdf = pdf.sort_values("node")
    unit = np.frombuffer(b"".join(pdf["unit"]), "<f8").reshape(len(pdf), -1)
    own = np.frombuffer(b"".join(pdf["keys"]), "<i8").reshape(len(pdf), -1)
    node, weight, side = pdf["node"].to_numpy(), pdf["weight"].to_numpy(), pdf["block"].to_numpy()
    hit = unit @ unit.T >= cosine
    for earlier in range(t):
        hit &= own[:, None, earlier] != own[None, :, earlier]
    if x != y:
        hit &= side[:, None] != side[None, :]
    np.fill_diagonal(hit, False)
    links = hit @ weight
    # a spanning forest of the group's links: the smallest reachable node
    root = np.arange(len(node))
    while True:
        low = np.where(hit, root[None, :], len(node)).min(axis=1, initial=len(node))
        new = np.minimum(root, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    on = np.flatnonzero(links > 0)
    return pd.DataFrame({"node": node[on], "links": links[on], "root": node[root[on]]})


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row (vec_id, embedding, label).

    Links: other rows of an equal, non-null label with cosine >= ``cosine``. Null or
    zero vectors, vectors with a null or non-finite component, and rows with a null
    label or vec_id have no links; such a row is its own component and is kept.
    Vectors of different lengths do not link. Equal vectors link with each other; a
    repeated vec_id is one node for components. Extra columns are ignored.
    """
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                         F.col("label").cast("string").alias("label"))
    unit = map_batches(src.filter("label is not null and vec_id is not null"), _units, "vec_id long, label string, unit binary")
    unit = write_table(unit, "units")
    same = unit.groupBy("label", "unit").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    nodes = write_table(same, "nodes")
    rows = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    k, tables = plan(rows, cosine, recall)
    hashed = write_table(map_batches(nodes.select("node", "label", "weight", "unit"), lambda it: _hashed(it, k, tables),
                                     "node long, label string, weight long, unit binary, keys binary"), "hashed")
    bucket = ["label", "t", "key"]
    # keys alone find the shared buckets; vectors go only there
    small = write_table(map_batches(hashed.select("node", "label", "keys"), _buckets, "node long, label string, t int, key long"),
                        "buckets")
    sizes = small.groupBy(*bucket).count().filter("count > 1") \
        .withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int")).drop("count")
    grouped = small.join(sizes, bucket).join(hashed.drop("label"), "node") \
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    # a node goes to every pair of blocks that has its own
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    grouped = grouped.withColumn("_o", other).withColumn("x", F.least("block", "_o")).withColumn("y", F.greatest("block", "_o"))
    found = grouped.drop("_o", "blocks").groupBy(*bucket, "x", "y") \
        .applyInPandas(lambda pdf: _links(pdf, cosine), "node long, links long, root long")
    found = write_table(found, "links")
    comp = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    per = found.groupBy("node").agg(F.sum("links").alias("links"))
    state = same_state(nodes, per, comp)
    member = unit.join(state, ["label", "unit"]).groupBy("vec_id") \
        .agg(F.max("links").alias("links"), F.min("component").alias("component"))
    return src.select("vec_id").join(member, "vec_id", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce(F.col("component"), F.col("vec_id")) == F.col("vec_id"), F.lit(True)).alias("kept"))


def same_state(nodes: DataFrame, per: DataFrame, comp: DataFrame) -> DataFrame:
    """(label, unit, links, component) of every node, equal vectors counted in."""
    return nodes.join(per, "node", "left") \
        .join(comp.select(F.col("id").alias("node"), "component"), "node", "left") \
        .select("label", "unit", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
                F.coalesce("component", "node").alias("component"))
