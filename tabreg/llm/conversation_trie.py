"""Conversation prefix trie by whole-sequence collapse.

Conversations are rebuilt: the first h turns of the head of their family (``c - c %
FAMILY``), then their own turns after the first h, h = crc32(c) % 4. A node is a
distinct sequence of the first d rebuilt turns; its members are the conversations
that start with it.

1. Every turn becomes a 128-bit hash of (place, role, text); the running exclusive-or
   over a conversation names each of its prefixes (with the depth).
2. Identical conversations collapse into one weighted sequence, which stands for them
   under its smallest conv_id; their ids go to the end lists.
3. Sequences that are proper prefixes of another are dropped by an anti-join; the
   others are the leaves.
4. Only the distinct sequences are expanded to prefixes and aggregated by node. A
   subtree's sum is a sum over sequences: weight times the words from a depth on, less
   each node's words once, which the sequence with the node's smallest id accounts for
   (it owns the node, and then all deeper ones on its way).

Hot prefixes (the root, a common first turn) are combined on the map side. No step
goes level by level, and nothing is collected. An end list is kept as blocks of at
most ``BLOCK`` consecutive ids (twice that around 0), so no row grows with a hot
sequence; a digest reads the blocks in order as a stream.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, few_rows, map_batches, write_table

FAMILY = 20
HEADS = 4                 # h is 0 to 3
BLOCK = 2000              # ids of one stretch of an end list
FEW_NODES = 300_000       # nodes shared by several sequences, broadcast
WORD = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "p1", "p2"]


class Trie(NamedTuple):
    nodes: DataFrame      # depth, p1, p2 (the node), conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    ends: DataFrame       # depth, p1, p2, block, ids: conversations that end at the node, by id


def _head(conv_id):
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, q1, q2, words, more): every prefix of every rebuilt
    conversation, the empty one included; (q1, q2) names the prefix one turn
    shorter, ``words`` counts the last turn's words, ``more`` tells a proper prefix."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role, text).filter("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    own = turns.select("conv_id", F.row_number().over(order).cast("long").alias("i"), F.xxhash64("role", "text").alias("a"),
                       F.xxhash64(F.lit(1), "role", "text").alias("b"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    own = write_table(own, "turns")
    ids = own.filter("i = 1").select("conv_id", _head(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    first = own.filter(F.col("i") < HEADS).withColumnRenamed("conv_id", "base")
    zero = F.lit(0).cast("long")
    root = ids.select("conv_id", F.lit(0).alias("src"), zero.alias("i"), zero.alias("a"), zero.alias("b"), zero.alias("words"))
    lent = ids.filter("h > 0").join(first, "base").filter("i <= h").select("conv_id", F.lit(1).alias("src"), "i", "a", "b", "words")
    kept = own.filter(F.col("i") > _head(F.col("conv_id"))).select("conv_id", F.lit(2).alias("src"), "i", "a", "b", "words")
    way = Window.partitionBy("conv_id").orderBy("src", "i")
    seq = root.unionByName(lent).unionByName(kept).withColumn("depth", (F.row_number().over(way) - 1).cast("long"))
    seq = seq.withColumns({"g1": F.when(F.col("src") > 0, F.xxhash64("depth", "a", "b")).otherwise(0),
                           "g2": F.when(F.col("src") > 0, F.xxhash64("b", "a", "depth")).otherwise(0)})
    run = way.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seq = seq.withColumns({"p1": F.bit_xor("g1").over(run), "p2": F.bit_xor("g2").over(run)})
    seq = seq.withColumns({"q1": F.lag("p1").over(way), "q2": F.lag("p2").over(way), "more": F.lead("p1").over(way).isNotNull()})
    return seq.select("conv_id", *NODE, "q1", "q2", "words", "more")


def build(conversations: DataFrame) -> Trie:
    """The trie of ``conversations`` (conv_id, turn, role, text).

    Turns are ordered by turn (null first), ties by role, then text; null role or text
    is empty, and equal rows are turns of their own. Rows without a conv_id belong to
    no conversation. Extra columns are ignored. An empty table has no node at all.
    """
    seq = write_table(rebuilt(conversations), "prefixes")
    whole = seq.groupBy("conv_id").agg(F.max(F.struct(*NODE)).alias("s")).select("conv_id", "s.*")
    whole = write_table(whole, "wholes")
    proper = seq.filter("more").select(*NODE).distinct()
    weighted = whole.groupBy(*NODE).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    leaves = write_table(weighted.join(proper, NODE, "left_anti").select("conv_id"), "leaves")
    weighted = weighted.join(leaves.withColumn("leaf", F.lit(1)), "conv_id", "left") \
        .select("conv_id", "n", F.coalesce("leaf", F.lit(0)).alias("leaf"))
    weighted = write_table(weighted, "sequences")

    rows = write_table(seq.join(weighted, "conv_id").drop("more"), "expanded")
    shared = rows.groupBy(*NODE).agg(F.min("conv_id").alias("first"), F.count("*").alias("c")).filter("c > 1").drop("c")
    shared = write_table(shared, "shared")
    rows = rows.join(F.broadcast(shared) if few_rows(shared, FEW_NODES) else shared, NODE, "left") \
        .withColumn("first", F.coalesce("first", "conv_id"))
    up = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    gain = F.col("n") * F.col("words") - F.when(F.col("first") == F.col("conv_id"), F.col("words")).otherwise(0)
    rows = rows.withColumns({"gain": F.sum(gain).over(up.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                             "parent": F.lead("first").over(up)})
    nodes = rows.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.min("parent").alias("parent_conv_id"), F.sum("n").alias("n_convs"),
                                    F.sum("leaf").alias("n_leaves"), F.sum("gain").alias("saved_tokens"),
                                    F.max("q1").alias("q1"), F.max("q2").alias("q2"))
    nodes = write_table(nodes, "nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")) \
        .agg(F.count("*").alias("n_children"))
    nodes = nodes.drop("q1", "q2").join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    ends = whole.groupBy(*NODE, F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    return Trie(nodes, ends)


_DIGESTS = pa.schema([("depth", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("ends_sha256", pa.string())])


def _digest(batches):
    """One SHA-256 for each run of rows of one node, over its blocks as they stream by."""
    node, sha, out = None, None, []
    for b in batches:
        for *key, ids in zip(*(b.column(i).to_pylist() for i in range(4))):
            if key != node:
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                node, sha = key, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        if len(out) >= 10_000:
            yield batch(_DIGESTS, *zip(*out))
            out = []
    if node is not None:
        out.append((*node, sha.hexdigest()))
        yield batch(_DIGESTS, *zip(*out))


def end_digests(trie: Trie) -> DataFrame:
    """(depth, p1, p2, ends_sha256): SHA-256 of each node's end list, comma-joined."""
    rows = trie.ends.select(*NODE, "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    rows = rows.repartition(*NODE).sortWithinPartitions(*NODE, "block").select(*NODE, "ids")
    return map_batches(rows, _digest, "depth long, p1 long, p2 long, ends_sha256 string")
