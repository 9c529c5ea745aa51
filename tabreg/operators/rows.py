"""Row position on an unordered engine: exact indices, splits, batches.

A DataFrame has no row order, so every positional operator names its order:
either the source-file order of a Parquet/CSV scan (``with_source_position``)
or a sort key (``row_index``; nulls last, ties in any order). Neither plans an
unpartitioned window (``Exchange SinglePartition``) over data-sized input.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .. import constants as C
from ..session import shared_path, ship_package
from .select import select_ranks

# Offsets tables (one row per bucket, file or split: a path string and two
# longs, ~150 bytes) up to this many rows (~300 MB) are broadcast; a 100 TB
# input of 128 MB files has ~800k files. Beyond it the join shuffles.
BROADCAST_ROWS = 2_000_000
ROWS_PER_BUCKET = 1_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_source_position(scan: DataFrame, name: str = "row_pos", *, written: bool = False) -> DataFrame:
    """0-based position of each row in source-file order (file path, then
    place in the file). ``written``: the files are one Spark write, ordered by
    the number of their partition (from 100,000 on, names no longer sort so).

    ``scan`` must be a plain file scan (``spark.read.parquet/csv``), before
    any shuffle. Parquet exposes the row's index in its file
    (``_metadata.row_index``). Other formats are positioned by split: the
    split's byte offset (``_metadata.file_block_start``) orders splits inside
    a file, and the row counter of ``monotonically_increasing_id`` (one
    counter per task, deterministic for a fixed scan) orders rows inside a
    split. Either way one small aggregate (one row per file or split) gives
    prefix offsets, joined back broadcast when provably small. No window over
    the data and no shuffle of the data.
    """
    meta_fields = scan.select("_metadata").schema.fields[0].dataType.names
    if "row_index" in meta_fields:
        meta = scan.select("*", F.col("_metadata.file_path").alias("_fp"), F.lit(0).cast("long").alias("_fb"),
                           F.col("_metadata.row_index").alias("_r"))
        unit = meta.groupBy("_fp", "_fb").agg(F.count("*").alias("_n"), F.lit(0).cast("long").alias("_r0"))
    else:
        meta = scan.select("*", F.col("_metadata.file_path").alias("_fp"),
                           F.col("_metadata.file_block_start").alias("_fb"),
                           F.monotonically_increasing_id().alias("_r"))
        unit = meta.groupBy("_fp", "_fb").agg(F.count("*").alias("_n"), F.min("_r").alias("_r0"))
    # one row per file (Parquet) or split (others): bounded by the input layout
    part = F.regexp_extract("_fp", r"part-(\d+)", 1) if written else F.lit("")
    w = Window.orderBy(F.length(part), part, "_fp", "_fb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = unit.select("_fp", "_fb", "_r0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    if "row_index" in meta_fields and not written:
        few = len(scan.inputFiles()) <= BROADCAST_ROWS
    else:                       # computed once, and counted: a row for each split, not file
        path = shared_path(scan.sparkSession, "offsets")
        offsets.write.parquet(path)
        offsets = scan.sparkSession.read.schema(offsets.schema).parquet(path)
        few = offsets.count() <= BROADCAST_ROWS
    out = meta.join(F.broadcast(offsets) if few else offsets, ["_fp", "_fb"])
    return out.select(*scan.columns, (F.col("_off") + F.col("_r") - F.col("_r0")).cast("long").alias(name))


def in_source_order(scan: DataFrame, parts: int | None = None) -> DataFrame:
    """The rows of a file scan, range-partitioned and sorted on their source
    position (which is then dropped), so a following write produces files
    whose order is the source row order. Spark packs input files into
    partitions by size, so without this a read-write cycle reorders rows."""
    n_parts = parts or scan.rdd.getNumPartitions()
    pos = with_source_position(scan, "_src_pos")
    return pos.repartitionByRange(n_parts, "_src_pos").sortWithinPartitions("_src_pos").drop("_src_pos")


def md5_order(key, seed, *extra) -> Column:
    """md5 hex of ``seed-[extra-]key``: a seeded, repeatable pseudo-random order."""
    parts = [F.lit(str(seed))] + [F.lit(str(e)) for e in extra] + [_c(key).cast("string")]
    return F.md5(F.concat_ws("-", *parts))


def hash_ranks(df: DataFrame, h, ranks, n: int, *, max_final: int = 20_000) -> list:
    """Values of a uniform hex-hash column (md5) at 0-based ``ranks``.

    Uniformity makes a prefix histogram an exact, balanced bucketing: one
    job counts rows per leading-hex prefix (at most 16^4 groups), the driver
    locates each rank's bucket from prefix sums, and one more job collects
    only the target buckets (about n/16^d rows each). A bucket still too big
    is split again on the next digits. Typically two jobs in all."""
    hc = _c(h)
    base = df.select(hc.alias("_h"))
    out: dict = {}
    # pending: prefix -> list of (rank, rank within prefix); "" = everything
    pending = {"": [(r, r) for r in sorted(set(ranks))]}
    sizes = {"": n}
    full = 32   # md5 hex length: a prefix this long is a single value
    while pending:
        nxt: dict = {}
        # a full-length prefix is one hash value, however many rows share it
        for p in [p for p in pending if len(p) >= full]:
            for r, _ in pending.pop(p):
                out[r] = p
        small = {p: rs for p, rs in pending.items() if sizes[p] <= max_final}
        big = {p: rs for p, rs in pending.items() if p not in small}
        if small:
            cond = None
            for p in small:
                c = F.lit(True) if p == "" else F.col("_h").startswith(p)
                cond = c if cond is None else cond | c
            vals = sorted(r["_h"] for r in base.where(cond).collect())   # bounded by max_final each
            for p, rs in small.items():
                inside = [v for v in vals if v.startswith(p)]
                for r, k in rs:
                    out[r] = inside[k]
        for p, rs in big.items():
            extra = max(1, min(4, math.ceil(math.log(max(sizes[p] / 500.0, 2), 16))))
            d = min(full, len(p) + extra)
            part = base if p == "" else base.where(F.col("_h").startswith(p))
            hist = sorted((r["b"], r["c"]) for r in
                          part.groupBy(F.substring("_h", 1, d).alias("b")).agg(F.count("*").alias("c")).collect())
            acc, bounds = 0, []
            for b, c in hist:
                bounds.append((b, acc, c))
                acc += c
            for r, k in rs:
                for b, lo, c in bounds:
                    if lo <= k < lo + c:
                        nxt.setdefault(b, []).append((r, k - lo))
                        sizes[b] = c
                        break
        pending = nxt
    return [out[r] for r in ranks]


def row_index(df: DataFrame, order_by, name: str = "row_idx", *,
              n: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Exact 0-based position of each row in ascending order of a key of any
    orderable type; null keys come last, ties take any order.

    The rows are range-partitioned and sorted on (key, hash of the row's place),
    about ``rows_per_bucket`` to a partition, and written once to the shared
    folder; positions are then each file's offset plus the row's index in it.
    Equal keys differ in the second part of the sort key, so a hot value (rows
    equal in every column too) is spread over as many partitions as it needs,
    and the number of partitions grows with the rows without a bound.
    """
    spark = df.sparkSession
    if n is None:
        n = df.count()
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(n / rows_per_bucket))
    base = df.select("*", _c(order_by).alias("_k"), F.xxhash64(F.monotonically_increasing_id()).alias("_t"))
    order = [F.col("_k").asc_nulls_last(), F.col("_t")]
    placed = base.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_k", "_t")
    path = shared_path(spark, "positions")
    placed.write.parquet(path)
    return with_source_position(spark.read.schema(placed.schema).parquet(path), name, written=True)


def _label_first(df: DataFrame, key: Column, thr, k: int, first: str, rest: str, name: str) -> DataFrame:
    """``first`` for exactly k rows: all below the threshold value, and as many
    of those equal to it (null: nulls, which come last) as are still missing.
    Without ties, or when all of them belong to the first part, the label is a
    predicate; else only the tied rows are ranked, by a hash of the row."""
    if thr is None:
        below, same = key.isNotNull(), key.isNull()
    else:
        below, same = F.coalesce(key < F.lit(thr), F.lit(False)), F.coalesce(key == F.lit(thr), F.lit(False))
    c = df.agg(F.count_if(below).alias("below"), F.count_if(same).alias("same")).first()
    quota = k - c["below"]
    if quota == c["same"]:
        return df.withColumn(name, F.when(below | same, F.lit(first)).otherwise(F.lit(rest)))
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    tied = row_index(df.where(same), F.xxhash64(*plain), "_tie", n=c["same"])
    tied = tied.withColumn(name, F.when(F.col("_tie") < quota, F.lit(first)).otherwise(F.lit(rest))).drop("_tie")
    others = df.where(~same).withColumn(name, F.when(below, F.lit(first)).otherwise(F.lit(rest)))
    return others.unionByName(tied)


def split_at_rank(df: DataFrame, order_by, k: int, *, n: int | None = None,
                  proxy=None, first: str = "train", rest: str = "test",
                  name: str = "split") -> DataFrame:
    """Label the first ``k`` rows (in ``order_by`` order, nulls last) ``first``,
    the rest ``rest``; exactly k rows, ties in any order. For a numeric key the
    k-th value is found by exact rank selection and the split is a predicate
    (ties at that value apart), with no shuffle of the data; other keys are
    ranked by ``row_index``."""
    key = _c(order_by)
    if n is None:
        n = df.count()
    if k <= 0:
        return df.withColumn(name, F.lit(rest))
    if k >= n:
        return df.withColumn(name, F.lit(first))
    kind = df.select(key.alias("_k")).schema[0].dataType
    if proxy is None and not isinstance(kind, NumericType):
        out = row_index(df, key, "_rank", n=n)
        return out.withColumn(name, F.when(F.col("_rank") < k, F.lit(first)).otherwise(F.lit(rest))).drop("_rank")
    known = df.where(key.isNotNull()).count()
    thr = None if k > known else select_ranks(df, key, [k - 1], proxy=proxy, n=known)[0]
    return _label_first(df, key, thr, k, first, rest, name)


def train_test_split(df: DataFrame, order_by, train_frac: float = C.TRAIN_FRACTION, *,
                     n: int | None = None, name: str = "split") -> DataFrame:
    """First ``floor(train_frac * n)`` rows are 'train', the rest 'test'."""
    if n is None:
        n = df.count()
    k = int(train_frac * n)
    return split_at_rank(df, order_by, k, n=n, name=name)


def random_val_split(df: DataFrame, key, val_frac: float = C.VAL_FRACTION, seed: int = 42, *,
                     n: int | None = None, name: str = "split") -> DataFrame:
    """Seeded random permutation; the first ``max(1, floor(n * v))`` rows are
    'val', the rest 'train'. Requires 0 < v < 0.5 (as the reference asserts)."""
    if not 0.0 < val_frac < 0.5:
        raise ValueError("val_frac must be in (0, 0.5)")
    if n is None:
        n = df.count()
    k = max(1, int(n * val_frac))
    if n == 0:
        return df.withColumn(name, F.lit("train"))
    h = md5_order(key, seed)
    (thr,) = hash_ranks(df, h, [k - 1], n)
    return _label_first(df, h, thr, k, "val", "train", name)


def default_batch_size(n: int, flavour: str = "rust") -> int:
    """ceil(n/10) (Rust binary), or max(16, ceil(n/10)) (Python trainer)."""
    b = max(1, math.ceil(n / C.BATCHES_PER_EPOCH))
    return max(C.MIN_BATCH_PYTHON, b) if flavour == "python" else b


def minibatch(df: DataFrame, order_by, batch_size: int | None = None, *,
              n: int | None = None, name: str = "batch", index_col: str | None = None) -> DataFrame:
    """``batch = floor(position / batch_size)``; the last batch may be short.

    ``index_col`` reuses an existing exact position column (e.g. ``row_pos``).
    """
    if n is None:
        n = df.count()
    if batch_size is None:
        batch_size = default_batch_size(n)
    if index_col is None:
        df = row_index(df, order_by, "_pos", n=n)
        pos = F.col("_pos")
    else:
        pos = F.col(index_col)
    out = df.withColumn(name, F.floor(pos / F.lit(batch_size)).cast("int"))
    return out.drop("_pos") if index_col is None else out


def epoch_shuffle(df: DataFrame, key, seed: int, epoch: int, batch_size: int, *,
                  n: int | None = None, name: str = "batch") -> DataFrame:
    """A fresh seeded permutation per epoch, cut into exact batches."""
    tmp = df.withColumn("_h", md5_order(key, seed, epoch))
    out = minibatch(tmp, "_h", batch_size, n=n, name=name)
    return out.drop("_h")


# A keyed permutation of 0 .. n-1: a Feistel network over the smallest power of two
# that holds n, applied again while the result is n or more (cycle walking). The
# halves have b // 2 and b - b // 2 bits and change sides in each round.
ROUNDS = 6
MAX_BITS = 54              # the round function gives 27 bits
WALKS = 96                 # fewer than half of all values walk on at each step
PERMUTE_ROWS = 1 << 14     # positions that stay in a core's cache from round to round


def shuffle_keys(seed: int, *more) -> list[int]:
    """The round keys of a permutation: 30 bits each, from md5 of the arguments."""
    tag = "-".join(map(str, (seed, *more)))
    return [int(hashlib.md5(f"{tag}-{i}".encode()).hexdigest()[:8], 16) >> 2 for i in range(ROUNDS)]


def _halves(n: int) -> tuple[int, int]:
    bits = max(2, (max(n, 1) - 1).bit_length())
    if bits > MAX_BITS:
        raise ValueError(f"at most 2^{MAX_BITS} rows can be permuted")
    return bits // 2, bits - bits // 2


def _round(x: np.ndarray, left: int, right: int, key: int) -> None:
    """One round, in place. The remainder of 2^31 - 1 is taken by folding: t < 2^47."""
    low = x & ((1 << right) - 1)
    t = low ^ key
    t *= 1103515245
    t += 12345
    t &= 2147483647
    t ^= t >> 15
    t *= 48271
    t += key
    high = t >> 31
    t &= 2147483647
    t += high
    np.add(t, 1, out=high)
    high >>= 31
    t += high
    t &= 2147483647
    t >>= 4
    t &= (1 << left) - 1
    x >>= right
    x ^= t
    low <<= left
    x += low


def permuted(pos, n: int, keys: list[int], *, once: bool = False) -> Column:
    """Where a keyed permutation of 0 .. n-1 puts position ``pos`` (long); null stays
    null. No shuffle, no sort: each row computes its own place, an Arrow batch at a
    time (as an SQL expression the walk is interpreted, at some 17 us a row).
    ``once``: the optimizer may not repeat it in a filter on its result."""
    _halves(n)
    ship_package(SparkSession.active())

    def place(p: pa.Array) -> pa.Array:
        known = p.is_valid().to_numpy(zero_copy_only=False)
        out = np.zeros(len(p), np.int64)
        out[known] = permute_np(p.drop_null().to_numpy(zero_copy_only=False), n, keys)
        return pa.array(out, pa.int64(), mask=~known)

    place.__annotations__ = {"p": pa.Array, "return": pa.Array}      # not as text
    udf = F.arrow_udf(place, "long")
    return (udf.asNondeterministic() if once else udf)(_c(pos).cast("long"))


def permute_np(pos: np.ndarray, n: int, keys: list[int]) -> np.ndarray:
    """``permuted`` for an array of positions, inside a task."""
    left, right = _halves(n)

    def encrypt(x):
        for at in range(0, len(x), PERMUTE_ROWS):
            a, b, part = left, right, x[at:at + PERMUTE_ROWS]
            for key in keys:
                _round(part, a, b, key)
                a, b = b, a
        return x

    out = encrypt(np.array(pos, np.int64))
    far = np.flatnonzero(out >= n)
    for _ in range(WALKS):
        if not len(far):
            break
        out[far] = x = encrypt(out[far])
        far = far[x >= n]
    if len(far):
        raise ValueError("a permutation's walk did not end")
    return out


def permuted_batch(pos, n: int, batch_size: int, seed: int, epoch: int) -> Column:
    """The mini-batch of a row in an epoch whose order is a fresh keyed permutation:
    every batch has exactly ``batch_size`` rows, the last one the rest."""
    return F.floor(permuted(pos, n, shuffle_keys(seed, "epoch", epoch)) / F.lit(batch_size)).cast("int")


def permuted_split(df: DataFrame, pos: str, n: int, val_frac: float, seed: int, *, name: str = "split",
                   rank: str = "rank") -> DataFrame:
    """A seeded random split of rows with positions 0 .. n-1, without a shuffle: the
    first ``max(1, floor(n * v))`` places of a keyed permutation are 'val'. ``rank`` is
    the place within the row's own part, from 0 and without gaps."""
    if not 0.0 < val_frac < 0.5:
        raise ValueError("val_frac must be in (0, 0.5)")
    k = max(1, int(n * val_frac))
    out = df.withColumn(rank, permuted(pos, n, shuffle_keys(seed, "split"), once=True))
    return out.withColumn(name, F.when(F.col(rank) < k, "val").otherwise("train")) \
        .withColumn(rank, F.when(F.col(rank) < k, F.col(rank)).otherwise(F.col(rank) - k))


def preview(df: DataFrame, order_by, k: int = 5) -> DataFrame:
    """First ``k`` rows in key order: a top-k (TakeOrdered), not a sort."""
    return df.orderBy(_c(order_by)).limit(k)
