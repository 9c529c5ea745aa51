"""End-to-end regression runs, composed from the operators.

``rust_flavour``: standard scaling of the features (sample std), target
unscaled, first 80% of rows (source order) for training, positional batches
of ceil(n/10), one epoch of plain SGD at lr 0.01 -- the reference binary's
defaults. ``python_flavour``: features and target scaled with the population
std, 80/20 positional split, seeded 20% validation split, shuffled batches of
max(16, ceil(n/10)), SGD/Adam with reduce-on-plateau and early stopping --
the reference trainer's defaults.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import rows as R
from ..operators import scale as S
from ..operators import train as T
from ..operators.model import MLP
from ..session import shared_path
from . import housing as H


@dataclass
class Prepared:
    train: DataFrame      # x, y, key, batch
    test: DataFrame       # x, y, key
    n_train: int
    n_test: int
    feature_model: object
    target_model: object
    block: int = 0        # rows per position block (partition directory)
    batch_size: int = 0


POS_BLOCK_MIN = 1 << 20
POS_BLOCKS_MAX = 4096
ROWS_PER_WRITE_TASK = 4_000_000
# Up to this many rows are kept for training (in memory, then on the executors' disks)
# and the table needs no layout; at most T.BLOCK_ROWS a core.
CACHE_ROWS = 200_000_000


def keeps_rows(spark: SparkSession, n: int) -> bool:
    return n <= min(CACHE_ROWS, max(20_000_000, T.BLOCK_ROWS * spark.sparkContext.defaultParallelism))


def batch_predicate(k: int, bs: int, block: int):
    """Rows of positional mini-batch k: a position range plus the matching
    block range, so the Parquet scan prunes to the batch's directories."""
    lo, hi = k * bs, (k + 1) * bs
    return ((F.col("key") >= lo) & (F.col("key") < hi)
            & (F.col("pos_block") >= lo // block) & (F.col("pos_block") <= (hi - 1) // block))


def prepare(spark: SparkSession, sf_dir: str, *, ddof: int = 1, scale_target: bool = False,
            train_frac: float = 0.8, batch_size: int | None = None, flavour: str = "rust",
            synthetic: bool = False) -> Prepared:
    """The feature table with source positions (joins run once per
    application, written to the shared checkpoint folder; above what ``keeps_rows``
    allows re-laid out by position blocks); then ONE aggregate over it fits the
    scaler(s), counts rows and checks the positions; scaling is a projection
    at read time; the 80/20 split is a predicate on the position and batches
    are ``floor(position / size)``."""
    # Position blocks: at most ~4096 of them, at least 1M rows each.
    est = H.table_rows(spark, sf_dir, "lineitem")            # Parquet footer counts
    block = max(POS_BLOCK_MIN, -(-est // POS_BLOCKS_MAX))
    par = spark.sparkContext.defaultParallelism
    parts = max(par * 10, -(-est // ROWS_PER_WRITE_TASK))   # a batch spans >= par files
    table = H.housing_table(spark, sf_dir, position=True)   # the joins, run once per application
    if not keeps_rows(spark, int(train_frac * est)):
        # training will read batches straight from the files: lay them out by
        # position (range-partitioned, so each task writes one or two blocks
        # and a mini-batch reads only its blocks' files)
        path = shared_path(spark, "prepared")
        (table.withColumn("pos_block", F.floor(F.col("row_pos") / F.lit(block)).cast("long"))
              .repartitionByRange(parts, "row_pos")
              .write.mode("overwrite").partitionBy("pos_block").parquet(path))
        base = spark.read.parquet(path)
    else:
        # kept for training: read the feature table as is
        base = table.withColumn("pos_block", F.floor(F.col("row_pos") / F.lit(block)).cast("long"))
    scalers = [S.StandardScaler(H.FEATURES, ddof)]
    if scale_target:
        scalers.append(S.StandardScaler([H.TARGET], ddof))
    exprs = [e for sc in scalers for e in sc.fit_exprs()]
    row = base.agg(*exprs, F.count(F.lit(1)).alias("_n"), F.min("row_pos").alias("_lo"),
                   F.max("row_pos").alias("_hi")).first()
    models = [sc.model_from_row(row) for sc in scalers]
    fm = models[0]
    tm = models[1] if scale_target else None
    n = int(row["_n"])
    sel = [fm.expr(c).alias(c) for c in H.FEATURES]
    sel.append(tm.expr(H.TARGET).alias(H.TARGET) if tm else F.col(H.TARGET))
    scaled = base.select(*sel, "row_pos", "pos_block")
    target = H.TARGET
    if synthetic:
        scaled = H.synthetic_target(scaled, "y_syn")
        target = "y_syn"
    k = int(train_frac * n)
    if n == 0 or (row["_lo"] == 0 and row["_hi"] == n - 1):
        data, pos = scaled, "row_pos"
    else:   # rows were lost in the joins: re-rank the surviving positions
        data, pos = R.row_index(scaled, "row_pos", "_rank", n=n), "_rank"
    bs = batch_size or R.default_batch_size(k, flavour)
    table = T.prepare_table(data, H.FEATURES, target, key=pos, extra=["pos_block"])
    train = (table.where((F.col("key") < k) & (F.col("pos_block") <= (k - 1) // block))
                  .withColumn("batch", F.floor(F.col("key") / F.lit(bs)).cast("int")))
    test = table.where((F.col("key") >= k) & (F.col("pos_block") >= k // block))
    return Prepared(train.select("x", "y", "key", "batch", "pos_block"), test.select("x", "y", "key"),
                    k, n - k, fm, tm, block, bs)


def rust_flavour(spark: SparkSession, sf_dir: str, *, epochs: int = C.RUST_EPOCHS, lr: float = C.RUST_LR,
                 batch_size: int | None = None, seed: int = 42, synthetic: bool = False,
                 init: str = "xavier_normal"):
    p = prepare(spark, sf_dir, ddof=1, scale_target=False, batch_size=batch_size,
                flavour="rust", synthetic=synthetic)
    model = MLP.create(C.NETWORK_SIZES, "relu", init, seed)
    bs = batch_size or R.default_batch_size(p.n_train, "rust")
    cfg = T.TrainConfig(epochs=epochs, lr=lr, batch_size=bs, patience=None, plateau=False,
                        shuffle=False, seed=seed, name="rust")
    # Training sets are packed once and kept (a step is then one small job);
    # beyond that they are not: a batch is a position range read
    # straight from the block-partitioned table, so each step scans only its
    # own files instead of the whole cache.
    big = not keeps_rows(spark, p.n_train)
    (res,) = T.fit(p.train, [model], [cfg], n_train=p.n_train, cache=not big,
                   batch_filter=lambda k: batch_predicate(k, bs, p.block))
    return p, res


def python_setup(spark: SparkSession, sf_dir: str, *, val_split: float = 0.2, seed: int = 42,
                 synthetic: bool = False, batch_size: int | None = None):
    """Scaled table, positional test split, seeded validation split; returns
    (prepared, train_rows, val_rows, batch size, n_tr)."""
    p = prepare(spark, sf_dir, ddof=0, scale_target=True, flavour="python", synthetic=synthetic)
    n_val = max(1, int(p.n_train * val_split))
    n_tr = p.n_train - n_val
    bs = batch_size or max(16, math.ceil(n_tr / 10))
    # a row's place in the seeded permutation tells its part and its position there
    labelled = R.permuted_split(p.train, "key", p.n_train, val_split, seed).drop("key")
    tr = labelled.where(F.col("split") == "train").select("x", "y", F.col("rank").alias("key"))
    va = labelled.where(F.col("split") == "val").select("x", "y", F.floor(F.col("rank") / F.lit(bs)).cast("int").alias("vbatch"))
    return p, tr, va, bs, n_tr


def python_flavour(spark: SparkSession, sf_dir: str, *, epochs: int = C.PYTHON_EPOCHS,
                   lr: float = C.PYTHON_LR, val_split: float = C.VAL_FRACTION,
                   patience: int = C.PYTHON_PATIENCE, min_delta: float = C.PYTHON_MIN_DELTA,
                   optimizer: str = "sgd", seed: int = 42, synthetic: bool = False, checkpoint=None):
    """The Python trainer's run; with a ``recovery.Checkpoint`` it can be stopped and called again."""
    p, tr, va, bs, n_tr = python_setup(spark, sf_dir, val_split=val_split, seed=seed, synthetic=synthetic)
    model = MLP.create((8, 64, 32, 1), "relu", "xavier_normal", seed)
    cfg = T.TrainConfig(epochs=epochs, lr=lr, batch_size=bs, patience=patience, min_delta=min_delta,
                        optimizer=optimizer, shuffle=True, seed=seed, name="python")
    (res,) = T.fit(tr, [model], [cfg], val=va, n_train=n_tr, cache=keeps_rows(spark, n_tr), checkpoint=checkpoint)
    return p, res


def grid_search(spark: SparkSession, sf_dir: str, grid=None, *, seed: int = 42,
                optimizer: str = "sgd", synthetic: bool = False) -> DataFrame:
    """All configurations trained together (every step serves all), then one
    scoring scan of the test split; one metrics row per config. ``grid`` has
    (epochs, lr, patience, description) rows."""
    grid = grid or C.REFERENCE_GRID
    p, tr, va, bs, n_tr = python_setup(spark, sf_dir, seed=seed, synthetic=synthetic)
    models = [MLP.create((8, 64, 32, 1), "relu", "xavier_normal", seed) for _ in grid]
    cfgs = [T.TrainConfig(epochs=e, lr=lr, patience=pt, batch_size=bs, optimizer=optimizer,
                          shuffle=True, seed=seed, name=label) for e, lr, pt, label in grid]
    results = T.fit(tr, models, cfgs, val=va, n_train=n_tr, cache=keeps_rows(spark, n_tr))
    ev = T.evaluate_models(p.test, [r.model for r in results])
    info = spark.createDataFrame(
        [(i, r.config.name, r.config.epochs, r.config.lr, r.config.patience, len(r.history),
          r.best_epoch) for i, r in enumerate(results)],
        "cfg int, description string, epochs int, lr double, patience int, epochs_run int, best_epoch int")
    return info.join(ev, "cfg")


def process_and_save(spark: SparkSession, raw_csv: str, processed_csv: str, features, target: str, *,
                     scaler: str = "standard", ddof: int = 1, scale_target: bool = False):
    """Read a headed raw CSV, scale (one fit aggregate, one select) and write
    the processed CSV (features then target) **in source row order**: row
    order is part of the model (the later split is positional), and Spark
    packs input files into partitions by size, so the rows carry their source
    position and are range-partitioned and sorted on it before the write
    (file order = source order). Returns the fitted models."""
    from ..sources import io as IO
    raw = IO.read_header_csv(spark, raw_csv, ", ".join(f"{c} double" for c in list(features) + [target]))
    # the fit needs no order: only the written rows are ranged and sorted
    out, fm, tm = S.preprocess(R.in_source_order(raw), features, target, scaler=scaler, ddof=ddof,
                               scale_target=scale_target, fit_on=raw)
    IO.write_csv(out, processed_csv)
    return fm, tm


def load_processed_split(spark: SparkSession, processed_csv: str, features, target: str,
                         train_frac: float = 0.8) -> DataFrame:
    """The binary's loader: the processed CSV in file order, first eight
    columns features, the ninth the target, the first floor(0.8 n) rows
    'train' and the rest 'test' -- positions from file metadata, the split a
    predicate (no shuffle of the data)."""
    from ..sources import io as IO
    df = IO.read_header_csv(spark, processed_csv, ", ".join(f"{c} double" for c in list(features) + [target]))
    pos = R.with_source_position(df, "row_pos")
    n = df.count()
    k = int(train_frac * n)
    return pos.withColumn("split", F.when(F.col("row_pos") < k, F.lit("train")).otherwise(F.lit("test")))
