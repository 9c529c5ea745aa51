"""Data-parallel mini-batch training of one or several MLPs.

Steps are sequential by nature (each uses the previous step's weights), so each
mini-batch is one Spark job: broadcast parameters -> gradient sums of each partition
-> sum -> driver update. The driver holds only parameters, optimizer state and
per-epoch scalars. Shuffled runs of up to ``TEAM_ROWS`` rows a core are stepped by a team
(``team``): tasks that keep their rows in memory for the whole run. Up to ``BLOCK_ROWS``
rows a core, the rows are packed once into
persisted NumPy blocks (memory, then local disk) and a step is a job without a plan or a
scan; beyond that, or with more than ``BLOCK_BATCHES`` batches an epoch, it is a query
over the table. All paths run the same loop
(``_loop``). Several configurations (a grid) share every step. (One barrier job with
an ``allGather`` for each step was tried: Spark answers a barrier once a second.)

Batch order: ``shuffle=False`` keeps position order (the Rust binary);
``shuffle=True`` draws a fresh keyed permutation per epoch (``rows.permuted``): a row
computes its own batch, so nothing is sorted, ranked or shuffled.
"""

from __future__ import annotations

import logging
import math
import pickle
import time
import uuid
from collections import Counter, OrderedDict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path, ship_package
from ..sources.files import open_fs

from .. import constants as C
from .matrix import _batch_matrix
from .metrics import band_expr, grade_expr, metric_exprs
from .model import DRIVER_SUM_PARTITIONS, MLP, collect_gradients, forward_np, grad_np, gradient_job, loss_function, losses_np, per_model
from . import recovery, team
from .rows import permute_np, permuted_batch, row_index, shuffle_keys

# A step sends each core its rows (80 bytes a row for eight features), one block of
# PACK_ROWS at a time: a worker never holds more. At most BLOCK_ROWS rows a core are kept
# so; fewer than the minimum do not pay for another task.
BLOCK_ROWS = 16_000_000
BLOCK_ROWS_MIN = 10_000
PACK_ROWS = 250_000
PART_ROWS = 4_000_000      # rows of one persisted partition (320 MB)
# Rows (training and validation) that a member of a team keeps, about 90 bytes each for
# eight features, and the files that its share is packed into.
TEAM_ROWS = 5_000_000
TEAM_FILES = 16
# Every step reads all blocks; with more batches than this, a batch is read by itself.
BLOCK_BATCHES = 100
# A fixed batch whose largest share in one partition is this many times the even share
# would be computed by few tasks: the rows are then dealt out evenly.
UNEVEN = 3

LOG = logging.getLogger("tabreg.train")


@dataclass(frozen=True)
class TrainConfig:
    epochs: int = C.PYTHON_EPOCHS
    lr: float = C.PYTHON_LR
    batch_size: int | None = None
    patience: int | None = C.PYTHON_PATIENCE
    min_delta: float = C.PYTHON_MIN_DELTA
    optimizer: str = "sgd"
    momentum: float = 0.0
    weight_decay: float = 0.0
    betas: tuple = C.ADAM_BETAS
    eps: float = C.ADAM_EPS
    plateau: bool = True
    plateau_factor: float = C.PLATEAU_FACTOR
    plateau_patience: int = C.PLATEAU_PATIENCE
    plateau_threshold: float = C.PLATEAU_THRESHOLD
    shuffle: bool = True
    seed: int = 42
    tie: float = 0.0
    loss: object = "mae"      # a name of model.LOSSES, or a function
    name: str = ""

    def __post_init__(self):
        if self.optimizer.lower() not in ("sgd", "adam"):
            raise ValueError(f"optimizer {self.optimizer!r} is not known: sgd or adam")


# ------------------------------------------------------ driver-side state

class Optimizer:
    """SGD (momentum, weight decay) and Adam, PyTorch update rules, on the
    flattened parameter vector."""

    def __init__(self, cfg: TrainConfig, n: int):
        self.cfg = cfg
        self.kind = cfg.optimizer.lower()
        self.t = 0
        self.m = np.zeros(n)
        self.v = np.zeros(n)
        self.buf = None

    def step(self, w: np.ndarray, g: np.ndarray, lr: float) -> np.ndarray:
        c = self.cfg
        if c.weight_decay:
            g = g + c.weight_decay * w
        if self.kind == "sgd":
            if c.momentum:
                self.buf = g.copy() if self.buf is None else c.momentum * self.buf + g
                g = self.buf
            return w - lr * g
        self.t += 1
        b1, b2 = c.betas
        self.m = b1 * self.m + (1 - b1) * g
        self.v = b2 * self.v + (1 - b2) * g * g
        mh = self.m / (1 - b1 ** self.t)
        vh = self.v / (1 - b2 ** self.t)
        return w - lr * mh / (np.sqrt(vh) + c.eps)


class Plateau:
    """Reduce-on-plateau (mode min, relative threshold): after more than
    ``patience`` epochs without a relative improvement, lr *= factor."""

    def __init__(self, lr: float, factor=C.PLATEAU_FACTOR, patience=C.PLATEAU_PATIENCE,
                 threshold=C.PLATEAU_THRESHOLD, min_lr=0.0, eps=1e-8):
        self.lr, self.factor, self.patience = lr, factor, patience
        self.threshold, self.min_lr, self.eps = threshold, min_lr, eps
        self.best = math.inf
        self.bad = 0

    def step(self, metric: float) -> float:
        if metric < self.best * (1.0 - self.threshold):
            self.best, self.bad = metric, 0
        else:
            self.bad += 1
        if self.bad > self.patience:
            new = max(self.lr * self.factor, self.min_lr)
            if self.lr - new > self.eps:
                self.lr = new
            self.bad = 0
        return self.lr


@dataclass
class TrainResult:
    config: TrainConfig
    model: MLP
    history: list = field(default_factory=list)        # dicts: epoch, loss, val_loss, learning_rate
    batch_losses: list = field(default_factory=list)   # dicts: epoch, batch, batch_loss
    best_epoch: int | None = None
    stop_epoch: int | None = None
    seconds: float = 0.0


@dataclass
class _Run:
    cfg: TrainConfig
    w: np.ndarray
    opt: Optimizer
    plateau: Plateau | None
    lr: float
    best_val: float = math.inf
    best_w: np.ndarray | None = None
    best_epoch: int | None = None
    wait: int = 0
    active: bool = True
    result: TrainResult | None = None
    index: int = 0


# ------------------------------------------------------------- the loop

def spread(df: DataFrame) -> DataFrame:
    """Give a table that is scanned once per step at least one partition per
    core; AQE may have coalesced a small join output into one. Large inputs
    already have more partitions and are left as they are (no shuffle)."""
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par)
    return df


def prepare_table(df: DataFrame, features, target: str, *, key: str | None = None,
                  extra=()) -> DataFrame:
    """Features as one ``x`` array<double> column (nulls -> 0), target ``y``."""
    cols = [F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]).alias("x"),
            F.col(target).cast("double").alias("y")]
    if key:
        cols.append(F.col(key).alias("key"))
    cols += [F.col(c) for c in extra]
    return df.select(*cols)


def _epoch_table(train: DataFrame, seed: int, epoch: int, n: int, bs: int) -> DataFrame:
    """This epoch's permutation, written once with a directory for each
    mini-batch, so a step reads its own files and no others. Rows compute their
    batch where they stand: no shuffle."""
    path = shared_path(train.sparkSession, f"epoch-{epoch}")
    table = train.withColumn("batch_no", permuted_batch("key", n, bs, seed, epoch))
    table.write.partitionBy("batch_no").parquet(path)
    return train.sparkSession.read.schema(table.schema).parquet(path)


def loss_job(df: DataFrame, models: list, batch_col: str | None = "vbatch", loss="mae"):
    """Per config (and batch): loss sums and counts; returns, per config, the
    mean of per-batch mean losses (the reference's validation loss). The means
    are taken on Spark: one row per config reaches the driver. ``loss`` may be a
    list, one per model."""
    ship_package(df.sparkSession)
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast([(m.params, m.activation) for m in models])
    losses = [loss_function(f) for f in per_model(loss, models)]
    cols = [F.col("x").alias("_x"), F.col("y").alias("_y")]
    cols.append(F.col(batch_col).cast("int").alias("_b") if batch_col else F.lit(0).alias("_b"))
    src = df.select(*cols)

    def fn(it):
        sets = bc.value
        acc = {}
        for batch in it:
            if batch.num_rows == 0:
                continue
            X = _batch_matrix(batch, None, "_x")
            y = batch.column(1).fill_null(0.0).to_numpy(zero_copy_only=False).astype(np.float64)
            b = batch.column(2).to_numpy(zero_copy_only=False)
            for c, (params, act) in enumerate(sets):
                e = losses[c](forward_np(params, act, X)[:, 0] - y, 0.0)[0]
                for bb in np.unique(b):
                    m = b == bb
                    s, n = acc.get((c, int(bb)), (0.0, 0))
                    acc[(c, int(bb))] = (s + float(e[m].sum()), n + int(m.sum()))
        if not acc:
            return
        ks = list(acc)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in ks], pa.int32()), pa.array([k[1] for k in ks], pa.int32()),
             pa.array([acc[k][0] for k in ks]), pa.array([acc[k][1] for k in ks], pa.int64())],
            names=["cfg", "b", "s", "n"])

    rows = (src.mapInArrow(fn, "cfg int, b int, s double, n long")
               .groupBy("cfg", "b").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
               .groupBy("cfg").agg(F.avg(F.col("s") / F.col("n")).alias("v")).collect())
    bc.unpersist()
    mean = {r["cfg"]: float(r["v"]) for r in rows}
    return [mean.get(c, float("nan")) for c in range(len(models))]


def _loop(runs: list, nb: int, gradients, val_losses, keep=None) -> None:
    """Epochs x batches for all runs, after those that they have done. ``gradients(epoch,
    k, live)`` gives, for each live run, (mean gradient, mean loss, rows) of batch k;
    ``val_losses(live)`` the validation losses, or None without validation rows;
    ``keep(epoch)`` is called after each epoch."""
    batch_no = [len(r.result.batch_losses) for r in runs]
    done = max(len(r.result.history) for r in runs)
    for epoch in range(done + 1, max(r.cfg.epochs for r in runs) + 1):
        live = [r for r in runs if r.active and epoch <= r.cfg.epochs]
        if not live:
            break
        sums = [0.0] * len(live)
        for k in range(nb):
            for j, (r, (g, loss, cnt)) in enumerate(zip(live, gradients(epoch, k, live))):
                if cnt == 0:
                    continue
                batch_no[r.index] += 1
                r.result.batch_losses.append({"epoch": epoch, "batch": batch_no[r.index], "batch_loss": loss})
                sums[j] += loss
                r.w = r.opt.step(r.w, g, r.lr)
        for r, s, v in zip(live, sums, val_losses(live) or [None] * len(live)):
            r.result.history.append({"epoch": epoch, "loss": s / nb, "val_loss": v, "learning_rate": r.lr})
            LOG.info("%s epoch %d loss %.6f val %s lr %g", r.cfg.name, epoch, s / nb, v, r.lr)
            if r.plateau is not None and v is not None:
                r.lr = r.plateau.step(v)
            if v is not None and r.cfg.patience is not None:
                if v + r.cfg.min_delta < r.best_val:
                    r.best_val, r.best_w, r.best_epoch, r.wait = v, r.w.copy(), epoch, 0
                else:
                    r.wait += 1
                    if r.wait >= r.cfg.patience:
                        r.active = False
                        r.result.stop_epoch = epoch
        if keep is not None:
            keep(epoch)


def _job_loop(train, val, models, runs, n, bs, nb, batch_col, cache, batch_filter, keep=None) -> None:
    """Each step is a Spark job over the persisted table, or over the files of its batch."""
    c0 = runs[0].cfg
    if cache:
        train = spread(train).persist(StorageLevel.MEMORY_AND_DISK)
        val = spread(val).persist(StorageLevel.MEMORY_AND_DISK) if val is not None else None
    n_parts = train.rdd.getNumPartitions() if cache else None   # fixed for every step job
    laid_out = {}

    def rows(epoch, k):
        if not c0.shuffle:
            return train.where(batch_filter(k) if batch_filter is not None else F.col(batch_col) == k)
        if cache:
            return train.where(permuted_batch("key", n, bs, c0.seed, epoch) == k)
        if epoch not in laid_out:
            laid_out.clear()
            laid_out[epoch] = _epoch_table(train, c0.seed, epoch, n, bs)
        return laid_out[epoch].where(F.col("batch_no") == k)

    def current(live):
        return [models[r.index].with_flat(r.w) for r in live]

    def gradients(epoch, k, live):
        cur = current(live)
        return collect_gradients(gradient_job(rows(epoch, k), cur, tie=[r.cfg.tie for r in live],
                                              loss=[r.cfg.loss for r in live]), cur, n_parts)

    def val_losses(live):
        return None if val is None else loss_job(val, current(live), loss=[r.cfg.loss for r in live])

    try:
        _loop(runs, nb, gradients, val_losses, keep)
    finally:
        if cache:
            train.unpersist()
            if val is not None:
                val.unpersist()


def _pieces(batches, most: int):
    """Lists of batches with up to ``most`` rows together."""
    held, n = [], 0
    for b in batches:
        for at in range(0, b.num_rows, most):
            part = b.slice(at, most)
            if n and n + part.num_rows > most:
                yield held
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield held


def _arrays(batches) -> tuple:
    """x, y and place of the training rows, x, y and batch of the validation rows."""
    X = np.concatenate([_batch_matrix(b, None, "x") for b in batches])
    y, place, vb = (np.concatenate([b.column(c).fill_null(null).to_numpy(zero_copy_only=False) for b in batches])
                    for c, null in ((1, 0.0), (2, -1), (3, -1)))
    y, v = y.astype(np.float64), vb >= 0
    return X[~v], y[~v].reshape(-1, 1), place[~v].astype(np.int64), X[v], y[v], vb[v].astype(np.int64)


def _pack(batches):
    """A task's rows as pickled blocks of up to ``PACK_ROWS`` rows (``_arrays``)."""
    for piece in _pieces(batches, PACK_ROWS):
        block = pickle.dumps(_arrays(piece), pickle.HIGHEST_PROTOCOL)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["block"])


_BATCHES: OrderedDict = OrderedDict()      # in a worker: (run, epoch, task, block) -> each row's batch
BATCHES_MB = 64                            # at most this much of it


def _batches(at: tuple, place: np.ndarray, shuffle: bool, seed: int, n: int, bs: int) -> np.ndarray:
    """The batch of each row of a block in one epoch; kept while steps of that epoch follow."""
    run, epoch = at[:2]
    held = _BATCHES.get(at)
    if held is None:
        for old in [k for k in _BATCHES if k[:2] != (run, epoch)]:
            del _BATCHES[old]
        held = permute_np(place, n, shuffle_keys(seed, "epoch", epoch)) // bs if shuffle else place
        _BATCHES[at] = held = held.astype(np.int32)
        while sum(b.nbytes for b in _BATCHES.values()) > BATCHES_MB << 20:
            _BATCHES.popitem(last=False)
    return held


def _packed(src: DataFrame, tasks: int, parts: int | None):
    """Persisted blocks of the rows: of the table's own partitions, or dealt out to ``parts``."""
    src = src.coalesce(tasks) if parts is None else src.repartition(parts)
    return src.mapInArrow(_pack, "block binary").rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.MEMORY_AND_DISK)


def _uneven(blocks, bs: int) -> bool:
    """Do fixed batches lie in few partitions?"""
    def shares(it):
        total = Counter()
        for raw in it:
            total.update(dict(zip(*(v.tolist() for v in np.unique(pickle.loads(raw)[2], return_counts=True)))))
        yield dict(total)

    got = blocks.mapPartitions(shares).collect()
    return max((c for g in got for c in g.values()), default=0) * len(got) > UNEVEN * bs


def _rows(train, val, place: str):
    """Training rows with their place, validation rows with their batch, in the same columns."""
    src = train.select("x", F.col("y").cast("double").alias("y"), F.col(place).cast("long").alias("_p"), F.lit(-1).cast("long").alias("_v"))
    held = None if val is None else val.select("x", F.col("y").cast("double").alias("y"), F.lit(-1).cast("long").alias("_p"),
                                               F.col("vbatch").cast("long").alias("_v"))
    return src, held


def _block_loop(train, val, models, runs, n, bs, nb, batch_col, tasks, keep=None) -> None:
    """Each step is a small job over packed blocks: no plan, no scan."""
    spark = train.sparkSession
    sc = spark.sparkContext
    ship_package(spark)
    shuffle, seed, has_val = runs[0].cfg.shuffle, runs[0].cfg.seed, val is not None
    src, held = _rows(train, val, "key" if shuffle else batch_col)
    parts = tasks * max(1, -(-n // (tasks * PART_ROWS)))
    if n <= tasks * PACK_ROWS or src.rdd.getNumPartitions() < parts:
        blocks = whole = _packed(src if held is None else src.unionByName(held), parts, parts)
        kept = [blocks]
    else:      # many rows in partitions enough: they are packed where they stand
        blocks = _packed(src, parts, None)
        if not shuffle and _uneven(blocks, bs):
            blocks.unpersist()
            blocks = _packed(src, parts, parts)
        kept = [blocks] if held is None else [blocks, _packed(held, parts, None)]
        whole = sc.union(kept)
    nv = 1 + ((val.agg(F.max("vbatch")).first()[0] if has_val else None) or 0)
    run = uuid.uuid4().hex
    nets = [(m.sizes, m.activation) for m in models]
    losses, ties = [loss_function(r.cfg.loss) for r in runs], [r.cfg.tie for r in runs]

    def sums_of(live, epoch, k, validate):
        bc = sc.broadcast([(r.index, r.w) for r in live])

        def part(task, it):
            sets = [(i, w, _net(nets[i], w)) for i, w in bc.value]
            total = None
            for number, raw in enumerate(it):
                X, y, place, Xv, yv, vb = pickle.loads(raw)
                at = np.flatnonzero(_batches((run, epoch if shuffle else 0, task, number), place, shuffle, seed, n, bs) == k)
                out = _step_sums([(net, ties[i], losses[i]) for i, w, net in sets], X[at], y[at], (Xv, yv, vb) if validate else None, nv)
                total = out if total is None else total + out
            if total is not None:
                yield total

        sums = (whole if validate else blocks).mapPartitionsWithIndex(part)
        if sums.getNumPartitions() > DRIVER_SUM_PARTITIONS:
            total = sums.treeReduce(np.add)
        else:
            total = sum(sums.collect())
        bc.unpersist()
        return total

    try:
        _packed_loop(runs, nb, nv if has_val else 0, sums_of, keep)
    finally:
        for rdd in kept:
            rdd.unpersist()


def _step_sums(sets, X, y, held, nv: int) -> np.ndarray:
    """Sums over the rows of a batch: for each run its gradient, loss and row count and,
    with validation rows ``held``, its loss in each of their batches; then their counts."""
    out = []
    for net, tie, loss in sets:
        g, lo = grad_np(net.params, net.activation, X, y, tie, loss)
        out += [g, [lo, float(len(X))]]
        if held:
            Xv, yv, vb = held
            out.append(np.bincount(vb, weights=losses_np(net.params, net.activation, Xv, yv, loss), minlength=nv))
    if held:
        out.append(np.bincount(held[2], minlength=nv))
    return np.concatenate(out)


def _packed_loop(runs, nb, nv, sums_of, keep) -> None:
    """The loop over packed rows; ``nv`` batches of validation rows. ``sums_of(live, epoch,
    k, validate)``: the sum of ``_step_sums`` over all rows of batch k. The validation
    losses of an epoch come with the first gradients of the next, which need the same
    weights and nothing that the losses decide."""
    ready: dict = {}       # gradients computed along with the last validation
    now: dict = {}

    def ask(live, epoch, k, validate):
        total = sums_of(live, epoch, k, validate)
        grads, vals, at = {}, [], 0
        counts = total[-nv:]
        for r in live:
            size = len(r.w)
            g, (lo, cnt) = total[at:at + size], total[at + size:at + size + 2]
            grads[r.index] = (g / cnt, float(lo / cnt), int(cnt)) if cnt else (np.zeros(size), math.nan, 0)
            at += size + 2
            if validate:
                v = total[at:at + nv]
                at += nv
                vals.append(float((v[counts > 0] / counts[counts > 0]).mean()) if (counts > 0).any() else math.nan)
        return grads, vals

    def gradients(epoch, k, live):
        now["epoch"] = epoch
        got = ready.pop((epoch, k), None) or ask(live, epoch, k, False)[0]
        return [got[r.index] for r in live]

    def val_losses(live):
        if not nv:
            return None
        ahead = now["epoch"] + 1
        ready[ahead, 0], vals = ask(live, ahead, 0, True)
        return vals

    _loop(runs, nb, gradients, val_losses, keep)


class _Share:
    """What a member of a team keeps of the table."""

    def __init__(self, parts, nets, ties, losses, seed, n, bs, nb, nv):
        self.X, self.y, self.place = parts[0]
        self.held = parts[1]
        self.nets, self.ties, self.losses, self.seed, self.n, self.bs, self.nb, self.nv = nets, ties, losses, seed, n, bs, nb, nv
        self.epoch = None

    def batch(self, epoch: int, k: int) -> np.ndarray:
        """Rows of batch k; their order by batch is kept while questions of that epoch follow."""
        if epoch != self.epoch:
            keys = shuffle_keys(self.seed, "epoch", epoch)
            b = np.empty(len(self.place), np.min_scalar_type(self.nb))
            for at in range(0, len(b), PACK_ROWS):
                b[at:at + PACK_ROWS] = permute_np(self.place[at:at + PACK_ROWS], self.n, keys) // self.bs
            self.order = np.argsort(b, kind="stable").astype(np.min_scalar_type(len(b)))
            self.cut = np.concatenate([[0], np.cumsum(np.bincount(b, minlength=self.nb))])
            self.epoch = epoch
        return self.order[self.cut[k]:self.cut[k + 1]]

    def __call__(self, question: np.ndarray) -> np.ndarray:
        epoch, k, validate, live = question[:4].astype(int)
        sets, at = [], 4 + live
        for i in question[4:at].astype(int):
            net = _net(self.nets[i], question[at:])
            at += net.n_params
            sets.append((net, self.ties[i], self.losses[i]))
        rows = self.batch(epoch, k)
        return _step_sums(sets, self.X.take(rows, axis=0), self.y.take(rows).reshape(-1, 1), self.held if validate else None, self.nv)


def _store(batches, uri: str, most: int):
    """A task's rows as files of up to ``most`` rows: their names and what they hold."""
    fs, root = open_fs(uri)
    for piece in _pieces(batches, most):
        X, y, place, Xv, yv, vb = _arrays(piece)
        if (place < 0).any():          # rows of no batch
            X, y, place = (v[place >= 0] for v in (X, y, place))
        name = f"rows-{uuid.uuid4().hex}"
        team.write_rows(fs, f"{root}/{name}", [(X, y[:, 0], place), (Xv, yv, vb)])
        yield pa.RecordBatch.from_pydict({"name": [name], "n": [len(y)], "v": [len(yv)], "last": [int(vb.max(initial=-1))]})


def _team_loop(train, val, models, runs, n, bs, nb, tasks, keep=None) -> None:
    """Each step is a question to a team that keeps the rows. Before the state is
    committed, which takes Spark jobs, the team lets its cores go."""
    spark = train.sparkSession
    tasks = min(tasks, team.slots(spark))
    if not tasks or n > tasks * TEAM_ROWS:
        raise team.NoTeam(f"{n} rows, {tasks} tasks at a time")
    ship_package(spark)
    src, held = _rows(train, val, "key")
    src = src if held is None else src.unionByName(held)
    with team.Team(spark) as crew:
        uri, most = crew.uri, max(BLOCK_ROWS_MIN // 4, min(PACK_ROWS, -(-n // (tasks * TEAM_FILES))))
        files = src.mapInArrow(lambda it: _store(it, uri, most), "name string, n long, v long, last long").collect()
        shares = team.shares([(f["name"], (f["n"], f["v"])) for f in files], tasks)
        if max(sum(sum(f[1]) for f in s) for s in shares) > TEAM_ROWS:
            raise team.NoTeam(f"{sum(f['v'] for f in files)} validation rows besides")
        nv = 0 if val is None else 1 + max((f["last"] for f in files if f["v"]), default=0)
        nets, seed = [(m.sizes, m.activation) for m in models], runs[0].cfg.seed
        losses, ties = [loss_function(r.cfg.loss) for r in runs], [r.cfg.tie for r in runs]

        def loads(share):
            names, sizes = [f[0] for f in share], [sum(f[1][k] for f in share) for k in range(2)]
            return lambda: _Share(team.load_rows(uri, names, sizes), nets, ties, losses, seed, n, bs, nb, nv)

        def sums_of(live, epoch, k, validate):
            return crew.ask(np.concatenate([[epoch, k, validate, len(live)], [r.index for r in live], *(r.w for r in live)]))

        crew.members([loads(s) for s in shares])
        _packed_loop(runs, nb, nv, sums_of, None if keep is None else lambda epoch: keep(epoch, crew.pause))


def _net(shape, w: np.ndarray) -> MLP:
    sizes, act = shape
    zero = [(np.zeros((i, o)), np.zeros(o)) for i, o in zip(sizes, sizes[1:])]
    return MLP(list(sizes), act, zero).with_flat(w)


def _new_run(i: int, c: TrainConfig, w: np.ndarray, has_val: bool, model) -> _Run:
    plateau = Plateau(c.lr, c.plateau_factor, c.plateau_patience, c.plateau_threshold) if c.plateau and has_val else None
    return _Run(c, w, Optimizer(c, len(w)), plateau, c.lr, best_w=w.copy(), result=TrainResult(c, model), index=i)


def _keeper(spark, at: recovery.Checkpoint, runs: list, n: int, bs: int):
    """Restores the runs, and gives what the loop calls after each epoch; ``before`` is
    called when the state is about to be committed."""
    recovery.restore(spark, at, runs, n, bs)
    last = max(r.cfg.epochs for r in runs)

    def keep(epoch, before=None):
        going = any(r.active and epoch < r.cfg.epochs for r in runs)
        if epoch % at.every == 0 or epoch == last or not going:
            if before is not None:
                before()
            recovery.save(spark, at, runs, n, bs)
    return keep


def block_tasks(df: DataFrame, n: int) -> int:
    """Tasks of a step over packed rows, or 0 where one would have more than ``BLOCK_ROWS`` rows."""
    most = max(1, df.sparkSession.sparkContext.defaultParallelism)
    tasks = max(1, min(most, -(-n // BLOCK_ROWS_MIN)))
    return tasks if n <= tasks * BLOCK_ROWS else 0


def fit(train: DataFrame, models: list, configs: list, *, val: DataFrame | None = None,
        n_train: int | None = None, batch_col: str = "batch", cache: bool = True,
        batch_filter=None, mode: str = "auto", checkpoint: recovery.Checkpoint | None = None) -> list:
    """Train ``models[i]`` with ``configs[i]`` on one shared batch schedule.

    ``train`` has ``x``, ``y`` and either ``key`` (shuffled batches; a position from 0
    without gaps, else rows are ranked by it once) or ``batch_col`` (fixed batches).
    ``val`` (``x``, ``y``, ``vbatch``) enables validation loss, plateau schedule and
    early stopping. ``mode``: 'team' asks a team for each step (shuffled batches only),
    'blocks' steps over packed blocks in memory, 'jobs' over the table, 'auto' the first
    that the rows (``block_tasks``, ``TEAM_ROWS``), ``BLOCK_BATCHES`` and the cluster
    allow. ``cache=False`` (tables
    too large for memory) keeps nothing: shuffled batches are then read from a table
    that each epoch writes with a directory for each batch. ``checkpoint``: commit the
    state every few epochs, and go on after the epoch last committed under its id.
    """
    if not configs:
        return []
    c0 = configs[0]
    for c in configs[1:]:
        if (c.batch_size, c.shuffle, c.seed) != (c0.batch_size, c0.shuffle, c0.seed):
            raise ValueError("configs in one fit must share batch_size, shuffle and seed")
    if mode not in ("auto", "team", "blocks", "jobs"):
        raise ValueError(f"mode {mode!r} is not known: auto, team, blocks or jobs")
    if mode == "team" and not c0.shuffle:
        raise ValueError("a team steps over shuffled batches")
    for c in configs:
        loss_function(c.loss)
    t0 = time.time()
    if c0.shuffle:
        n, lo, hi = train.agg(F.count("*"), F.min("key"), F.max("key")).first()
        if n and (lo, hi) != (0, n - 1):
            train = row_index(train, "key", "_rank").drop("key").withColumnRenamed("_rank", "key")
    else:
        n = train.count() if n_train is None else n_train
    bs = c0.batch_size or max(1, math.ceil(n / 10))
    nb = max(1, math.ceil(n / bs))
    runs = [_new_run(i, c, m.flat(), val is not None, m) for i, (m, c) in enumerate(zip(models, configs))]
    keep = _keeper(train.sparkSession, checkpoint, runs, n, bs) if checkpoint else None
    tasks = block_tasks(train, n) if mode in ("blocks", "team") or mode == "auto" and cache and nb <= BLOCK_BATCHES else 0
    if mode in ("blocks", "team") and not tasks:
        raise ValueError("the rows do not fit in blocks on this cluster")
    teamed = False
    if tasks and c0.shuffle and mode != "blocks":
        try:
            _team_loop(train, val, models, runs, n, bs, nb, tasks, keep)
            teamed = True
        except team.NoTeam as e:
            if mode == "team":
                raise
            LOG.warning("no team, a job for each step: %s", e)
    if teamed:
        pass
    elif tasks:
        _block_loop(train, val, models, runs, n, bs, nb, batch_col, tasks, keep)
    else:
        _job_loop(train, val, models, runs, n, bs, nb, batch_col, cache, batch_filter, keep)
    for r, m in zip(runs, models):
        use_best = val is not None and r.cfg.patience is not None and r.best_epoch is not None
        r.result.model = m.with_flat(r.best_w if use_best else r.w)
        r.result.best_epoch = r.best_epoch
        if r.result.stop_epoch is None:
            r.result.stop_epoch = len(r.result.history)
        r.result.seconds = time.time() - t0
    return [r.result for r in runs]


# ---------------------------------------------------------- evaluation

def score_many(df: DataFrame, models: list, *, keep=("y",)) -> DataFrame:
    """(cfg, pred, kept columns) for every row and every model: one scan."""
    ship_package(df.sparkSession)
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast([(m.params, m.activation) for m in models])
    keep = list(keep)
    src = df.select(F.col("x").alias("_x"), *[F.col(k) for k in keep])
    schema = ", ".join(["cfg int", "pred double"] +
                       [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name in keep])

    def fn(it):
        sets = bc.value
        for batch in it:
            if batch.num_rows == 0:
                continue
            X = _batch_matrix(batch, None, "_x")
            kept = [batch.column(batch.schema.get_field_index(k)) for k in keep]
            for c, (params, act) in enumerate(sets):
                p = forward_np(params, act, X)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), c, dtype=np.int32)), pa.array(p)] + kept,
                    names=["cfg", "pred"] + keep)

    return src.mapInArrow(fn, schema)


def evaluate_models(test: DataFrame, models: list) -> DataFrame:
    """Per model: mae, mse, rmse, r2, mape, pred_std, target_std, n, mae_pct,
    grade; one scoring scan and one keyed aggregate."""
    s = score_many(test, models)
    m = s.groupBy("cfg").agg(*metric_exprs("pred", "y"))
    pct, g = grade_expr(F.col("mae"), F.col("target_std"))
    return (m.withColumn("mae_pct", pct).withColumn("grade", g)
             .withColumn("mae_band", band_expr(F.col("mae"))))
