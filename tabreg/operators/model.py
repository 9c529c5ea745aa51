"""Multilayer perceptron: scoring and gradients as distributed jobs.

Parameters live on the driver as a list of (W, b) NumPy pairs (W is
(in, out)); 8->64->32->1 holds 2,689 numbers. A job broadcasts them, runs the
forward (and backward) pass on Arrow batches inside each task, and, for
gradients, yields **one partial row per parameter per partition**; a keyed
aggregate sums the partials, so the driver receives parameter-sized results
whatever the row count. No shuffle of data rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

from .matrix import _batch_matrix

ACTS = ("relu", "sigmoid", "tanh", "identity")


# ------------------------------------------------------------ init rules

def init_layer(rng: np.random.Generator, n_in: int, n_out: int, rule: str = "xavier_normal",
               mean: float = 0.0, std: float = 1.0, low: float = -1.0, high: float = 1.0):
    """Seeded draws with each rule's documented scale. Biases are zero except
    ``normal`` (bias = mean) and ``uniform`` (bias = low)."""
    if rule == "xavier_normal":
        W = rng.normal(0.0, np.sqrt(2.0 / (n_in + n_out)), (n_in, n_out))
        b = np.zeros(n_out)
    elif rule == "xavier_uniform":
        a = np.sqrt(6.0 / (n_in + n_out))
        W, b = rng.uniform(-a, a, (n_in, n_out)), np.zeros(n_out)
    elif rule == "kaiming_normal":
        W, b = rng.normal(0.0, np.sqrt(2.0 / n_in), (n_in, n_out)), np.zeros(n_out)
    elif rule == "kaiming_uniform":
        a = np.sqrt(6.0 / n_in)
        W, b = rng.uniform(-a, a, (n_in, n_out)), np.zeros(n_out)
    elif rule == "normal":
        W, b = rng.normal(mean, std, (n_in, n_out)), np.full(n_out, float(mean))
    elif rule == "uniform":
        W, b = rng.uniform(low, high, (n_in, n_out)), np.full(n_out, float(low))
    else:
        raise ValueError(f"unknown init {rule!r}")
    return W, b


@dataclass
class MLP:
    """Layer sizes, hidden activation and parameters (the last layer is
    linear). ``MLP.create([8, 64, 32, 1])`` is the reference's network."""
    sizes: list
    activation: str = "relu"
    params: list = field(default_factory=list)

    @classmethod
    def create(cls, sizes=(8, 64, 32, 1), activation: str = "relu", init: str = "xavier_normal",
               seed: int = 42, **init_kw) -> "MLP":
        if activation not in ACTS:
            raise ValueError(f"unknown activation {activation!r}")
        rng = np.random.default_rng(seed)
        params = [init_layer(rng, a, b, init, **init_kw) for a, b in zip(sizes[:-1], sizes[1:])]
        return cls(list(sizes), activation, params)

    def __len__(self) -> int:
        """Number of linear layers in the chain."""
        return len(self.params)

    @property
    def n_params(self) -> int:
        return int(sum(W.size + b.size for W, b in self.params))

    def flat(self) -> np.ndarray:
        return np.concatenate([np.concatenate([W.ravel(), b]) for W, b in self.params])

    def with_flat(self, v: np.ndarray) -> "MLP":
        out, k = [], 0
        for W, b in self.params:
            Wn = v[k:k + W.size].reshape(W.shape)
            k += W.size
            bn = v[k:k + b.size].copy()
            k += b.size
            out.append((Wn.copy(), bn))
        return MLP(list(self.sizes), self.activation, out)

    def copy(self) -> "MLP":
        return self.with_flat(self.flat())


def _act(z, name):
    """The activation, in place of ``z``."""
    if name == "relu":
        return np.fmax(z, 0.0, out=z)                                # NaN reads 0, infinities stay
    if name == "sigmoid":
        with np.errstate(over="ignore"):
            np.exp(np.negative(z, out=z), out=z)
            z += 1.0
            return np.divide(1.0, z, out=z)
    if name == "tanh":
        return np.tanh(z, out=z)
    return z


def _act_back(g, a, name, room):
    """``g`` times the derivative at the activation ``a``, in place; ``room`` is as large."""
    if name == "relu":
        g *= np.greater(a, 0.0, out=room)                            # where z was NaN, a is 0
    elif name == "sigmoid":
        np.subtract(1.0, a, out=room)
        room *= a
        g *= room
    elif name == "tanh":
        np.multiply(a, a, out=room)
        g *= np.subtract(1.0, room, out=room)
    return g


def forward_np(params, act: str, X: np.ndarray) -> np.ndarray:
    a = X
    last = len(params) - 1
    for k, (W, b) in enumerate(params):
        z = a @ W
        z += b
        a = z if k == last else _act(z, act)
    return a


def mae_pair(diff: np.ndarray, tie: float = 0.0):
    """MAE per cell and its derivative w.r.t. the prediction (sign; ``tie``
    at exactly 0, 0.0 by default)."""
    g = np.sign(diff)
    if tie != 0.0:
        g = np.where(diff == 0, tie, g)
    return np.abs(diff), g


def mse_pair(diff: np.ndarray, tie: float = 0.0):
    """Squared error per cell and its derivative w.r.t. the prediction."""
    return diff * diff, 2.0 * diff


# Loss extension point: name -> f(diff = pred - target, tie) -> (per-cell
# value, per-cell gradient). Jobs look a name up on the driver and ship the
# function itself, so a loss added here by a user works in the workers.
LOSSES = {"mae": mae_pair, "mse": mse_pair}


def loss_function(loss):
    """A function of ``LOSSES`` by name, or the function itself."""
    if callable(loss):
        return loss
    if loss not in LOSSES:
        raise ValueError(f"unknown loss {loss!r}; known: {', '.join(sorted(LOSSES))}")
    return LOSSES[loss]


def per_model(value, models: list) -> list:
    """One value for each model: a list as it is, else the same for all."""
    return list(value) if isinstance(value, (list, tuple)) else [value] * len(models)


# Rows whose activations stay in a core's cache on their way forward and back.
CHUNK_ROWS = 512


def grad_np(params, act: str, X: np.ndarray, y: np.ndarray, tie: float = 0.0, loss="mae"):
    """Σ over rows of d loss/dθ (flattened like ``MLP.flat``) and Σ loss.
    Sums, not means: the driver divides by the global count once. Rows are taken
    ``CHUNK_ROWS`` at a time, all in the same arrays."""
    fn = loss_function(loss)
    rows, total = min(CHUNK_ROWS, len(X)), 0.0
    room = [tuple(np.empty((rows, len(b))) for _ in range(3)) for _, b in params]
    sums = [(np.zeros(W.shape), np.zeros(len(b))) for W, b in params]
    ones = np.ones(rows)
    for at in range(0, len(X), CHUNK_ROWS):
        total += _grad_chunk(params, act, X[at:at + CHUNK_ROWS], y[at:at + CHUNK_ROWS], tie, fn, room, sums, ones)
    return np.concatenate([v for gw, gb in sums for v in (gw.ravel(), gb)]), total


def losses_np(params, act: str, X: np.ndarray, y: np.ndarray, fn) -> np.ndarray:
    """Each row's loss."""
    out = np.empty(len(X))
    for at in range(0, len(X), CHUNK_ROWS):
        out[at:at + CHUNK_ROWS] = fn(forward_np(params, act, X[at:at + CHUNK_ROWS])[:, 0] - y[at:at + CHUNK_ROWS], 0.0)[0]
    return out


def _grad_chunk(params, act: str, X: np.ndarray, y: np.ndarray, tie: float, fn, room, sums, ones) -> float:
    """Adds a chunk's gradients to ``sums`` and gives its loss. ``room`` has, for each
    layer, arrays for the activation, the gradient and the derivative."""
    n, last = len(X), len(params) - 1
    acts = [X]
    for k, (W, b) in enumerate(params):
        z = np.matmul(acts[k], W, out=room[k][0][:n])
        z += b
        acts.append(z if k == last else _act(z, act))
    a = acts[-1]
    val, g = fn(a - y.reshape(-1, a.shape[1]), tie)
    for k in range(last, -1, -1):
        if k != last:
            g = _act_back(g, acts[k + 1], act, room[k][2][:n])
        gw, gb = sums[k]
        gw += acts[k].T @ g
        gb += ones[:n] @ g
        if k > 0:
            g = np.matmul(g, params[k][0].T, out=room[k - 1][1][:n])
    return float(val.sum())


# ---------------------------------------------------------------- scoring

def _features(df: DataFrame, feature_cols, array_col):
    if array_col:
        return F.col(array_col).alias("_x")
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in feature_cols]).alias("_x")


def score_native(df: DataFrame, model: MLP, feature_cols, *, out: str = "pred", keep=()) -> Column:
    """Forward pass as one Catalyst expression (tiny networks only)."""
    from ..functions.elementwise import ACTIVATIONS
    act = ACTIVATIONS[model.activation]
    h = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in feature_cols]
    last = len(model.params) - 1
    for k, (W, b) in enumerate(model.params):
        nxt = []
        for j in range(W.shape[1]):
            e = F.lit(float(b[j]))
            for i in range(W.shape[0]):
                e = e + h[i] * F.lit(float(W[i, j]))
            nxt.append(e if k == last else act(e))
        h = nxt
    return df.select(*[F.col(k) for k in keep], h[0].alias(out))


def mlp_score(df: DataFrame, model: MLP, feature_cols=None, *, array_col: str | None = None,
              out: str = "pred", keep=(), method: str = "auto") -> DataFrame:
    """Predictions for every row. ``arrow`` (default for real networks):
    weights broadcast, NumPy forward pass per Arrow batch, no shuffle.
    ``native``: one Catalyst expression, for networks of <= 64 weights."""
    if method == "auto":
        method = "native" if (model.n_params <= 64 and not array_col) else "arrow"
    if method == "native":
        return score_native(df, model, feature_cols, out=out, keep=keep)
    keep = list(keep)
    ship_package(df.sparkSession)
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast((model.params, model.activation))
    src = df.select(*[F.col(k) for k in keep], _features(df, feature_cols, array_col))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name in keep]
                       + [f"`{out}` double"])

    def fn(it):
        params, act = bc.value
        for batch in it:
            if batch.num_rows == 0:
                continue
            X = _batch_matrix(batch, None, "_x")
            p = forward_np(params, act, X)[:, 0]
            cols = [batch.column(batch.schema.get_field_index(k)) for k in keep] + [pa.array(p)]
            yield pa.RecordBatch.from_arrays(cols, names=keep + [out])

    return src.mapInArrow(fn, schema)


# --------------------------------------------------------------- gradients

def gradient_job(df: DataFrame, models: list, *, x_col: str = "x", y_col: str = "y",
                 tie=0.0, loss="mae") -> DataFrame:
    """Partial gradient sums for one or more parameter sets over the rows of
    ``df`` (already filtered to one batch): one row per partition and config,
    ``(cfg, value array)`` where ``value[:P]`` are gradient sums, ``value[P]``
    the loss sum and ``value[P+1]`` the row count. No shuffle. ``tie`` and
    ``loss`` (a name of ``LOSSES`` or a function) may be lists, one per model."""
    ship_package(df.sparkSession)
    spark = df.sparkSession
    payload = [(m.params, m.activation) for m in models]
    bc = spark.sparkContext.broadcast(payload)
    ties, losses = per_model(tie, models), [loss_function(f) for f in per_model(loss, models)]
    src = df.select(F.col(x_col).alias("_x"), F.col(y_col).cast("double").alias("_y"))

    def fn(it):
        sets = bc.value
        acc = [None] * len(sets)
        lsum = [0.0] * len(sets)
        cnt = 0
        for batch in it:
            if batch.num_rows == 0:
                continue
            X = _batch_matrix(batch, None, "_x")
            y = batch.column(1).fill_null(0.0).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, 1)
            cnt += batch.num_rows
            for c, (params, act) in enumerate(sets):
                g, lo = grad_np(params, act, X, y, ties[c], losses[c])
                acc[c] = g if acc[c] is None else acc[c] + g
                lsum[c] += lo
        if cnt == 0:
            return
        vals = [np.concatenate([g, [lsum[c], float(cnt)]]) for c, g in enumerate(acc)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(vals), dtype=np.int32)), pa.array([v for v in vals], pa.list_(pa.float64()))],
            names=["cfg", "value"])

    out = src.mapInArrow(fn, "cfg int, value array<double>")
    out._tabreg_broadcasts = [bc]   # released by collect_gradients
    return out


# With more partial rows than this, partials are summed by a keyed aggregate
# (a second distributed level) before they reach the driver.
DRIVER_SUM_PARTITIONS = 64


def collect_gradients(job: DataFrame, models: list, n_parts: int | None = None):
    """Run a gradient job; return per config (mean gradient, mean loss, n).
    The driver receives at most DRIVER_SUM_PARTITIONS partial arrays per
    config, or one summed array per config: parameter-sized either way."""
    sizes = [m.n_params + 2 for m in models]
    tot = [np.zeros(s) for s in sizes]
    if n_parts is None:
        n_parts = job.rdd.getNumPartitions()
    if n_parts <= DRIVER_SUM_PARTITIONS:
        for r in job.collect():
            tot[r["cfg"]] += np.asarray(r["value"], dtype=np.float64)
    else:
        long = job.select("cfg", F.posexplode("value").alias("k", "v"))
        for r in long.groupBy("cfg", "k").agg(F.sum("v").alias("v")).collect():
            tot[r["cfg"]][r["k"]] += r["v"]
    for bc in getattr(job, "_tabreg_broadcasts", []):
        bc.unpersist()
    out = []
    for c, m in enumerate(models):
        P = m.n_params
        v = tot[c]
        n = v[P + 1]
        if n == 0:
            out.append((np.zeros(P), float("nan"), 0))
        else:
            out.append((v[:P] / n, v[P] / n, int(n)))
    return out


def mlp_gradient(df: DataFrame, model: MLP, *, x_col: str = "x", y_col: str = "y") -> DataFrame:
    """Mean MAE gradient of every parameter over the rows of ``df``, long
    form (layer, kind, i, j, value) plus one ('loss', ...) row."""
    spark = df.sparkSession
    (g, loss, n), = collect_gradients(gradient_job(df, [model], x_col=x_col, y_col=y_col), [model])
    rows = params_rows(model.with_flat(g))
    rows.append((-1, "loss", 0, 0, float(loss)))
    return spark.createDataFrame(rows, "layer int, kind string, i int, j int, value double")


def params_rows(model: MLP):
    """(layer, kind, i, j, value) for every parameter (bounded by size)."""
    rows = []
    for L, (W, b) in enumerate(model.params):
        for i in range(W.shape[0]):
            for j in range(W.shape[1]):
                rows.append((L, "weight", i, j, float(W[i, j])))
        for j in range(b.shape[0]):
            rows.append((L, "bias", 0, j, float(b[j])))
    return rows
