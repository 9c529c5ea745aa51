"""Run tables: history, batch losses, optimizer and scaler state, parameters,
predictions, run records -- all queryable, keyed by ``run_id``.

Run-level folds (early stopping, plateau schedule) stream each run's epochs in
order through one task, which keeps a few numbers of the run it is in: many
runs, or a very long one, are the same to it.
"""

from __future__ import annotations

import math
import time
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from ..session import ship_package

from .model import MLP, params_rows
from .project import history_thin
from .registry import commit_run, read_table
from .train import Plateau

REPLAY_ROWS = 10_000      # rows of one output batch of a fold
HISTORY_SCHEMA = "run_id string, epoch int, loss double, val_loss double, learning_rate double"
BATCH_SCHEMA = "run_id string, epoch int, batch int, batch_loss double"
PARAM_SCHEMA = "model_id string, layer int, kind string, i int, j int, value double"
OPT_SCHEMA = ("run_id string, optimizer string, learning_rate double, momentum double, "
              "weight_decay double, beta1 double, beta2 double, epsilon double")


# ------------------------------------------------------------- timestamps

def run_id_expr(ts: Column) -> Column:
    """``yyyyMMdd_HHmmss`` (session time zone UTC), the run-id format."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def utc_string_expr(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss UTC``."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))


def new_run_id(spark: SparkSession, seconds: int | None = None) -> str:
    s = int(time.time()) if seconds is None else int(seconds)
    return spark.range(1).select(run_id_expr(F.timestamp_seconds(F.lit(s))).alias("r")).first()["r"]


# ------------------------------------------------------- tables from runs

def history_table(spark: SparkSession, result, run_id: str) -> DataFrame:
    rows = [(run_id, int(h["epoch"]), float(h["loss"]),
             None if h["val_loss"] is None else float(h["val_loss"]), float(h["learning_rate"]))
            for h in result.history]
    return spark.createDataFrame(rows, HISTORY_SCHEMA)


def batch_losses_table(spark: SparkSession, result, run_id: str) -> DataFrame:
    rows = [(run_id, int(b["epoch"]), int(b["batch"]), float(b["batch_loss"])) for b in result.batch_losses]
    return spark.createDataFrame(rows, BATCH_SCHEMA)


def optimizer_table(spark: SparkSession, cfg, run_id: str, lr: float | None = None) -> DataFrame:
    is_adam = cfg.optimizer.lower() == "adam"
    return spark.createDataFrame(
        [(run_id, cfg.optimizer.lower(), float(cfg.lr if lr is None else lr), float(cfg.momentum),
          float(cfg.weight_decay), float(cfg.betas[0]) if is_adam else None,
          float(cfg.betas[1]) if is_adam else None, float(cfg.eps) if is_adam else None)], OPT_SCHEMA)


def params_table(spark: SparkSession, model: MLP, model_id: str) -> DataFrame:
    return spark.createDataFrame([(model_id,) + r for r in params_rows(model)], PARAM_SCHEMA)


def model_rows(spark: SparkSession, model: MLP, model_id: str) -> DataFrame:
    """Every parameter as a row (layer, kind, i, j, value), with the architecture in the row layout."""
    return params_table(spark, model, model_id).drop("model_id").withColumn("activation", F.lit(model.activation))


def _place(path: str) -> tuple[str, str]:
    root, _, name = path.rstrip("/").rpartition("/")
    return root, name


def save_model(spark: SparkSession, model: MLP, path: str, model_id: str) -> None:
    """Commit a network's parameter rows to the table at ``path`` (a registry's folder
    and a table name); saved again under its id, the network replaces the one before."""
    root, name = _place(path)
    commit_run(spark, root, model_id, {name: model_rows(spark, model, model_id)})


def load_model(spark: SparkSession, path: str, model_id: str) -> MLP:
    """Rebuild the network from its committed parameter rows (bounded by its size;
    only that model's folder is read)."""
    root, name = _place(path)
    rows = read_table(spark, root, name, model_id).collect()
    act = rows[0]["activation"]
    layers = sorted({r["layer"] for r in rows})
    params = []
    for L in layers:
        w = [r for r in rows if r["layer"] == L and r["kind"] == "weight"]
        b = [r for r in rows if r["layer"] == L and r["kind"] == "bias"]
        n_in = max(r["i"] for r in w) + 1
        n_out = max(r["j"] for r in w) + 1
        W = np.zeros((n_in, n_out))
        for r in w:
            W[r["i"], r["j"]] = r["value"]
        bv = np.zeros(n_out)
        for r in b:
            bv[r["j"]] = r["value"]
        params.append((W, bv))
    sizes = [params[0][0].shape[0]] + [W.shape[1] for W, _ in params]
    return MLP(sizes, act, params)


# ------------------------------------------------------------ run folds

def _in_epoch_order(history: DataFrame, by: str, epoch: str, val: str) -> DataFrame:
    """(run, epoch, value), each run in one partition and sorted there: a run streams
    through its task from the sorted (and spilled) shuffle, however long it is."""
    cols = history.select(F.col(by).alias("run"), F.col(epoch).cast("int").alias("at"), F.col(val).cast("double").alias("v"))
    return cols.repartition("run").sortWithinPartitions("run", "at", "v")


def _replay(history: DataFrame, by: str, epoch: str, val: str, fold, fields: str) -> DataFrame:
    """One pass over each run in epoch order. ``fold`` gets an iterator of (epoch,
    value) and yields the run's output rows without ``by``; it must read to the end."""
    key = history.schema[by].dataType
    schema = StructType([StructField(by, key), *StructType.fromDDL(fields).fields])
    arrow = to_arrow_schema(schema)

    def rows(batches):
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    def run(batches):
        out: list = []
        for k, of_run in groupby(rows(batches), itemgetter(0)):
            for r in fold((e, v) for _, e, v in of_run):
                out.append((k, *r))
                if len(out) == REPLAY_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    ship_package(history.sparkSession)
    return _in_epoch_order(history, by, epoch, val).mapInArrow(run, schema)


def early_stopping(history: DataFrame, patience: int, min_delta: float = 0.0, *,
                   by: str = "run_id", epoch: str = "epoch", val: str = "val_loss") -> DataFrame:
    """Replays early stopping over a history table: per run, best epoch,
    best validation loss, the epoch training stopped at and whether it
    stopped early. A fold over the run's epochs in order (``best`` moves only
    on a counted improvement, so with ``min_delta > 0`` a running minimum would
    not be equivalent). A null or NaN loss is no improvement; epochs of one
    number are taken in order of loss, null epochs first. A null run is a run."""

    def fold(epochs):
        best, wait, best_epoch, stop, done, last = math.inf, 0, None, None, False, None
        for e, v in epochs:
            last = e
            if done:
                continue
            if v is not None and v + min_delta < best:
                best, wait, best_epoch = v, 0, e
            else:
                wait += 1
            if wait >= patience:
                stop, done = e, True
        yield best_epoch, best, last if stop is None else stop, done

    return _replay(history, by, epoch, val, fold, "best_epoch int, best_val double, stop_epoch int, stopped_early boolean")


def plateau_schedule(history: DataFrame, lr0: float, *, factor: float = 0.5, patience: int = 5,
                     threshold: float = 1e-4, min_lr: float = 0.0, eps: float = 1e-8,
                     by: str = "run_id", epoch: str = "epoch", val: str = "val_loss") -> DataFrame:
    """Learning rate in effect at every epoch under reduce-on-plateau (mode
    min, relative threshold), replayed per run by the fold that training uses.
    Nulls and equal epochs as in ``early_stopping``."""

    def fold(epochs):
        state = Plateau(lr0, factor, patience, threshold, min_lr, eps)
        for e, v in epochs:
            yield e, state.lr
            state.step(math.nan if v is None else v)

    return _replay(history, by, epoch, val, fold, "epoch int, learning_rate double")


def model_summary(history: DataFrame, *, by: str = "run_id", every: int = 20) -> tuple[DataFrame, DataFrame]:
    """Per run: epochs, final loss (loss at the last epoch), min and mean
    loss; plus the thinned progress table (every 20th epoch and the last)."""
    summ = history.groupBy(by).agg(
        F.count(F.lit(1)).cast("long").alias("total_epochs"),
        F.max_by("loss", "epoch").alias("final_loss"),
        F.min("loss").alias("min_loss"),
        F.avg("loss").alias("mean_loss"))
    return summ, history_thin(history, every, by=by)


# ----------------------------------------------------------- run record

RUN_STATE_SCHEMA = """
run_id string,
metadata struct<model_name:string, created_at:string, last_trained:string,
                total_training_time:double, model_version:string, notes:string>,
training_state struct<epoch_losses:array<double>, learning_rates:array<double>,
                      batch_losses:array<double>, current_epoch:int, total_epochs:int,
                      best_loss:double, convergence_status:string>,
architecture struct<layer_sizes:array<struct<n_in:int,n_out:int>>, activation_functions:array<string>,
                    total_parameters:int, model_type:string, input_features:array<string>,
                    output_features:array<string>>,
evaluation struct<test_mae:double, test_mse:double, test_rmse:double, r2_score:double>,
optimizer struct<optimizer_type:string, learning_rate:double, momentum:double, weight_decay:double,
                 beta1:double, beta2:double, epsilon:double>,
scaling struct<feature_scaling_type:string, target_scaling_type:string, feature_columns:array<string>,
               target_column:string>,
config struct<batch_size:int, epochs:int, train_test_split:double, random_seed:long,
              loss_function:string, early_stopping_patience:int, early_stopping_threshold:double>
"""


def run_state(spark: SparkSession, run_id: str, result, metrics: dict | None, *, features, target: str,
              feature_scaling: str, target_scaling: str | None, batch_size: int,
              train_test_split: float = 0.8, notes: str = "regression model") -> DataFrame:
    """One nested row describing a run: what actually ran (loss MAE, real
    parameter count, scaler kinds), not placeholders."""
    ts = run_id
    created = spark.range(1).select(utc_string_expr(F.current_timestamp()).alias("t")).first()["t"]
    m = result.model
    cfg = result.config
    losses = [float(h["loss"]) for h in result.history]
    is_adam = cfg.optimizer.lower() == "adam"
    acts = []
    for k in range(len(m.params)):
        acts.append("linear")
        if k < len(m.params) - 1:
            acts.append(m.activation)
    stopped = result.stop_epoch is not None and result.stop_epoch < cfg.epochs
    row = (
        run_id,
        (f"model_{ts}", ts, created, float(result.seconds), "1.0.0", notes),
        (losses, [float(h["learning_rate"]) for h in result.history],
         [float(b["batch_loss"]) for b in result.batch_losses], len(losses), int(cfg.epochs),
         min(losses) if losses else None, "early_stopped" if stopped else "completed"),
        ([(int(W.shape[0]), int(W.shape[1])) for W, _ in m.params], acts, m.n_params, "mlp",
         list(features), [target]),
        None if metrics is None else (metrics.get("mae"), metrics.get("mse"), metrics.get("rmse"),
                                      metrics.get("r2")),
        (cfg.optimizer.lower(), float(cfg.lr), float(cfg.momentum), float(cfg.weight_decay),
         float(cfg.betas[0]) if is_adam else None, float(cfg.betas[1]) if is_adam else None,
         float(cfg.eps) if is_adam else None),
        (feature_scaling, target_scaling, list(features), target),
        (int(batch_size), int(cfg.epochs), float(train_test_split), int(cfg.seed), "MAE",
         cfg.patience, float(cfg.min_delta) if cfg.patience is not None else None),
    )
    return spark.createDataFrame([row], " ".join(RUN_STATE_SCHEMA.split()))


RUN_TABLES = ("training_history", "batch_losses", "optimizer_state", "parameters", "predictions", "scaling_params", "run_state")


def save_run(spark: SparkSession, root: str, run_id: str, result, *, predictions: DataFrame | None = None,
             scaler_params: DataFrame | None = None, state: DataFrame | None = None) -> str:
    """Commit every table of one run to the registry of runs under ``root`` (see
    ``registry``): readers see all of them or none, and saving the run again
    replaces them. Read with ``registry.read_table``. Returns the run id."""
    tables = {"training_history": history_table(spark, result, run_id),
              "optimizer_state": optimizer_table(spark, result.config, run_id),
              "parameters": model_rows(spark, result.model, run_id)}
    if result.batch_losses:
        tables["batch_losses"] = batch_losses_table(spark, result, run_id)
    tables |= {name: df for name, df in (("predictions", predictions), ("scaling_params", scaler_params), ("run_state", state))
               if df is not None}
    commit_run(spark, root, run_id, tables, formats={"run_state": "json"}, withdraw=RUN_TABLES)
    return run_id
