"""Registered queries for matrix operators, network scoring/training and
run-level folds. Importing this module registers them in ``catalog``."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import matrix as X
from ..operators import metrics as M
from ..operators import recovery
from ..operators import runs as RU
from ..operators import scale as S
from ..operators import train as T
from ..operators.model import MLP, mlp_gradient, mlp_score
from ..operators.registry import commit_run, read_table, stage_table
from ..session import shared_path
from . import housing as H
from . import workflow as W
from .catalog import FEATS, HOUSING_CTE, TGT, _r, query, rnd, rnd_all

# ------------------------------------------------------------- matrices

LT_W = np.array([[0.5, -1.0, 0.25], [2.0, 0.1, -0.3]])
LT_B = np.array([0.1, 0.2, 0.3])


def _lt_sql() -> str:
    outs = []
    for j in range(3):
        e = f"{float(LT_B[j])!r} + p_size * {float(LT_W[0, j])!r} + (p_retailprice / 1000.0) * {float(LT_W[1, j])!r}"
        outs.append(f"{_r(e, 8)} AS out_{j}")
    return f"SELECT p_partkey, {', '.join(outs)} FROM part"


def _lt(spark, d, method):
    p = H.read(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("a"),
                                        (F.col("p_retailprice") / 1000.0).alias("b"))
    out = X.linear_transform(p, ["a", "b"], LT_W, LT_B, keep=["p_partkey"], method=method)
    return rnd_all(out, 8)


@query("linear_transform", _lt_sql())
def q_linear_transform(spark, d):
    return _lt(spark, d, "native")


@query("linear_transform_arrow", _lt_sql())
def q_linear_transform_arrow(spark, d):
    return _lt(spark, d, "arrow")


_LI_XG = """g AS (SELECT l_quantity / 50.0 AS x0, l_discount AS x1, l_tax AS x2,
  l_extendedprice / 100000.0 - 0.5 AS g0, l_discount - l_tax AS g1, l_orderkey, l_linenumber FROM lineitem)"""


def _li_xg(spark, d):
    li = H.read(spark, d, "lineitem")
    return li.select((F.col("l_quantity") / 50.0).alias("x0"), F.col("l_discount").alias("x1"),
                     F.col("l_tax").alias("x2"), (F.col("l_extendedprice") / 100000.0 - 0.5).alias("g0"),
                     (F.col("l_discount") - F.col("l_tax")).alias("g1"), "l_orderkey", "l_linenumber")


@query("weight_gradient", f"WITH {_LI_XG}\n" + "\nUNION ALL\n".join(
    f"SELECT {i} AS i, {j} AS j, {_r(f'sum(x{i} * g{j}) / count(*)', 10)} AS value FROM g"
    for i in range(3) for j in range(2)))
def q_weight_gradient(spark, d):
    w = X.weight_gradient(_li_xg(spark, d), ["x0", "x1", "x2"], ["g0", "g1"])
    return w.select(F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"), rnd("value", 10).alias("value"))


@query("bias_gradient", f"WITH {_LI_XG}\n" + "\nUNION ALL\n".join(
    f"SELECT {j} AS j, {_r(f'avg(g{j})', 10)} AS value FROM g" for j in range(2)))
def q_bias_gradient(spark, d):
    b = X.bias_gradient(_li_xg(spark, d), ["g0", "g1"])
    return b.select(F.col("j").cast("int").alias("j"), rnd("value", 10).alias("value"))


IG_W = np.array([[0.5, -1.0], [0.25, 2.0], [0.1, -0.3]])


@query("input_gradient", f"WITH {_LI_XG}\nSELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{_r(f'g0 * {float(IG_W[i, 0])!r} + g1 * {float(IG_W[i, 1])!r}', 10)} AS {n}"
    for i, n in enumerate(["l_quantity", "l_discount", "l_tax"])) + " FROM g")
def q_input_gradient(spark, d):
    out = X.input_gradient(_li_xg(spark, d), ["g0", "g1"], IG_W, ["l_quantity", "l_discount", "l_tax"],
                           keep=["l_orderkey", "l_linenumber"])
    return rnd_all(out, 10)


_EMB_LONG = """e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v,
                     unnest(generate_series(0, len(embedding) - 1)) AS k FROM embeddings)"""


@query("matmul", f"""WITH {_EMB_LONG}
SELECT CAST(a.k AS INTEGER) AS i, CAST(b.k AS INTEGER) AS j, {_r('sum(a.v * b.v)', 8)} AS value
FROM e a JOIN e b ON a.vec_id = b.vec_id GROUP BY a.k, b.k""")
def q_matmul(spark, d):
    """Gram matrix XᵀX = matmul(transpose(X), X) of the embeddings."""
    g = X.gram(H.read(spark, d, "embeddings"), array_col="embedding")
    return g.select("i", "j", rnd("value", 8).alias("value"))


@query("matmul_blocks", f"""WITH {_EMB_LONG}
SELECT CAST(a.k AS BIGINT) AS i, CAST(b.k AS BIGINT) AS j, {_r('sum(a.v * b.v)', 6)} AS value
FROM e a JOIN e b ON a.vec_id = b.vec_id GROUP BY a.k, b.k HAVING sum(a.v * b.v) <> 0""")
def q_matmul_blocks(spark, d):
    """Xᵀ · X with both as block matrices: the inner side is the table's row count."""
    x = X.to_coordinates(H.read(spark, d, "embeddings"), "vec_id", array_col="embedding")
    xt = x.select(F.col("j").alias("i"), F.col("i").alias("j"), "value")
    return X.block_matmul(xt, x).select("i", "j", rnd("value", 6).alias("value"))


@query("matmul_table", f"""WITH {_EMB_LONG},
g AS (SELECT a.k AS i, b.k AS j, sum(a.v * b.v) / (SELECT count(*) FROM embeddings) AS gv
      FROM e a JOIN e b ON a.vec_id = b.vec_id GROUP BY a.k, b.k)
SELECT e.vec_id, CAST(g.j AS INTEGER) AS j, {_r('sum(e.v * g.gv)', 6)} AS value
FROM e JOIN g ON e.k = g.i GROUP BY e.vec_id, g.j""")
def q_matmul_table(spark, d):
    """X · (XᵀX / n): a tall table times a schema-width matrix derived from it."""
    em = H.read(spark, d, "embeddings")
    n = em.count()
    dim = len(em.select("embedding").first()["embedding"])
    g = X.gram(em, array_col="embedding").withColumn("value", F.col("value") / F.lit(float(n)))
    B = X.pivot_small(g, dim)
    A = em.select("vec_id", *[F.col("embedding")[k].cast("double").alias(f"e_{k}") for k in range(dim)])
    C = X.matmul(A, [f"e_{k}" for k in range(dim)], B, [f"col_{k}" for k in range(dim)], "i",
                 keep=["vec_id"], prefix="col_")
    arr = F.array(*[F.struct(F.lit(k).alias("j"), F.col(f"col_{k}").alias("value")) for k in range(dim)])
    return C.select("vec_id", F.inline(arr)).select("vec_id", "j", rnd("value", 6).alias("value"))


@query("transpose", """
SELECT CAST(k AS BIGINT) AS i, CAST(r AS BIGINT) AS j, round(v, 8) + 0.0 AS value FROM (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, CAST(unnest(embedding) AS DOUBLE) AS v,
         unnest(generate_series(0, len(embedding) - 1)) AS k FROM embeddings)""")
def q_transpose(spark, d):
    t = X.transpose(H.read(spark, d, "embeddings"), "vec_id", array_col="embedding")
    return t.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"),
                    rnd("value", 8).alias("value"))


# -------------------------------------------------------------- scoring

# Fixed 2-2-1 network; the hidden biases are chosen so that no input of the
# (quantity/50, discount*10) grid lands exactly on a ReLU kink, where the
# derivative flips with the engines' different summation orders.
SMALL = MLP([2, 2, 1], "relu", [(np.array([[0.5, -0.4], [0.3, 0.8]]), np.array([0.1, -0.2137])),
                                (np.array([[1.5], [-0.7]]), np.array([0.05]))])


def _small_sql() -> str:
    (W1, b1), (W2, b2) = SMALL.params
    h = [f"greatest({float(b1[j])!r} + x0 * {float(W1[0, j])!r} + x1 * {float(W1[1, j])!r}, 0.0)" for j in range(2)]
    out = f"{float(b2[0])!r} + ({h[0]}) * {float(W2[0, 0])!r} + ({h[1]}) * {float(W2[1, 0])!r}"
    return (f"SELECT l_orderkey, l_linenumber, {_r(out, 8)} AS pred FROM "
            f"(SELECT l_orderkey, l_linenumber, l_quantity / 50.0 AS x0, l_discount * 10.0 AS x1 FROM lineitem)")


def _small(spark, d, method):
    li = H.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber",
                                             (F.col("l_quantity") / 50.0).alias("x0"),
                                             (F.col("l_discount") * 10.0).alias("x1"))
    return rnd_all(mlp_score(li, SMALL, ["x0", "x1"], keep=["l_orderkey", "l_linenumber"], method=method), 8)


@query("mlp_score", _small_sql())
def q_mlp_score(spark, d):
    return _small(spark, d, "native")


@query("mlp_score_arrow", _small_sql())
def q_mlp_score_arrow(spark, d):
    return _small(spark, d, "arrow")


def _small_grad_sql() -> str:
    (W1, b1), (W2, b2) = SMALL.params
    f = lambda v: repr(float(v))
    z = [f"{f(b1[j])} + x0 * {f(W1[0, j])} + x1 * {f(W1[1, j])}" for j in range(2)]
    base = (f"SELECT x0, x1, t, z0, z1, greatest(z0, 0.0) AS h0, greatest(z1, 0.0) AS h1 FROM ("
            f"SELECT x0, x1, t, {z[0]} AS z0, {z[1]} AS z1 FROM ("
            f"SELECT l_quantity / 50.0 AS x0, l_discount * 10.0 AS x1, l_extendedprice / 100000.0 AS t FROM lineitem))")
    o = f"SELECT *, {f(b2[0])} + h0 * {f(W2[0, 0])} + h1 * {f(W2[1, 0])} AS o FROM ({base})"
    s_ = "SELECT *, sign(o - t) AS s FROM (" + o + ")"
    g = (f"SELECT *, CASE WHEN z0 > 0 THEN s * {f(W2[0, 0])} ELSE 0.0 END AS g0, "
         f"CASE WHEN z1 > 0 THEN s * {f(W2[1, 0])} ELSE 0.0 END AS g1 FROM ({s_})")
    parts = []
    for i in range(2):
        for j in range(2):
            parts.append(f"SELECT 0 AS layer, 'weight' AS kind, {i} AS i, {j} AS j, avg(g{j} * x{i}) AS value FROM q")
    for j in range(2):
        parts.append(f"SELECT 0, 'bias', 0, {j}, avg(g{j}) FROM q")
    for j in range(2):
        parts.append(f"SELECT 1, 'weight', {j}, 0, avg(s * h{j}) FROM q")
    parts.append("SELECT 1, 'bias', 0, 0, avg(s) FROM q")
    parts.append("SELECT -1, 'loss', 0, 0, avg(abs(o - t)) FROM q")
    sep = chr(10) + "UNION ALL" + chr(10)
    return ("WITH q AS (" + g + ") SELECT CAST(layer AS INTEGER) AS layer, kind, CAST(i AS INTEGER) AS i, "
            "CAST(j AS INTEGER) AS j, round(value, 10) + 0.0 AS value FROM (" + sep.join(parts) + ")")


@query("mlp_gradient_small", _small_grad_sql())
def q_mlp_gradient_small(spark, d):
    """Exact mean MAE gradient of the fixed 2-2-1 network over every lineitem
    row: Arrow partial sums per partition, reduced once."""
    li = H.read(spark, d, "lineitem").select(
        F.array((F.col("l_quantity") / 50.0), (F.col("l_discount") * 10.0)).alias("x"),
        (F.col("l_extendedprice") / 100000.0).alias("y"))
    g = mlp_gradient(li, SMALL)
    return g.select("layer", "kind", "i", "j", rnd("value", 10).alias("value"))


HOUSING_NET = MLP.create((8, 64, 32, 1), "relu", "xavier_normal", seed=42)


def _net_sql(model: MLP) -> str:
    (W1, b1), (W2, b2), (W3, b3) = model.params
    st = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_samp({c}) > 1e-8 THEN stddev_samp({c}) ELSE 1.0 END AS s_{c}"
                   for c in FEATS)
    z = ", ".join(f"({c} - m_{c}) / s_{c} AS z{i}" for i, c in enumerate(FEATS))
    h1 = ", ".join("greatest(" + repr(float(b1[j])) + "".join(
        f" + z{i} * {float(W1[i, j])!r}" for i in range(8)) + f", 0.0) AS a{j}" for j in range(64))
    h2 = ", ".join("greatest(" + repr(float(b2[k])) + "".join(
        f" + a{j} * {float(W2[j, k])!r}" for j in range(64)) + f", 0.0) AS c{k}" for k in range(32))
    out = repr(float(b3[0])) + "".join(f" + c{k} * {float(W3[k, 0])!r}" for k in range(32))
    return (f"WITH {HOUSING_CTE},\nst AS (SELECT {st} FROM h),\n"
            f"z AS (SELECT {z}, l_extendedprice AS actual FROM h, st),\n"
            f"h1 AS (SELECT {h1}, actual FROM z),\n"
            f"h2 AS (SELECT {h2}, actual FROM h1)\n"
            f"SELECT {_r(out, 6)} AS pred, {_r('actual', 6)} AS actual FROM h2")


@query("mlp_score_housing", _net_sql(HOUSING_NET))
def q_mlp_score_housing(spark, d):
    """The reference network (8-64-32-1, ReLU, seeded Xavier-normal) scoring
    every standard-scaled housing_like row through Arrow batches."""
    df = H.housing_table(spark, d)
    m = S.StandardScaler(FEATS, ddof=1).fit(df)
    sc = m.transform(df)
    out = mlp_score(sc, HOUSING_NET, FEATS, keep=[TGT], method="arrow")
    return out.select(rnd("pred", 6).alias("pred"), rnd(TGT, 6).alias("actual"))


# ------------------------------------------------------- training jobs

@query("mlp_gradient")
def q_mlp_gradient(spark, d):
    """Mean MAE gradient of all 2,689 parameters over the scaled housing_like
    training split (plus the loss row)."""
    p = W.prepare(spark, d, ddof=1)
    return mlp_gradient(p.train, MLP.create((8, 64, 32, 1), "relu", "xavier_normal", 42))


_RUNS: dict = {}


def _rust_run(spark, d):
    """One training run per (application, table folder), shared by the
    run-table queries (history, batch losses, evaluation, persistence)."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _RUNS:
        _RUNS[key] = W.rust_flavour(spark, d, synthetic=True)   # a target that features explain
    return _RUNS[key]


@query("train_mlp")
def q_train_mlp(spark, d):
    """The reference binary's defaults: one epoch, ceil(n/10) positional
    batches, SGD lr 0.01; returns the training history."""
    _, res = _rust_run(spark, d)
    return RU.history_table(spark, res, "rust").select("epoch", "loss", "learning_rate")


@query("train_mlp_python")
def q_train_mlp_python(spark, d):
    """The Python trainer with its test's settings (200 epochs, lr 1e-2, 20%
    validation, patience 2, reduce-on-plateau): patience ends the run."""
    _, res = W.python_flavour(spark, d, lr=1e-2, val_split=0.2, patience=2, synthetic=True)
    return RU.history_table(spark, res, "python")


@query("train_mlp_resumed")
def q_train_mlp_resumed(spark, d):
    """A run of six epochs over all rows, stopped after three and called again:
    its progress as committed, each epoch once."""
    at = recovery.Checkpoint(shared_path(spark, "checkpoints"), "resumed", every=3)
    for epochs in (3, 6):
        W.python_flavour(spark, d, epochs=epochs, lr=1e-2, val_split=0.2, patience=20, optimizer="adam", synthetic=True, checkpoint=at)
    return recovery.progress(spark, at.root, at.run_id).select("run_id", "epoch", "loss", "val_loss", "learning_rate")


@query("training_history")
def q_training_history(spark, d):
    """The run's history table (run_id, epoch from 1, loss, val_loss,
    learning_rate) as written by save_run."""
    _, res = _rust_run(spark, d)
    return RU.history_table(spark, res, "rust")


def _net_table(spark, d):
    """Standard-scaled housing_like rows as (x, y), for the seeded network."""
    df = H.housing_table(spark, d)
    scaled = S.StandardScaler(FEATS, ddof=1).fit(df).transform(df)
    return T.prepare_table(scaled, FEATS, TGT)


def _net_rows_sql() -> str:
    """The seeded network's unrounded predictions as a CTE named p."""
    body = _net_sql(HOUSING_NET)
    cte, _, last = body.rpartition("\nSELECT ")
    return f"{cte},\np AS (SELECT {last.split(' AS pred')[0].removeprefix('round(').rpartition(', 6)')[0]} AS pred, actual FROM h2)"


@query("run_predictions", f"""{_net_rows_sql()}
SELECT {_r('pred', 6)} AS out_0, {_r('actual', 6)} AS actual, {_r('pred - actual', 6)} AS residual FROM p""")
def q_run_predictions(spark, d):
    """Predictions table of a network: out_0, actual, residual (one scoring scan)."""
    preds = T.score_many(_net_table(spark, d), [HOUSING_NET], keep=("y",))
    return rnd_all(M.predictions_table(preds, "pred", "y"), 6)


@query("run_batch_losses")
def q_run_batch_losses(spark, d):
    _, res = _rust_run(spark, d)
    return RU.batch_losses_table(spark, res, "rust")


_MAE_PCT = "CASE WHEN target_std > 0 THEN mae / target_std * 100 ELSE 0.0 END"


@query("evaluate_model", f"""{_net_rows_sql()},
m AS (SELECT avg(abs(actual - pred)) AS mae, avg((actual - pred) * (actual - pred)) AS mse,
        sum((actual - pred) * (actual - pred)) AS res, var_pop(actual) * count(*) AS tot,
        avg(abs(actual - pred) / greatest(abs(actual), 1e-8)) * 100 AS mape, stddev_samp(pred) AS pred_std,
        stddev_samp(actual) AS target_std, count(*) AS n FROM p),
g AS (SELECT *, {_MAE_PCT} AS mae_pct FROM m)
SELECT {_r('mae', 4)} AS mae, {_r('mse', 0)} AS mse, {_r('sqrt(mse)', 4)} AS rmse,
       {_r('CASE WHEN tot > 0 THEN 1 - res / tot ELSE 0.0 END', 6)} AS r2, {_r('mape', 4)} AS mape, {_r('pred_std', 6)} AS pred_std,
       {_r('target_std', 4)} AS target_std, n, {_r('mae_pct', 6)} AS mae_pct,
       CASE WHEN mae_pct < 30 THEN 'Excellent' WHEN mae_pct < 50 THEN 'Good' WHEN mae_pct < 70 THEN 'Acceptable' ELSE 'Poor' END AS grade,
       CASE WHEN mae < 0.5 THEN 'good' WHEN mae <= 0.8 THEN 'acceptable' ELSE 'poor' END AS mae_band
FROM g""")
def q_evaluate_model(spark, d):
    """Metrics and grade of the seeded network over every row: one scan, one aggregate."""
    m = T.evaluate_models(_net_table(spark, d), [HOUSING_NET]).drop("cfg")
    digits = {"mae": 4, "mse": 0, "rmse": 4, "mape": 4, "target_std": 4}
    return m.select(*[rnd(c, digits.get(c, 6)).alias(c) if t == "double" else F.col(c) for c, t in m.dtypes])


@query("save_load_model")
def q_save_load_model(spark, d):
    """Trained parameters written to the shared run folder and read back."""
    _, res = _rust_run(spark, d)
    path = shared_path(spark, "models")
    RU.save_model(spark, res.model, path, "rust")
    back = RU.load_model(spark, path, "rust")
    return RU.params_table(spark, back, "rust")


@query("verify_roundtrip", f"""{_net_rows_sql()}
SELECT {_r('avg(abs(actual - pred))', 4)} AS mae_before, {_r('avg(abs(actual - pred))', 4)} AS mae_after,
       CAST(0.0 AS DOUBLE) AS mae_diff, TRUE AS verified FROM p""")
def q_verify_roundtrip(spark, d):
    """|ΔMAE| over all rows between a network and its saved and reloaded copy."""
    path = shared_path(spark, "models")
    RU.save_model(spark, HOUSING_NET, path, "rt")
    back = RU.load_model(spark, path, "rt")
    ev = T.evaluate_models(_net_table(spark, d), [HOUSING_NET, back])
    mae = [F.max(F.when(F.col("cfg") == c, F.col("mae"))) for c in (0, 1)]
    out = ev.agg(mae[0].alias("mae_before"), mae[1].alias("mae_after"))
    diff = F.abs(F.col("mae_before") - F.col("mae_after"))
    return out.select(rnd("mae_before", 4).alias("mae_before"), rnd("mae_after", 4).alias("mae_after"),
                      rnd(diff, 6).alias("mae_diff"), (diff < 1e-6).alias("verified"))


@query("grid_search")
def q_grid_search(spark, d):
    """The reference's four sweep settings (lr, patience), trained together:
    every step is one scan that computes all four gradients; one metrics row
    per setting. Epochs are the settings' own (200/200/300/150), ended by patience."""
    return W.grid_search(spark, d, synthetic=True)


@query("optimizer_state")
def q_optimizer_state(spark, d):
    _, res = _rust_run(spark, d)
    return RU.optimizer_table(spark, res.config, "rust")


@query("run_state")
def q_run_state(spark, d):
    p, res = _rust_run(spark, d)
    m = T.evaluate_models(p.test, [res.model]).first().asDict()
    return RU.run_state(spark, "rust", res, m, features=FEATS, target=TGT,
                        feature_scaling="standard", target_scaling=None,
                        batch_size=res.config.batch_size)


@query("save_run", f"""WITH {HOUSING_CTE},
n AS (SELECT count(*) AS n FROM h)
SELECT * FROM (VALUES ('batch_losses', CAST(10 AS BIGINT)), ('optimizer_state', 1), ('parameters', {HOUSING_NET.n_params}),
  ('run_state', 1), ('scaling_params', {3 * len(FEATS)}), ('training_history', 1)) AS t(table_name, n_rows)
UNION ALL SELECT 'predictions', n - CAST(floor(0.8 * n) AS BIGINT) FROM n""")
def q_save_run(spark, d):
    """Every table of one run written to the shared run registry and read back: parameters, optimizer, scaling,
    history, batch losses, predictions of the test split, and the nested run state; a row count for each."""
    p, res = _rust_run(spark, d)
    root = shared_path(spark, "runs")
    preds = T.score_many(p.test, [res.model], keep=("key", "y"))
    preds = M.predictions_table(preds, "pred", "y", keep=["key"])
    metrics = T.evaluate_models(p.test, [res.model]).first().asDict()
    state = RU.run_state(spark, "rust", res, metrics, features=FEATS, target="y_syn", feature_scaling="standard",
                         target_scaling=None, batch_size=res.config.batch_size)
    RU.save_run(spark, root, "rust", res, predictions=preds, scaler_params=S.params_table(spark, p.feature_model), state=state)
    out = None
    for name in ("batch_losses", "optimizer_state", "parameters", "predictions", "run_state", "scaling_params", "training_history"):
        t = read_table(spark, root, name, "rust", schema=state.schema if name == "run_state" else None)
        n = t.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = n if out is None else out.unionByName(n)
    return out


@query("run_registry", f"""{_net_rows_sql()},
e AS (SELECT CASE event_type WHEN 'view' THEN 'seen' ELSE event_type END AS run_id, CAST(ts AS DATE) AS day, avg(value) AS loss
      FROM events GROUP BY ALL)
SELECT run_id, 'training_history' AS table_name, CAST(row_number() OVER (PARTITION BY run_id ORDER BY day) AS BIGINT) AS row_id,
       {_r('loss', 8)} AS value FROM e
UNION ALL SELECT 'net', 'predictions', CAST({_r('actual', 0)} AS BIGINT), {_r('pred', 6)} FROM p""")
def q_run_registry(spark, d):
    """Runs committed to the registry and read back, value by value: a loss curve for each kind of event, and a
    network's predictions over all rows. Every run is committed twice, wrong rows first; an attempt that is
    written but not published, as by a driver lost in between, changes nothing."""
    root = shared_path(spark, "registry")
    day = F.to_date("ts")
    kind = F.when(F.col("event_type") == "view", "seen").otherwise(F.col("event_type"))
    curve = H.read(spark, d, "events").groupBy(kind.alias("run"), day.alias("day")).agg(F.avg("value").alias("loss"))
    order = Window.partitionBy("run").orderBy("day")
    curve = curve.select("run", F.row_number().over(order).cast("long").alias("epoch"), "loss").persist()
    preds = T.score_many(_net_table(spark, d), [HOUSING_NET], keep=("y",)).select("y", "pred")
    for wrong in (True, False):
        for r in sorted(x[0] for x in curve.select("run").distinct().collect()):       # one run for each kind
            own = curve.filter(F.col("run") == r).drop("run")
            commit_run(spark, root, r, {"training_history": own.withColumn("loss", F.lit(-1.0)) if wrong else own})
    commit_run(spark, root, "net", {"predictions": preds.limit(3), "training_history": curve.limit(3)})
    commit_run(spark, root, "net", {"predictions": preds}, withdraw=RU.RUN_TABLES)
    stage_table(preds.limit(5), root, "predictions", "net", "lost")
    curve.unpersist()
    history = read_table(spark, root, "training_history").select(
        "run_id", F.lit("training_history").alias("table_name"), F.col("epoch").alias("row_id"), rnd("loss", 8).alias("value"))
    scored = read_table(spark, root, "predictions", "net").select(
        "run_id", F.lit("predictions").alias("table_name"), F.round("y", 0).cast("long").alias("row_id"), rnd("pred", 6).alias("value"))
    return history.unionByName(scored)


# ------------------------------------------------------ run-level folds

_CURVE_CTE = """c AS (
  SELECT CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS epoch, loss, coalesce(v, loss) AS val_loss
  FROM (SELECT CAST(ts AS DATE) AS day, avg(value) AS loss,
               avg(CASE WHEN event_type = 'view' THEN value END) AS v
        FROM events GROUP BY CAST(ts AS DATE)))"""


def _curve(spark, d):
    return H.loss_curve(spark, d).withColumn("run_id", F.lit("events"))


@query("history_thin", f"""WITH {_CURVE_CTE}
SELECT epoch, {_r('loss', 8)} AS loss FROM c WHERE (epoch - 1) % 20 = 0 OR epoch = (SELECT max(epoch) FROM c)""")
def q_history_thin(spark, d):
    from ..operators.project import history_thin
    return history_thin(_curve(spark, d), 20, by="run_id").select("epoch", rnd("loss", 8).alias("loss"))


@query("model_summary", f"""WITH {_CURVE_CTE}
SELECT 'events' AS run_id, CAST(count(*) AS BIGINT) AS total_epochs, {_r('arg_max(loss, epoch)', 8)} AS final_loss,
       {_r('min(loss)', 8)} AS min_loss, {_r('avg(loss)', 8)} AS mean_loss FROM c""")
def q_model_summary(spark, d):
    s, _ = RU.model_summary(_curve(spark, d))
    return rnd_all(s, 8)


def _es_windows_sql(patience: int) -> str:
    return f"""WITH {_CURVE_CTE},
i AS (SELECT epoch, val_loss,
        CASE WHEN val_loss < coalesce(min(val_loss) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                                      CAST('inf' AS DOUBLE)) THEN 1 ELSE 0 END AS imp FROM c),
l AS (SELECT epoch, val_loss, max(CASE WHEN imp = 1 THEN epoch END) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_imp FROM i),
s AS (SELECT coalesce(min(CASE WHEN epoch - last_imp >= {patience} THEN epoch END), max(epoch)) AS stop_epoch,
             min(CASE WHEN epoch - last_imp >= {patience} THEN epoch END) IS NOT NULL AS stopped_early FROM l)
SELECT 'events' AS run_id, CAST(l.last_imp AS INTEGER) AS best_epoch,
       {_r('(SELECT val_loss FROM c WHERE c.epoch = l.last_imp)', 8)} AS best_val,
       CAST(s.stop_epoch AS INTEGER) AS stop_epoch, s.stopped_early
FROM s JOIN l ON l.epoch = s.stop_epoch"""


def _es_recursive_sql(patience: int, min_delta: float) -> str:
    return f"""WITH RECURSIVE {_CURVE_CTE},
r(epoch, best, wait, best_epoch, done, stop) AS (
  SELECT epoch, val_loss, 0, epoch, false, CAST(NULL AS INTEGER) FROM c WHERE epoch = 1
  UNION ALL
  SELECT c.epoch,
         CASE WHEN c.val_loss + {min_delta!r} < r.best THEN c.val_loss ELSE r.best END,
         CASE WHEN c.val_loss + {min_delta!r} < r.best THEN 0 ELSE r.wait + 1 END,
         CASE WHEN c.val_loss + {min_delta!r} < r.best THEN c.epoch ELSE r.best_epoch END,
         (CASE WHEN c.val_loss + {min_delta!r} < r.best THEN 0 ELSE r.wait + 1 END) >= {patience},
         CASE WHEN (CASE WHEN c.val_loss + {min_delta!r} < r.best THEN 0 ELSE r.wait + 1 END) >= {patience}
              THEN c.epoch END
  FROM r JOIN c ON c.epoch = r.epoch + 1 WHERE NOT r.done)
SELECT 'events' AS run_id, CAST(best_epoch AS INTEGER) AS best_epoch, {_r('best', 8)} AS best_val,
       CAST(coalesce(stop, (SELECT max(epoch) FROM c)) AS INTEGER) AS stop_epoch, done AS stopped_early
FROM r WHERE epoch = (SELECT max(epoch) FROM r)"""


@query("early_stopping", _es_windows_sql(5))
def q_early_stopping(spark, d):
    es = RU.early_stopping(_curve(spark, d), patience=5, min_delta=0.0)
    return es.select("run_id", "best_epoch", rnd("best_val", 8).alias("best_val"), "stop_epoch", "stopped_early")


@query("early_stopping_delta", _es_recursive_sql(3, 0.05))
def q_early_stopping_delta(spark, d):
    es = RU.early_stopping(_curve(spark, d), patience=3, min_delta=0.05)
    return es.select("run_id", "best_epoch", rnd("best_val", 8).alias("best_val"), "stop_epoch", "stopped_early")


@query("plateau_lr", f"""WITH RECURSIVE {_CURVE_CTE},
r(epoch, lr_used, best, bad, lr_after) AS (
  SELECT epoch, CAST(0.01 AS DOUBLE), val_loss, 0, CAST(0.01 AS DOUBLE) FROM c WHERE epoch = 1
  UNION ALL
  SELECT c.epoch, r.lr_after,
         CASE WHEN c.val_loss < r.best * (1.0 - 1e-4) THEN c.val_loss ELSE r.best END,
         CASE WHEN c.val_loss < r.best * (1.0 - 1e-4) THEN 0
              WHEN r.bad + 1 > 5 THEN 0 ELSE r.bad + 1 END,
         CASE WHEN NOT (c.val_loss < r.best * (1.0 - 1e-4)) AND r.bad + 1 > 5
                   AND r.lr_after - greatest(r.lr_after * 0.5, 0.0) > 1e-8
              THEN greatest(r.lr_after * 0.5, 0.0) ELSE r.lr_after END
  FROM r JOIN c ON c.epoch = r.epoch + 1)
SELECT 'events' AS run_id, CAST(epoch AS INTEGER) AS epoch, round(lr_used, 12) + 0.0 AS learning_rate FROM r""")
def q_plateau_lr(spark, d):
    """Reduce-on-plateau (factor 0.5, patience 5, relative threshold 1e-4)
    replayed over a loss curve."""
    s = RU.plateau_schedule(_curve(spark, d), 0.01, factor=0.5, patience=5)
    return s.select("run_id", "epoch", rnd("learning_rate", 12).alias("learning_rate"))


# a run for each user, and one long run of a third of all events; a run's epochs are its events
_RUNS_CTE = """e AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS run_id, CAST(event_id AS INTEGER) AS epoch, value AS val_loss FROM events),
i AS (SELECT *, row_number() OVER w AS k,
        CASE WHEN val_loss < coalesce(min(val_loss) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST('inf' AS DOUBLE))
             THEN 1 ELSE 0 END AS imp
      FROM e WINDOW w AS (PARTITION BY run_id ORDER BY epoch)),
l AS (SELECT *, max(CASE WHEN imp = 1 THEN k ELSE 0 END) OVER (PARTITION BY run_id ORDER BY epoch) AS last_imp FROM i)"""


def _event_runs(spark, d):
    run = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).cast("long")
    return H.read(spark, d, "events").select(run.alias("run_id"), F.col("event_id").cast("int").alias("epoch"),
                                             F.col("value").alias("val_loss"))


@query("early_stopping_runs", f"""WITH {_RUNS_CTE},
s AS (SELECT run_id, min(CASE WHEN k - last_imp >= 20 THEN k END) AS stop, max(k) AS last FROM l GROUP BY run_id)
SELECT l.run_id, CAST(b.epoch AS INTEGER) AS best_epoch, {_r('b.val_loss', 8)} AS best_val, CAST(l.epoch AS INTEGER) AS stop_epoch,
       s.stop IS NOT NULL AS stopped_early
FROM s JOIN l ON l.run_id = s.run_id AND l.k = coalesce(s.stop, s.last)
JOIN l AS b ON b.run_id = l.run_id AND b.k = l.last_imp""")
def q_early_stopping_runs(spark, d):
    """Early stopping (patience 20) of a run for each user and one hot, long run."""
    es = RU.early_stopping(_event_runs(spark, d), patience=20)
    return es.select("run_id", "best_epoch", rnd("best_val", 8).alias("best_val"), "stop_epoch", "stopped_early")


@query("plateau_lr_runs", f"""WITH {_RUNS_CTE},
c AS (SELECT run_id, epoch, coalesce(sum(CASE WHEN imp = 0 AND (k - last_imp) % 6 = 0 THEN 1 ELSE 0 END) OVER
        (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cuts FROM l)
SELECT run_id, epoch, round(0.01 * pow(0.5, least(cuts, 19)), 12) + 0.0 AS learning_rate FROM c""")
def q_plateau_lr_runs(spark, d):
    """Learning rate at every epoch of those runs (patience 5, any improvement counts):
    halved until a cut would be below 1e-8, that is 19 times."""
    s = RU.plateau_schedule(_event_runs(spark, d), 0.01, factor=0.5, patience=5, threshold=0.0)
    return s.select("run_id", "epoch", rnd("learning_rate", 12).alias("learning_rate"))


@query("run_timestamp", """
SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS utc_time
FROM events""")
def q_run_timestamp(spark, d):
    ev = H.read(spark, d, "events")
    return ev.select("event_id", RU.run_id_expr(F.col("ts")).alias("run_id"),
                     RU.utc_string_expr(F.col("ts")).alias("utc_time"))
