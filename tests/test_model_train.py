import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.operators import model as MD
from tabreg.operators import runs as RU
from tabreg.operators import train as T


def synthetic(spark, n=64, seed=123):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 8))
    y = 0.5 * (X[:, 0] + X[:, 1])
    rows = [([float(v) for v in X[i]], float(y[i]), i) for i in range(n)]
    return spark.createDataFrame(rows, "x array<double>, y double, key long"), X, y


def test_gradient_matches_finite_differences():
    rng = np.random.default_rng(3)
    m = MD.MLP.create((3, 5, 4, 1), "tanh", "xavier_normal", seed=5)
    X = rng.normal(size=(20, 3))
    y = rng.normal(size=(20, 1))
    g, _ = MD.grad_np(m.params, m.activation, X, y)
    w = m.flat()

    def loss(v):
        mm = m.with_flat(v)
        return np.abs(MD.forward_np(mm.params, mm.activation, X) - y).sum()
    eps = 1e-6
    num = np.array([(loss(w + eps * e) - loss(w - eps * e)) / (2 * eps) for e in np.eye(len(w))])
    assert np.allclose(g, num, atol=1e-4)


def test_distributed_gradient_equals_numpy(spark):
    df, X, y = synthetic(spark)
    m = MD.MLP.create((8, 64, 32, 1), seed=1)
    ((g, loss, n),) = MD.collect_gradients(MD.gradient_job(df.repartition(4), [m]), [m])
    want, wl = MD.grad_np(m.params, "relu", X, y.reshape(-1, 1))
    assert n == 64 and np.allclose(g, want / 64) and loss == pytest.approx(wl / 64)
    assert m.n_params == 2689


def test_score_arrow_native_numpy_agree(spark):
    df, X, _ = synthetic(spark, 30)
    m = MD.MLP.create((8, 4, 1), "relu", seed=2)
    a = MD.mlp_score(df, m, array_col="x", keep=["key"]).orderBy("key").collect()
    cols = df.select("key", *[F.col("x")[i].alias(f"f{i}") for i in range(8)])
    b = MD.mlp_score(cols, m, [f"f{i}" for i in range(8)], keep=["key"], method="native").orderBy("key").collect()
    want = MD.forward_np(m.params, "relu", X)[:, 0]
    assert np.allclose([r["pred"] for r in a], want) and np.allclose([r["pred"] for r in b], want)


def test_default_epochs_is_200():
    assert T.TrainConfig().epochs == 200
    assert inspect.signature(T.TrainConfig).parameters["epochs"].default == 200


def test_training_learns_and_stops_early(spark):
    df, _, _ = synthetic(spark, 64)
    tr = df.where("key >= 13")
    va = df.where("key < 13").withColumn("vbatch", F.lit(0))
    m = MD.MLP.create((8, 64, 32, 1), seed=123)
    cfg = T.TrainConfig(epochs=200, lr=1e-2, patience=2, batch_size=16, seed=123)
    (res,) = T.fit(tr, [m], [cfg], val=va)
    assert not np.allclose(res.model.flat(), m.flat())
    assert res.stop_epoch < 200
    assert res.history[0]["val_loss"] > min(h["val_loss"] for h in res.history)


def test_unknown_optimizer():
    with pytest.raises(ValueError):
        T.TrainConfig(optimizer="rmsprop")


def test_adam_and_momentum_step():
    c = T.TrainConfig(optimizer="adam", lr=0.1)
    o = T.Optimizer(c, 2)
    w = o.step(np.array([1.0, -1.0]), np.array([0.5, -2.0]), 0.1)
    assert np.allclose(w, [0.9, -0.9])
    c2 = T.TrainConfig(momentum=0.9, weight_decay=0.1)
    o2 = T.Optimizer(c2, 1)
    w1 = o2.step(np.array([1.0]), np.array([1.0]), 0.1)
    w2 = o2.step(w1, np.array([1.0]), 0.1)
    assert np.allclose(w1, [1 - 0.1 * 1.1])
    g2 = 1.0 + 0.1 * w1[0]
    assert np.allclose(w2, w1 - 0.1 * (0.9 * 1.1 + g2))


def test_save_load_roundtrip(spark, tmp_path):
    m = MD.MLP.create((8, 64, 32, 1), seed=9)
    path = str(tmp_path / "models")
    RU.save_model(spark, m, path, "m1")
    back = RU.load_model(spark, path, "m1")
    X = np.random.default_rng(0).normal(size=(4, 8))
    out = MD.forward_np(back.params, back.activation, X)
    assert out.shape == (4, 1)
    assert np.allclose(out, MD.forward_np(m.params, m.activation, X))


def _es_loop(vals, patience, min_delta):
    best, wait, be = float("inf"), 0, None
    for e, v in enumerate(vals, 1):
        if v + min_delta < best:
            best, wait, be = v, 0, e
        else:
            wait += 1
            if wait >= patience:
                return be, best, e, True
    return be, best, len(vals), False


@pytest.mark.parametrize("patience,min_delta", [(2, 0.0), (3, 0.0), (2, 0.05), (4, 0.2)])
def test_early_stopping_fold_equals_loop(spark, patience, min_delta):
    vals = [1.0, 0.9, 0.95, 0.85, 0.84, 0.86, 0.9, 0.7, 0.71, 0.72, 0.73, 0.74]
    h = spark.createDataFrame([("r", i + 1, v) for i, v in enumerate(vals)], "run_id string, epoch int, val_loss double")
    r = RU.early_stopping(h, patience, min_delta).first()
    assert (r["best_epoch"], r["best_val"], r["stop_epoch"], r["stopped_early"]) == _es_loop(vals, patience, min_delta)


def test_plateau_fold_equals_class(spark):
    vals = [1.0, 0.9, 0.95, 0.95, 0.95, 0.95, 0.95, 0.95, 0.95, 0.8, 0.8, 0.8, 0.8, 0.8, 0.8, 0.8]
    h = spark.createDataFrame([("r", i + 1, v) for i, v in enumerate(vals)], "run_id string, epoch int, val_loss double")
    got = [r["learning_rate"] for r in RU.plateau_schedule(h, 0.1, patience=5).orderBy("epoch").collect()]
    p = T.Plateau(0.1, patience=5)
    want = []
    for v in vals:
        want.append(p.lr)
        p.step(v)
    assert got == pytest.approx(want) and min(got) < 0.1


def test_grid_configs_share_scans_but_train_independently(spark):
    df, _, _ = synthetic(spark, 96, seed=4)
    tr = df.where("key >= 20")
    va = df.where("key < 20").withColumn("vbatch", F.lit(0))
    base = MD.MLP.create((8, 16, 1), seed=7)
    c1 = T.TrainConfig(epochs=4, lr=0.01, patience=3, batch_size=25, seed=11)
    c2 = T.TrainConfig(epochs=3, lr=0.003, patience=3, batch_size=25, seed=11, optimizer="adam")
    together = T.fit(tr, [base, base], [c1, c2], val=va)
    alone1 = T.fit(tr, [base], [c1], val=va)[0]
    alone2 = T.fit(tr, [base], [c2], val=va)[0]
    assert np.allclose(together[0].model.flat(), alone1.model.flat())
    assert np.allclose(together[1].model.flat(), alone2.model.flat())
    assert len(together[1].history) == 3 and len(together[0].history) == 4


def test_shuffled_batches_are_exact_and_change_per_epoch(spark):
    from tabreg.operators.rows import permuted_batch
    df = spark.range(1000).select(F.col("id").alias("key"))
    sizes, members = [], []
    for ep in (1, 2):
        rows = df.select("key", permuted_batch("key", 1000, 128, 5, ep).alias("b"))
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
        per = [set() for _ in range(8)]
        for r in rows.collect():
            per[r["b"]].add(r["key"])
        sizes.append([len(p) for p in per])
        members.append(per[0])
    assert sizes[0] == [128] * 7 + [104] and sizes[1] == sizes[0]
    assert len(members[0] & members[1]) < 40


@pytest.mark.parametrize("shuffle", [True, False])
def test_blocks_equal_queries_over_the_table(spark, shuffle):
    rng = np.random.default_rng(3)
    rows = [([float(v) for v in x], float(x[0] - x[1]) if i % 7 else None, i, i // 40) for i, x in enumerate(rng.normal(size=(231, 8)))]
    df = spark.createDataFrame(rows, "x array<double>, y double, key long, batch int").repartition(3)
    val = df.where("key % 5 = 0").selectExpr("x", "y", "cast(key % 3 as int) as vbatch")
    huber = lambda d, tie: (np.where(abs(d) < 1, d * d / 2, abs(d) - 0.5), np.clip(d, -1, 1))
    cfgs = [T.TrainConfig(epochs=6, lr=0.05, batch_size=40, patience=2, min_delta=0.02, shuffle=shuffle, seed=4),
            T.TrainConfig(epochs=4, lr=0.01, batch_size=40, optimizer="adam", loss=huber, shuffle=shuffle, seed=4),
            T.TrainConfig(epochs=3, lr=0.01, batch_size=40, momentum=0.9, weight_decay=0.01, loss="mse", shuffle=shuffle, seed=4)]
    nets = [MD.MLP.create((8, 6, 1), seed=i) for i in range(3)]
    one, many = (T.fit(df, nets, cfgs, val=val, mode=m) for m in ("blocks", "jobs"))
    for a, b in zip(one, many):
        assert np.allclose(a.model.flat(), b.model.flat(), atol=1e-9)
        assert (a.best_epoch, a.stop_epoch, len(a.batch_losses)) == (b.best_epoch, b.stop_epoch, len(b.batch_losses))
        for x, y in zip(a.history, b.history):
            assert x == pytest.approx(y)
        assert [x["batch_loss"] for x in a.batch_losses] == pytest.approx([x["batch_loss"] for x in b.batch_losses])
    assert one[0].config.loss == "mae" and one[1].config.loss is huber


def test_blocks_need_rows_that_fit(spark, monkeypatch):
    df, _, _ = synthetic(spark, 64)
    cfg = T.TrainConfig(epochs=1, batch_size=32, patience=None)
    monkeypatch.setattr(T, "BLOCK_ROWS_MIN", 4)                     # more blocks than rows in some
    (small,) = T.fit(df, [MD.MLP.create((8, 4, 1), seed=1)], [cfg], mode="blocks")
    monkeypatch.setattr(T, "DRIVER_SUM_PARTITIONS", 1)              # sums below the driver
    (tree,) = T.fit(df, [MD.MLP.create((8, 4, 1), seed=1)], [cfg], mode="blocks")
    monkeypatch.setattr(T, "BLOCK_ROWS", 3)
    with pytest.raises(ValueError, match="do not fit"):
        T.fit(df, [MD.MLP.create((8, 4, 1), seed=1)], [cfg], mode="blocks")
    (res,) = T.fit(df, [MD.MLP.create((8, 4, 1), seed=1)], [cfg])      # a query for each step
    assert len(res.batch_losses) == 2
    assert np.allclose(res.model.flat(), small.model.flat(), atol=1e-9) and np.allclose(tree.model.flat(), small.model.flat(), atol=1e-9)


def test_layer_stack_length():
    assert len(MD.MLP.create((10, 20, 1))) == 2
    assert len(MD.MLP([10], "relu", [])) == 0
    assert len(MD.MLP.create()) == 3 and MD.MLP.create().n_params == 8 * 64 + 64 + 64 * 32 + 32 + 32 + 1


@pytest.mark.parametrize("rule", ["xavier_normal", "xavier_uniform", "kaiming_normal", "kaiming_uniform",
                                  "normal", "uniform"])
def test_init_rules_scale_and_bias(rule):
    m = MD.MLP.create((400, 300, 1), init=rule, seed=1)
    W, b = m.params[0]
    want = {"xavier_normal": np.sqrt(2 / 700), "xavier_uniform": np.sqrt(6 / 700) / np.sqrt(3),
            "kaiming_normal": np.sqrt(2 / 400), "kaiming_uniform": np.sqrt(6 / 400) / np.sqrt(3),
            "normal": 1.0, "uniform": 2 / np.sqrt(12)}[rule]
    assert W.std() == pytest.approx(want, rel=0.02)
    assert np.all(b == {"normal": 0.0, "uniform": -1.0}.get(rule, 0.0))
    assert len(set(np.round(W[:, 0], 12))) > 1   # units do not start identical


def test_mixed_losses_equal_separate_runs(spark):
    """Configs in one fit keep their own loss and tie; a user's loss works in the workers and in validation."""
    from tabreg.operators import model as MO
    from tabreg.operators import train as TR
    rng = np.random.default_rng(0)
    rows = [([float(a), float(b)], float(a - 2 * b), i, i % 2, i % 3) for i, (a, b) in enumerate(rng.normal(size=(60, 2)))]
    df = spark.createDataFrame(rows, "x array<double>, y double, key long, batch int, vbatch int")
    huber = lambda d, tie: (np.where(abs(d) < 1, d * d / 2, abs(d) - 0.5), np.clip(d, -1, 1))
    cfgs = [TR.TrainConfig(epochs=2, lr=0.05, batch_size=30, shuffle=False, loss=f, name=str(k))
            for k, f in enumerate(("mae", "mse", huber))]
    nets = [MO.MLP.create((2, 4, 1), seed=3) for _ in cfgs]
    val = df.select("x", "y", "vbatch")
    together = TR.fit(df, nets, cfgs, val=val)
    for net, cfg, res in zip(nets, cfgs, together):
        (alone,) = TR.fit(df, [net], [cfg], val=val)
        assert np.allclose(alone.model.flat(), res.model.flat(), atol=1e-12)
        assert [h["val_loss"] for h in alone.history] == pytest.approx([h["val_loss"] for h in res.history])
    assert not np.allclose(together[0].model.flat(), together[1].model.flat())
    with pytest.raises(ValueError, match="unknown loss"):
        MO.loss_function("nope")


def test_epoch_directories_equal_the_cached_table(spark):
    """The path for tables too large to cache: the same batches, each read from its own directory."""
    from tabreg.operators import model as MO
    from tabreg.operators import train as TR
    rng = np.random.default_rng(2)
    rows = [([float(a), float(b)], float(a + b), i) for i, (a, b) in enumerate(rng.normal(size=(50, 2)))]
    df = spark.createDataFrame(rows, "x array<double>, y double, key long")
    val = df.where("key < 10").selectExpr("x", "y", "cast(key % 2 as int) as vbatch")
    cfg = TR.TrainConfig(epochs=2, lr=0.05, batch_size=16, shuffle=True, seed=9)
    a, b = (TR.fit(df, [MO.MLP.create((2, 3, 1), seed=1)], [cfg], val=val, cache=c, mode="jobs")[0] for c in (True, False))
    assert np.allclose(a.model.flat(), b.model.flat(), atol=1e-12)
    assert [x["batch_loss"] for x in a.batch_losses] == pytest.approx([x["batch_loss"] for x in b.batch_losses])
    part = TR._epoch_table(df, 9, 1, 50, 16).where("batch_no = 2")
    assert part.count() == 16 and "PartitionFilters: [isnotnull(batch_no" in part._jdf.queryExecution().toString()


def test_large_run_paths_equal_the_small_ones(spark, monkeypatch):
    """Lowered limits: block directories, no cache and shuffled joins give the same model."""
    from tabreg.plans import workflow as WF
    sf = "/root/testdata/sf0.001"
    _, small = WF.rust_flavour(spark, sf, synthetic=True)
    monkeypatch.setattr(WF, "CACHE_ROWS", 100)
    monkeypatch.setattr(WF, "POS_BLOCK_MIN", 1000)
    _, large = WF.rust_flavour(spark, sf, synthetic=True)
    assert np.allclose(small.model.flat(), large.model.flat(), atol=1e-9)


def test_folds_stream_many_runs(spark, monkeypatch):
    monkeypatch.setattr(RU, "REPLAY_ROWS", 7)
    rows = [(f"r{i % 3}" if i % 3 else None, i, float(40 - i if i < 30 else 50)) for i in range(60)]
    rows += [("nulls", None, 1.0), ("nulls", 1, None), ("nulls", 2, float("nan")), ("nulls", 3, 2.0)]
    h = spark.createDataFrame(rows, "run_id string, epoch int, val_loss double").repartition(5)
    got = {r["run_id"]: tuple(r)[1:] for r in RU.early_stopping(h, 4).collect()}
    assert got == {None: (27, 13.0, 39, True), "r1": (28, 12.0, 40, True), "r2": (29, 11.0, 41, True),
                   "nulls": (None, 1.0, 3, False)}
    lr = RU.plateau_schedule(h, 1.0, patience=2)
    assert lr.count() == 64
    assert [r["learning_rate"] for r in lr.filter("run_id = 'r1'").orderBy("epoch").collect()] == [1.0] * 13 + [0.5] * 3 + [0.25] * 3 + [0.125]
    empty = h.filter("1 = 0")
    assert RU.early_stopping(empty, 4).count() == 0 and RU.plateau_schedule(empty, 1.0).columns == ["run_id", "epoch", "learning_rate"]
    plan = RU.early_stopping(h, 4)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and plan.count("hashpartitioning") == 1


@pytest.mark.parametrize("shuffle", [True, False])
def test_rows_packed_where_they_stand_equal_rows_dealt_out(spark, monkeypatch, shuffle):
    """Many blocks in a partition, packed without a shuffle; fixed batches that lie in few partitions are dealt out."""
    rng = np.random.default_rng(5)
    rows = [([float(v) for v in x], float(x[0] - x[1]), i, i // 40) for i, x in enumerate(rng.normal(size=(160, 8)))]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), "x array<double>, y double, key long, batch int")
    val = df.where("key % 5 = 0").selectExpr("x", "y", "cast(key % 3 as int) as vbatch")
    cfg = T.TrainConfig(epochs=2, lr=0.05, batch_size=40, patience=None, shuffle=shuffle, seed=4)
    net = MD.MLP.create((8, 6, 1), seed=1)
    (jobs,) = T.fit(df, [net], [cfg], val=val, mode="jobs")
    packed, plans = T._packed, []

    def seen(src, tasks, parts):
        plans.append(parts)
        return packed(src, tasks, parts)
    monkeypatch.setattr(T, "_packed", seen)
    monkeypatch.setattr(T, "BLOCK_ROWS_MIN", 40)
    monkeypatch.setattr(T, "PACK_ROWS", 7)
    (blocks,) = T.fit(df, [net], [cfg], val=val, mode="blocks")
    assert plans == ([None, None] if shuffle else [None, 4, None])
    assert np.allclose(blocks.model.flat(), jobs.model.flat(), atol=1e-9)
    assert [b["batch_loss"] for b in blocks.batch_losses] == pytest.approx([b["batch_loss"] for b in jobs.batch_losses])
    assert [h["val_loss"] for h in blocks.history] == pytest.approx([h["val_loss"] for h in jobs.history])


def test_a_task_packs_its_rows_in_bounded_blocks(monkeypatch):
    import pickle

    import pyarrow as pa
    monkeypatch.setattr(T, "PACK_ROWS", 10)

    def batch(at, n):
        ids = range(at, at + n)
        return pa.RecordBatch.from_arrays([pa.array([[float(i)] for i in ids]), pa.array([float(i) for i in ids]), pa.array(list(ids), pa.int64()),
                                           pa.array([-1 if i % 4 else 0 for i in ids], pa.int64())], names=["x", "y", "_p", "_v"])
    got = [pickle.loads(b.column(0)[0].as_py()) for b in T._pack([batch(0, 7), batch(7, 0), batch(7, 5), batch(12, 23)])]
    sizes = [len(b[0]) + len(b[3]) for b in got]
    assert max(sizes) <= 10 and sum(sizes) == 35
    assert sorted(v for b in got for v in b[1][:, 0].tolist() + b[4].tolist()) == [float(i) for i in range(35)]
    assert sorted(v for b in got for v in b[2].tolist()) == [i for i in range(35) if i % 4]


def test_gradients_take_rows_in_chunks_that_fit_a_cache(monkeypatch):
    rng = np.random.default_rng(1)
    X, y = rng.normal(size=(5000, 8)), rng.normal(size=(5000, 1))
    m = MD.MLP.create((8, 6, 1), seed=2)
    seen, act = [], MD._act
    monkeypatch.setattr(MD, "_act", lambda z, name: seen.append(len(z)) or act(z, name))
    got = MD.grad_np(m.params, "relu", X, y)
    assert sum(seen) == 5000 and max(seen) <= MD.CHUNK_ROWS
    monkeypatch.setattr(MD, "CHUNK_ROWS", 10_000)
    want = MD.grad_np(m.params, "relu", X, y)
    assert np.allclose(got[0], want[0], atol=1e-9) and got[1] == pytest.approx(want[1])
    none = MD.grad_np(m.params, "relu", X[:0], y[:0])
    assert not none[0].any() and none[1] == 0.0


def test_a_chunk_of_rows_stays_in_a_core_s_cache():
    sizes = (64, 32, 1)
    assert MD.CHUNK_ROWS * sum(sizes) * 8 <= 512 << 10          # activations; as much for the gradients
    rng = np.random.default_rng(1)
    X, y = rng.normal(size=(1500, 8)), rng.normal(size=(1500, 1))
    for act in MD.ACTS:
        m = MD.MLP.create((8, 5, 4, 1), act, seed=2)
        (W1, b1), (W2, b2), (W3, b3) = m.params
        f = {"relu": lambda z: np.maximum(z, 0), "sigmoid": lambda z: 1 / (1 + np.exp(-z)), "tanh": np.tanh, "identity": lambda z: z}[act]
        d = {"relu": lambda a: a > 0, "sigmoid": lambda a: a * (1 - a), "tanh": lambda a: 1 - a * a, "identity": np.ones_like}[act]
        a1 = f(X @ W1 + b1)
        a2 = f(a1 @ W2 + b2)
        g3 = 2 * (a2 @ W3 + b3 - y)
        g2 = g3 @ W3.T * d(a2)
        g1 = g2 @ W2.T * d(a1)
        want = np.concatenate([v.ravel() for a, g in ((X, g1), (a1, g2), (a2, g3)) for v in (a.T @ g, g.sum(axis=0))])
        kept = X.copy()
        assert np.allclose(MD.grad_np(m.params, act, X, y, loss="mse")[0], want) and np.array_equal(X, kept)
    z = np.array([np.nan, np.inf, -np.inf, -1.0, 2.0])
    assert MD._act(z, "relu").tolist() == [0.0, np.inf, 0.0, 0.0, 2.0]
