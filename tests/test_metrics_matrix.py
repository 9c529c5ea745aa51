import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.operators import matrix as X
from tabreg.operators import metrics as M


def test_metrics_zero_target_and_constant(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0)], "pred double, actual double")
    r = M.regression_metrics(df).first()
    assert r["r2"] == 0.0
    assert r["mape"] == pytest.approx(1.5e8 * 100)
    g = M.mae_grade(M.regression_metrics(df)).first()
    assert g["mae_pct"] == 0.0 and g["grade"] == "Excellent"


def test_metrics_values(spark):
    p = np.array([1.0, 2.0, 3.5, 4.0])
    t = np.array([1.5, 2.0, 3.0, 5.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(p, t)], "pred double, actual double")
    r = M.regression_metrics(df).first()
    e = t - p
    assert r["mae"] == pytest.approx(np.abs(e).mean())
    assert r["rmse"] == pytest.approx(np.sqrt((e ** 2).mean()))
    assert r["r2"] == pytest.approx(1 - (e ** 2).sum() / ((t - t.mean()) ** 2).sum())
    assert r["pred_std"] == pytest.approx(p.std(ddof=1))


def test_epoch_loss_mean_of_batch_means(spark):
    rows = [(float(i), 0.0, i // 4) for i in range(10)]   # batches 4, 4, 2
    df = spark.createDataFrame(rows, "p double, t double, batch int")
    got = M.epoch_loss(df, "p", "t").first()[0]
    assert got == pytest.approx(np.mean([1.5, 5.5, 8.5]))


def test_linear_transform_paths_agree(spark):
    rng = np.random.default_rng(0)
    W, b = rng.normal(size=(3, 2)), rng.normal(size=2)
    data = rng.normal(size=(50, 3))
    df = spark.createDataFrame([tuple(map(float, r)) + (i,) for i, r in enumerate(data)], "a double, b double, c double, i int")
    for method in ("native", "arrow"):
        out = X.linear_transform(df, ["a", "b", "c"], W, b, keep=["i"], method=method).orderBy("i").collect()
        got = np.array([[r["out_0"], r["out_1"]] for r in out])
        assert np.allclose(got, data @ W + b)


def test_gram_and_transpose(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(40, 4))
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(data)], "id long, v array<double>").repartition(3)
    g = {(r["i"], r["j"]): r["value"] for r in X.gram(df, array_col="v").collect()}
    G = data.T @ data
    assert all(abs(g[(i, j)] - G[i, j]) < 1e-9 for i in range(4) for j in range(4))
    t = X.transpose(df, "id", array_col="v").collect()
    assert len(t) == 160 and all(abs(r["value"] - data[r["j"], r["i"]]) < 1e-12 for r in t)


def test_weight_and_bias_gradient(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.5), (3.0, -1.0, 1.5)], "x0 double, x1 double, g double")
    w = {(r["i"], r["j"]): r["value"] for r in X.weight_gradient(df, ["x0", "x1"], ["g"]).collect()}
    assert w[(0, 0)] == pytest.approx((1 * 0.5 + 3 * 1.5) / 2)
    assert w[(1, 0)] == pytest.approx((2 * 0.5 - 1 * 1.5) / 2)
    b = X.bias_gradient(df, ["g"]).first()["value"]
    assert b == pytest.approx(1.0)


def test_null_and_ragged_arrays(spark):
    from tabreg.operators.model import MLP, mlp_score
    rows = [(1, [1.0, 2.0]), (2, None), (3, [None, 4.0])]
    df = spark.createDataFrame(rows, "id int, x array<double>").coalesce(1)
    net = MLP.create((2, 3, 1), "relu", seed=1)
    got = {r["id"]: r["pred"] for r in mlp_score(df, net, array_col="x", keep=["id"], method="arrow").collect()}
    flat = spark.createDataFrame([(1, 1.0, 2.0), (2, 0.0, 0.0), (3, 0.0, 4.0)], "id int, a double, b double")
    want = {r["id"]: r["pred"] for r in mlp_score(flat, net, ["a", "b"], keep=["id"], method="native").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    ragged = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id int, x array<double>").coalesce(1)
    with pytest.raises(Exception, match="different lengths"):
        mlp_score(ragged, net, array_col="x", keep=["id"], method="arrow").collect()


def test_infinities_agree(spark):
    from tabreg.operators.model import MLP, mlp_score
    net = MLP((1, 1, 1), "relu", [(np.array([[2.0]]), np.zeros(1)), (np.array([[1.0]]), np.zeros(1))])
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.0,), (None,)], "a double")
    for method in ("native", "arrow"):
        got = sorted(r["pred"] for r in mlp_score(df, net, ["a"], method=method).collect())
        assert got == [0.0, 0.0, 2.0, float("inf")], method


def test_metrics_drop_pairs_with_a_null(spark):
    from tabreg.operators import metrics as M
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (None, 9.0), (4.0, None)], "pred double, actual double")
    full = M.regression_metrics(df).first()
    clean = M.regression_metrics(df.dropna()).first()
    assert full == clean and full["n"] == 2


def test_block_matmul_of_two_large_tables(spark, monkeypatch):
    """A product that no driver or task holds whole: tiles of 4, both sides above the small-matrix limit."""
    rng = np.random.default_rng(5)
    A, B = (np.where(rng.random(s) < 0.4, rng.normal(size=s), 0.0) for s in ((23, 17), (17, 31)))
    coords = lambda m: [(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))]
    left = coords(A) + [(0, 0, 1.5), (0, 0, None), (None, 3, 9.0)]              # a repeated cell, a null, no row
    A[0, 0] += 1.5
    a, b = (spark.createDataFrame(r, "i long, j int, value double") for r in (left, coords(B)))
    monkeypatch.setattr(X, "MAX_SMALL_CELLS", 10)
    out = X.block_matmul(a, b, tile=4)
    got = np.zeros((23, 31))
    for r in out.collect():
        got[r["i"], r["j"]] += r["value"]
    assert np.allclose(got, A @ B, atol=1e-12)
    assert X.block_matmul(a.limit(0), b, tile=4).collect() == []
    with pytest.raises(ValueError, match="block_matmul"):
        X.collect_small_matrix(b, ["i", "j"], "i")


def test_nulls_follow_one_rule(spark):
    from tabreg.operators import metrics as M
    df = spark.createDataFrame([(0, 1.0, 2.0), (0, None, 9.0), (0, 3.0, 0.0), (1, 5.0, None), (2, 4.0, 8.0)],
                               "batch int, p double, t double")
    assert {r["batch"]: r["batch_loss"] for r in M.batch_losses(df, "p", "t").collect()} == {1: 2.0, 2: None, 3: 4.0}
    assert M.epoch_loss(df, "p", "t").first()["epoch_loss"] == 3.0
    assert abs(M.regression_metrics(df, "p", "t").first()["mae"] - 8 / 3) < 1e-12
