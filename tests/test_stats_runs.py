import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.operators import project as P
from tabreg.operators import registry as RG
from tabreg.operators import runs as RU
from tabreg.operators import scale as S
from tabreg.operators import stats as ST
from tabreg.plans import workflow as W


def test_dataset_statistics_matches_numpy(spark):
    rng = np.random.default_rng(2)
    price = rng.integers(1, 50, 1001).astype(float)     # many ties
    inc, rooms = rng.normal(size=1001), rng.integers(0, 9, 1001).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(price, inc, rooms)],
                               "median_house_value double, median_income double, total_rooms double")
    r = ST.dataset_statistics(df).first()
    assert r["row_count"] == 1001
    assert r["median_price"] == np.median(price)
    assert r["mean_price"] == pytest.approx(price.mean())
    assert r["mean_income"] == pytest.approx(inc.mean())
    assert r["total_rooms_sum"] == rooms.sum()


def test_scaling_report_values(spark):
    df = spark.createDataFrame([(1.0, 10.0, 100.0), (3.0, 30.0, 300.0)], "a double, b double, y double")
    fm, tm = S.fit_many(df, [S.StandardScaler(["a", "b"], 0), S.StandardScaler(["y"], 0)])
    r = S.scaling_report(df, ["a", "b"], "y", fm, tm).first()
    assert r["feature_mean_before"] == pytest.approx(11.0)
    assert r["feature_mean_after"] == pytest.approx(0.0)
    assert (r["target_min_after"], r["target_max_after"]) == pytest.approx((-1.0, 1.0))
    assert (r["target_min_before"], r["target_max_before"]) == (100.0, 300.0)


def test_history_thin_and_summary(spark):
    h = spark.createDataFrame([("r", e, 1.0 / e, None, 0.01) for e in range(1, 46)],
                              "run_id string, epoch int, loss double, val_loss double, learning_rate double")
    assert sorted(r["epoch"] for r in P.history_thin(h, by="run_id").collect()) == [1, 21, 41, 45]
    assert sorted(r["epoch"] for r in P.history_thin(h).collect()) == [1, 21, 41, 45]
    s, thin = RU.model_summary(h)
    r = s.first()
    assert (r["total_epochs"], r["final_loss"], r["min_loss"]) == (45, pytest.approx(1 / 45), pytest.approx(1 / 45))
    assert thin.count() == 4


def test_processed_csv_split_is_positional(spark, tmp_path):
    raw = str(tmp_path / "raw.csv")
    cols = ["a", "b", "y"]
    spark.range(0, 100, 1, 3).select((F.col("id") * 1.0).alias("a"), (F.col("id") * 2.0).alias("b"),
                                     (F.col("id") * 3.0).alias("y")).write.option("header", True).csv(raw)
    W.process_and_save(spark, raw, str(tmp_path / "proc.csv"), cols[:2], "y")
    out = W.load_processed_split(spark, str(tmp_path / "proc.csv"), cols[:2], "y").collect()
    assert sum(1 for r in out if r["split"] == "train") == 80
    ys = sorted((r["row_pos"], r["y"]) for r in out)
    assert [y for _, y in ys] == [3.0 * i for i in range(100)]     # file order kept, target unscaled
    assert all(r["row_pos"] < 80 for r in out if r["split"] == "train")


def test_run_state_and_save_run(spark, tmp_path):
    from tabreg.operators.model import MLP
    from tabreg.operators.train import TrainConfig, TrainResult
    m = MLP.create((8, 4, 1), seed=0)
    res = TrainResult(TrainConfig(epochs=3, patience=None), m,
                      history=[{"epoch": e, "loss": 1.0 / e, "val_loss": None, "learning_rate": 0.01} for e in (1, 2, 3)],
                      batch_losses=[{"epoch": 1, "batch": 1, "batch_loss": 1.0}], stop_epoch=3, seconds=1.5)
    st = RU.run_state(spark, "r1", res, {"mae": 0.5, "mse": 0.4, "rmse": 0.63, "r2": 0.1},
                      features=[f"f{i}" for i in range(8)], target="y", feature_scaling="standard",
                      target_scaling=None, batch_size=10).first()
    assert st["architecture"]["total_parameters"] == m.n_params
    assert st["training_state"]["total_epochs"] == 3 and st["config"]["loss_function"] == "MAE"
    root = str(tmp_path / "runs")
    RU.save_run(spark, root, "r1", res)
    back = RG.read_table(spark, root, "training_history").orderBy("epoch").collect()
    assert [r["epoch"] for r in back] == [1, 2, 3] and back[0]["run_id"] == "r1"
    assert RU.load_model(spark, f"{root}/parameters", "r1").n_params == m.n_params


def test_a_run_saved_twice_is_one_run(spark, tmp_path):
    from tabreg.operators.model import MLP
    from tabreg.operators.train import TrainConfig, TrainResult
    root = str(tmp_path / "runs")

    def result(seed, epochs, batches=()):
        return TrainResult(TrainConfig(epochs=epochs, patience=None), MLP.create((2, 2, 1), seed=seed),
                           history=[{"epoch": e, "loss": seed + 1.0 / e, "val_loss": None, "learning_rate": 0.01} for e in range(1, epochs + 1)],
                           batch_losses=[{"epoch": 1, "batch": b, "batch_loss": 1.0} for b in batches], stop_epoch=epochs, seconds=1.0)
    first, second = result(1, 3, (1, 2)), result(2, 2)
    state = spark.createDataFrame([("r", 1)], "run_id string, x int")
    RU.save_run(spark, root, "r", first, state=state)
    RU.save_run(spark, root, "other/1", first)
    RU.save_run(spark, root, "r", second)
    h = RG.read_table(spark, root, "training_history", "r").collect()
    assert sorted((r["epoch"], r["loss"]) for r in h) == [(1, 3.0), (2, 2.5)]
    assert RG.read_table(spark, root, "training_history").count() == 5
    assert RG.read_table(spark, root, "parameters", "r").count() == second.model.n_params
    got = RU.load_model(spark, f"{root}/parameters", "r")
    assert all((a == b).all() for x, y in zip(got.params, second.model.params) for a, b in zip(x, y))
    for gone in ("batch_losses", "run_state"):           # the second save had none
        with pytest.raises(FileNotFoundError):
            RG.read_table(spark, root, gone, "r", schema=None)
    assert RG.read_table(spark, root, "run_state", "r", schema=state.schema).count() == 0


def test_a_failed_commit_leaves_what_was_there(spark, tmp_path):
    root = str(tmp_path / "runs")
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    with pytest.raises(FileNotFoundError):
        RG.read_table(spark, root, "a")
    assert RG.committed(spark, root).count() == 0
    fails = spark.createDataFrame([("x",)], "v string").select(F.expr("raise_error('lost')").cast("int").alias("v"))
    with pytest.raises(Exception, match="lost"):
        RG.commit_run(spark, root, "r", {"a": rows(0), "b": fails})
    with pytest.raises(FileNotFoundError):
        RG.read_table(spark, root, "a", "r")
    RG.commit_run(spark, root, "r", {"a": rows(1, 2), "b": rows(3)})
    with pytest.raises(Exception, match="lost"):
        RG.commit_run(spark, root, "r", {"a": rows(7, 8, 9), "b": fails})
    assert sorted(r["v"] for r in RG.read_table(spark, root, "a", "r").collect()) == [1, 2]
    assert [r["v"] for r in RG.read_table(spark, root, "b").collect()] == [3]
    RG.commit_run(spark, root, "r", {"a": rows(5)})       # only that table changes
    assert [[r["v"] for r in RG.read_table(spark, root, n, "r").collect()] for n in ("a", "b")] == [[5], [3]]
