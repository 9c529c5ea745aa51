import numpy as np
import pytest

import __spark_entry__ as E
from tabreg.plans import housing as H
from tabreg.plans import workflow as W

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 6000
    assert df.columns == H.FEATURES + [H.TARGET]


def test_every_query_has_a_callable_and_sql_names_match():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 80


def test_scans_are_pruned(spark):
    plan = H.housing_like(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "p_name" not in plan and "l_shipdate" not in plan and "c_mktsegment" not in plan


def test_rust_flavour_learns_synthetic_target(spark):
    p, res = W.rust_flavour(spark, SF, epochs=2, synthetic=True)
    assert p.n_train == 4800 and p.n_test == 1200
    assert len(res.batch_losses) == 20
    assert res.history[1]["loss"] < res.history[0]["loss"]
    assert res.model.n_params == 2689 and np.isfinite(res.model.flat()).all()


def test_python_flavour_end_to_end(spark):
    p, res = W.python_flavour(spark, SF, epochs=3, lr=1e-2, patience=2, synthetic=True)
    assert p.n_train == 4800
    assert [h["epoch"] for h in res.history] == [1, 2, 3]
    assert all(h["val_loss"] is not None for h in res.history)
    assert res.history[-1]["val_loss"] < res.history[0]["val_loss"]
    assert len(res.batch_losses) == 30       # max(16, ceil(3840/10)) = 384 -> 10 batches/epoch


def test_grid_search_one_row_per_setting(spark):
    grid = [(2, *rest) for _, *rest in W.C.REFERENCE_GRID]
    out = W.grid_search(spark, SF, grid).orderBy("cfg").collect()
    assert [r["lr"] for r in out] == [0.001, 0.01, 0.0005, 0.005]
    assert all(r["epochs_run"] == 2 and r["n"] == 1200 for r in out)
    assert {r["grade"] for r in out} <= {"Excellent", "Good", "Acceptable", "Poor"}


def test_entry_loads_by_file_path(spark):
    import importlib.util
    import os
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("entry_by_path", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert mod.entry(spark).columns == H.FEATURES + [H.TARGET]


def test_registered_training_runs_have_the_reference_epochs(spark, monkeypatch):
    class Seen(Exception):
        pass

    def fit(train, models, configs, **_):
        raise Seen([(c.epochs, c.lr, c.patience) for c in configs])
    monkeypatch.setattr(W.T, "fit", fit)
    for name, settings in (("train_mlp_python", [(200, 0.01, 2)]),
                           ("grid_search", [(200, 0.001, 20), (200, 0.01, 20), (300, 0.0005, 30), (150, 0.005, 15)])):
        with pytest.raises(Seen) as seen:
            E.queries()[name](spark, SF)
        assert seen.value.args[0] == settings


def test_rows_that_are_kept_are_not_laid_out_again(spark, monkeypatch):
    """30M rows: training packs them, so the feature table is read as it was written, in one piece of work less."""
    monkeypatch.setattr(W.H, "table_rows", lambda spark, d, name: 30_000_000 if name == "lineitem" else 1)
    p = W.prepare(spark, SF)
    assert not [f for f in p.train.inputFiles() if "/prepared-" in f]
    monkeypatch.setattr(W, "CACHE_ROWS", 100)
    assert [f for f in W.prepare(spark, SF).train.inputFiles() if "/prepared-" in f]


def test_long_tables_train_on_packed_rows(spark, monkeypatch):
    class Seen(Exception):
        pass

    def fit(train, models, configs, *, cache, **_):
        raise Seen(cache)
    monkeypatch.setattr(W.T, "fit", fit)
    monkeypatch.setattr(W, "python_setup", lambda *a, **k: (None, None, None, 2_400_000, 24_000_000))
    with pytest.raises(Seen) as seen:
        W.python_flavour(spark, SF)
    assert seen.value.args[0] is True
