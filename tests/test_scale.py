import math

import pytest
from pyspark.sql import functions as F

from tabreg.operators import scale as S


def frame(spark, vals):
    return spark.createDataFrame([(v,) for v in vals], "x double")


def col(df, c="x"):
    return [r[c] for r in df.collect()]


def test_one_row_std_undefined_is_one(spark):
    m = S.StandardScaler(["x"], ddof=1).fit(frame(spark, [5.0]))
    assert m.means == (5.0,) and m.stds == (1.0,)


def test_constant_column(spark):
    df = frame(spark, [3.0, 3.0, 3.0])
    m = S.StandardScaler(["x"]).fit(df)
    assert m.stds == (1.0,)
    assert col(m.transform(df)) == [0.0, 0.0, 0.0]
    mm = S.MinMaxScaler(["x"]).fit(df)
    assert col(mm.transform(df)) == [0.5, 0.5, 0.5]


def test_constant_with_null_minmax_fills_every_cell(spark):
    df = frame(spark, [3.0, None, 3.0])
    mm = S.MinMaxScaler(["x"]).fit(df)
    assert col(mm.transform(df)) == [0.5, 0.5, 0.5]


def test_nulls_stay_null(spark):
    df = frame(spark, [1.0, None, 3.0])
    out = col(S.StandardScaler(["x"]).fit(df).transform(df))
    assert out[1] is None and out[0] == pytest.approx(-1 / math.sqrt(2))
    out = col(S.MinMaxScaler(["x"]).fit(df).transform(df))
    assert out == [0.0, None, 1.0]


def test_all_null_fallbacks(spark):
    df = frame(spark, [None, None])
    m = S.StandardScaler(["x"]).fit(df)
    assert m.means == (0.0,) and m.stds == (1.0,)
    mm = S.MinMaxScaler(["x"]).fit(df)
    assert mm.mins == (0.0,) and mm.maxs == (1.0,)


def test_ddof_and_inverse(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0])
    m0 = S.StandardScaler(["x"], ddof=0).fit(df)
    m1 = S.StandardScaler(["x"], ddof=1).fit(df)
    assert m0.stds[0] == pytest.approx(math.sqrt(1.25))
    assert m1.stds[0] == pytest.approx(math.sqrt(5 / 3))
    back = col(m1.inverse(m1.transform(df)))
    assert back == pytest.approx([1.0, 2.0, 3.0, 4.0])


def test_empty_frame_aggregates_are_fallbacks(spark):
    df = spark.createDataFrame([], "x double")
    m = S.StandardScaler(["x"]).fit(df)
    assert m.means == (0.0,) and m.stds == (1.0,)


def test_params_roundtrip(spark):
    df = frame(spark, [1.0, 2.0, 4.0])
    m = S.StandardScaler(["x"], ddof=0).fit(df)
    back = S.model_from_params(S.params_table(spark, m), "standard")
    assert back == m
    mm = S.MinMaxScaler(["x"]).fit(df)
    assert S.model_from_params(S.params_table(spark, mm), "minmax") == mm


def test_preprocess_one_aggregate_one_select(spark):
    df = spark.createDataFrame([(1.0, 10.0, 5.0), (2.0, 20.0, 7.0), (3.0, 30.0, 9.0)], "a double, b double, y double")
    out, fm, tm = S.preprocess(df, ["a", "b"], "y", ddof=0, scale_target=True)
    rows = out.collect()
    assert [r["y"] for r in rows] == pytest.approx([-1.224744871, 0.0, 1.224744871])
    assert out.columns == ["a", "b", "y"]
    with pytest.raises(ValueError):
        S.preprocess(df, ["a", "y"], "y")


def test_unfitted_column_missing_raises(spark):
    df = frame(spark, [1.0, 2.0])
    m = S.StandardScaler(["x"]).fit(df)
    with pytest.raises(ValueError):
        m.transform(df.select(F.col("x").alias("z")))


def test_target_scaler_of_any_kind(spark):
    from tabreg.operators import scale as SC
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(10)], "a double, t double")
    out, fm, tm = SC.preprocess(df, ["a"], "t", scaler="standard", target_scaler="minmax")
    vals = [r["t"] for r in out.collect()]
    assert (fm.kind, tm.kind) == ("standard", "minmax") and (min(vals), max(vals)) == (0.0, 1.0)
    own, _, model = SC.preprocess(df, ["a"], "t", target_scaler=lambda cols: SC.StandardScaler(cols, 0))
    assert model.ddof == 0 and abs(sum(r["t"] for r in own.collect())) < 1e-9


def test_robust_scaler_quartiles_params_and_inverse(spark):
    import numpy as np
    rng = np.random.RandomState(3)
    vals = [float(v) for v in np.round(rng.standard_cauchy(501), 2)]
    rows = [(v, None if i % 3 else float(i % 5), 2.0, None) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "`x.y` double, b double, same double, none double")
    df = df.withColumnRenamed("x.y", "x_y").repartition(5)
    cols = ["x_y", "b", "same", "none"]
    m = S.make_scaler("robust", cols).fit(df)
    for i, c in enumerate(cols[:2]):
        own = [r[i] for r in rows if r[i] is not None]
        q1, q2, q3 = np.quantile(own, [0.25, 0.5, 0.75])
        assert m.medians[i] == pytest.approx(q2) and m.iqrs[i] == pytest.approx(q3 - q1)
    assert (m.medians[2:], m.iqrs[2:]) == ((2.0, 0.0), (1.0, 1.0))
    assert S.model_from_params(S.params_table(spark, m), "robust") == m
    assert S.model_from_params(S.params_from_fit(df, S.RobustScaler(cols)), "robust") == m
    t = {r["column"]: (r["median"], r["iqr"]) for r in S.fit_table(df, S.RobustScaler(cols)).collect()}
    assert t["same"] == (2.0, 1.0)
    back = m.inverse(m.transform(df)).select("x_y").collect()
    assert sorted(r[0] for r in back) == pytest.approx(sorted(vals))
    assert m.transform(df).filter("none is not null").count() == 0
    assert S.RobustScaler(["x_y"]).fit(df.limit(0)).medians == (0.0,)


def test_registered_scaler_of_ones_own(spark):
    from dataclasses import dataclass

    @dataclass(frozen=True)
    class MaxAbsModel:
        columns: tuple
        tops: tuple
        kind = "maxabs"

        def expr(self, c, src=None):
            return (F.col(c) if src is None else src) / F.lit(self.tops[self.columns.index(c)])

        def stats(self):
            return [(c, {"top": t}) for c, t in zip(self.columns, self.tops)]

    class MaxAbs(S._Fitted):
        kind, names = "maxabs", ("top",)

        def fit_exprs(self):
            return [F.max(F.abs(F.col(c))).alias(f"{c}__top") for c in self.columns]

    S.register_scaler("maxabs", lambda cols, ddof: MaxAbs(cols), lambda cols, st: MaxAbsModel(cols, tuple(st[c]["top"] for c in cols)))
    try:
        df = spark.createDataFrame([(-4.0, 1.0), (2.0, 3.0)], "a double, y double")
        out, fm, tm = S.preprocess(df, ["a"], "y", scaler="maxabs", target_scaler="robust")
        assert sorted(r["a"] for r in out.collect()) == [-1.0, 0.5]
        assert (fm.tops, tm.medians, tm.iqrs) == ((4.0,), (2.0,), (1.0,))
        assert S.model_from_params(S.params_table(spark, fm, tm), "maxabs") == fm
        assert S.fit_table(df, S.make_scaler("maxabs", ["a"])).first()["top"] == 4.0
    finally:
        del S._KINDS["maxabs"]
    with pytest.raises(ValueError):
        S.make_scaler("maxabs", ["a"])
