import pytest
from pyspark.sql import functions as F

from tabreg.functions import elementwise as E
from tabreg.functions import losses as L


def vals(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "x double")


def test_relu_nan_and_null(spark):
    df = vals(spark, [-1.0, 0.0, float("nan"), 2.0, None])
    out = [r[0] for r in df.select(E.relu("x")).collect()]
    assert out == [0.0, 0.0, 0.0, 2.0, 0.0]
    d = [r[0] for r in df.select(E.relu_derivative("x")).collect()]
    assert d == [0.0, 0.0, 0.0, 1.0, 0.0]


def test_sigmoid_tanh_and_overflow(spark):
    df = vals(spark, [0.0, -1000.0, 1000.0])
    s = [r[0] for r in df.select(E.sigmoid("x")).collect()]
    assert s == pytest.approx([0.5, 0.0, 1.0])
    t = [r[0] for r in df.select(E.tanh("x")).collect()]
    assert t == pytest.approx([0.0, -1.0, 1.0])


def test_backward_rules(spark):
    df = spark.createDataFrame([(2.0, 0.5), (3.0, -1.0)], "g double, x double")
    r = [row[0] for row in df.select(E.relu_backward("g", "x")).collect()]
    assert r == [2.0, 0.0]
    s = [row[0] for row in df.select(E.sigmoid_backward("g", "x")).collect()]
    assert s == pytest.approx([2.0 * 0.5 * 0.5, 3.0 * -1.0 * 2.0])
    t = [row[0] for row in df.select(E.tanh_backward("g", "x")).collect()]
    assert t == pytest.approx([2.0 * 0.75, 0.0])


def test_mae_reductions_and_tie(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 1.0), (0.0, 2.0)], "p double, t double")
    assert L.mae_loss(df, [("p", "t")], "mean").first()[0] == pytest.approx(4 / 3)
    assert L.mae_loss(df, [("p", "t")], "sum").first()[0] == pytest.approx(4.0)
    assert [r[0] for r in L.mae_loss(df, [("p", "t")], "none").collect()] == [0.0, 2.0, 2.0]
    g = [r[0] for r in L.mae_backward(df, [("p", "t")], "sum").collect()]
    assert g == [0.0, 1.0, -1.0]
    g = [r[0] for r in L.mae_backward(df, [("p", "t")], "sum", tie=-1.0).collect()]
    assert g == [-1.0, 1.0, -1.0]
    g = [r[0] for r in L.mae_backward(df, [("p", "t")], "mean").collect()]
    assert g == pytest.approx([0.0, 1 / 3, -1 / 3])


def test_mae_of_zero_rows_is_null(spark):
    df = spark.createDataFrame([], "p double, t double")
    assert L.mae_loss(df, [("p", "t")], "mean").first()[0] is None
