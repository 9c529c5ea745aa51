import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tabreg.operators import rows as R
from tabreg.operators.select import exact_median, select_ranks


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_index_exact_and_partitioned(spark):
    keys = random.Random(1).sample(range(10**9), 5000)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    out = R.row_index(df, "k", rows_per_bucket=500)
    got = {r["k"]: r["row_idx"] for r in out.collect()}
    want = {k: i for i, k in enumerate(sorted(keys))}
    assert got == want
    assert "SinglePartition" not in plan_text(out)


def test_split_is_a_predicate(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    out = R.train_test_split(df, "k", 0.8)
    got = {r["k"]: r["split"] for r in out.collect()}
    assert sum(1 for v in got.values() if v == "train") == 800
    assert all((got[k] == "train") == (k < 800) for k in got)
    assert "Exchange" not in plan_text(out)


def test_random_val_split_size_and_repeatable(spark):
    df = spark.range(1234).select(F.col("id").alias("k"))
    a = R.random_val_split(df, "k", 0.2, seed=7)
    b = R.random_val_split(df, "k", 0.2, seed=7)
    va = sorted(r["k"] for r in a.where("split = 'val'").collect())
    assert len(va) == 246
    assert va == sorted(r["k"] for r in b.where("split = 'val'").collect())
    with pytest.raises(ValueError):
        R.random_val_split(df, "k", 0.6)


def test_minibatch_short_last_batch(spark):
    df = spark.range(10).select(F.col("id").alias("k"))
    b = sorted((r["k"], r["batch"]) for r in R.minibatch(df, "k", 4).collect())
    assert [x[1] for x in b] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


def test_select_ranks_with_hot_value(spark):
    # a third of the rows share one value: the read-off sees one (value, count)
    vals = [5.0] * 3000 + [float(i) for i in range(6000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = sorted(vals)
    ranks = [0, 100, 2999, 4000, 8999]
    assert select_ranks(df, "x", ranks, max_final=50, accuracy=200) == [s[r] for r in ranks]
    assert exact_median(df, "x") == pytest.approx((s[4499] + s[4500]) / 2 if len(s) % 2 == 0 else s[len(s) // 2])


def test_source_position(spark, tmp_path):
    p = str(tmp_path / "t.parquet")
    spark.range(0, 300, 1, 3).select((F.col("id") * 2).alias("v")).write.parquet(p)
    df = R.with_source_position(spark.read.parquet(p))
    pos = sorted(r["row_pos"] for r in df.collect())
    assert pos == list(range(300))


def test_preview_is_top_k(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("k"))
    assert [r["k"] for r in R.preview(df, "k", 5).collect()] == [0, 1, 2, 3, 4]
    assert "TakeOrdered" in plan_text(R.preview(df, "k", 5))


def test_hash_ranks_exact(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("h"))
    hs = sorted(r["h"] for r in df.collect())
    ranks = [0, 1, 499, 2500, 4999]
    assert R.hash_ranks(df, "h", ranks, 5000, max_final=100) == [hs[r] for r in ranks]


def test_source_position_csv_splits(spark, tmp_path):
    p = str(tmp_path / "t.csv")
    spark.range(0, 5000, 1, 4).select(F.col("id").alias("v")).write.option("header", True).csv(p)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")   # several splits per file
    try:
        df = spark.read.option("header", True).schema("v long").csv(p)
        got = sorted((r["row_pos"], r["v"]) for r in R.with_source_position(df).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [x[0] for x in got] == list(range(5000))
    assert [x[1] for x in got] == list(range(5000))   # file order = written order here


def test_row_index_hot_key_is_salted(spark):
    # a third of the rows share one key: positions are still exact (ties in any
    # order) and the hot value is split over several window partitions
    rows = [(5, i) for i in range(3000)] + [(k, -k) for k in range(10, 6010)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(5)
    out = R.row_index(df, "k", rows_per_bucket=400)
    got = out.collect()
    assert sorted(r["row_idx"] for r in got) == list(range(9000))
    hot = sorted(r["row_idx"] for r in got if r["k"] == 5)
    assert hot == list(range(3000))
    others = sorted((r["k"], r["row_idx"]) for r in got if r["k"] != 5)
    assert [p for _, p in others] == list(range(3000, 9000))


def test_hash_ranks_with_a_hot_duplicate(spark):
    # a third of the rows carry the same hash value
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("0" * 32))
                                  .otherwise(F.md5(F.col("id").cast("string"))).alias("h"))
    hs = sorted(r["h"] for r in df.collect())
    ranks = [0, 999, 1000, 1500, 2999]
    assert R.hash_ranks(df, "h", ranks, 3000, max_final=50) == [hs[r] for r in ranks]


def test_row_index_strings_and_nulls(spark):
    names = ["grape", "zebra", "apple", "fig", "Pear", "kiwi", "", "10", "9", "été", None, None]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(names)], "k string, v int").repartition(4)
    got = sorted((r["row_idx"], r["k"]) for r in R.row_index(df, "k", rows_per_bucket=3).collect())
    want = sorted((x for x in names if x is not None), key=lambda x: x.encode()) + [None, None]
    assert [k for _, k in got] == want and [i for i, _ in got] == list(range(12))
    nums = spark.createDataFrame([(x,) for x in [3.0, None, 1.0, None, 2.0, float("nan")]], "k double")
    got = sorted((r["row_idx"], str(r["k"])) for r in R.row_index(nums, "k").collect())
    assert [k for _, k in got] == ["1.0", "2.0", "3.0", "nan", "None", "None"]
    assert R.row_index(df.limit(0), "k").count() == 0


def test_row_index_splits_equal_rows(spark):
    df = spark.range(3000).select(F.lit("same").alias("k"))
    out = R.row_index(df, "k", rows_per_bucket=300)
    assert sorted(r["row_idx"] for r in out.collect()) == list(range(3000))
    files = [f.removeprefix("file:").replace("//", "/") for f in out.inputFiles() if "/positions-" in f]
    sizes = [pq.read_metadata(f).num_rows for f in files]
    assert len(sizes) >= 8 and max(sizes) < 900


def test_splits_are_exact_on_ties(spark):
    df = spark.createDataFrame([(5 if i < 600 else i, i) for i in range(1000)], "k long, v long").repartition(3)
    out = R.train_test_split(df, "k", 0.5)
    assert sorted(map(tuple, out.groupBy("split").count().collect())) == [("test", 500), ("train", 500)]
    assert out.where("split = 'train' and k <> 5").count() == 0
    val = R.random_val_split(df, "k", 0.2, seed=1)
    assert val.where("split = 'val'").count() == 200 and val.count() == 1000
    names = df.select(F.concat(F.lit("n"), "k").alias("s"), "v")
    assert R.train_test_split(names, "s", 0.3).where("split = 'train'").count() == 300


def test_splits_with_null_keys(spark):
    df = spark.createDataFrame([(None if i % 4 == 0 else i, i) for i in range(100)], "k long, v long")
    for frac, n in ((0.5, 50), (0.9, 90)):
        out = R.train_test_split(df, "k", frac)
        assert out.where("split = 'train'").count() == n
        assert out.where("split = 'train' and k is null").count() == max(0, n - 75)
    assert R.random_val_split(df, "k", 0.2).where("split = 'val'").count() == 20


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64, 1001, 4097, 99_999])
def test_permutation_is_a_bijection_on_any_size(spark, n):
    keys = R.shuffle_keys(7, "epoch", 2)
    want = R.permute_np(np.arange(n), n, keys)
    assert sorted(want.tolist()) == list(range(n))
    if n in (1, 3, 1001, 4097):
        got = spark.range(n).select("id", R.permuted("id", n, keys).alias("p")).orderBy("id").collect()
        assert [r["p"] for r in got] == want.tolist()
    if n > 1000:                                   # neighbours scatter, and another epoch has another order
        assert abs(np.corrcoef(np.arange(n), want)[0, 1]) < 0.1
        assert (R.permute_np(np.arange(n), n, R.shuffle_keys(7, "epoch", 3)) == want).mean() < 0.01


def test_permutation_of_huge_and_null_positions(spark):
    n = (1 << 45) + 12345
    keys = R.shuffle_keys(1)
    pos = [0, 1, n - 1, n // 2]
    want = R.permute_np(np.array(pos), n, keys).tolist()
    got = spark.createDataFrame([(p,) for p in [*pos, None]], "p long").select("p", R.permuted("p", n, keys).alias("q")).collect()
    assert {r["p"]: r["q"] for r in got} == dict(zip(pos, want)) | {None: None} and max(want) < n
    with pytest.raises(ValueError, match="2\\^54"):
        R.permuted("p", 1 << 60, keys)


def test_permuted_split_sizes(spark):
    df = spark.range(997).withColumnRenamed("id", "pos")
    out = R.permuted_split(df, "pos", 997, 0.2, seed=3)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    for part, size in (("val", 199), ("train", 798)):
        assert sorted(r["rank"] for r in rows if r["split"] == part) == list(range(size))
    with pytest.raises(ValueError):
        R.permuted_split(df, "pos", 997, 0.5, seed=3)


def test_permutation_runs_on_arrow_batches_once_a_row(spark):
    """No interpreted loop of lambdas; a filter on the split does not compute the place a second time."""
    df = spark.range(997).withColumnRenamed("id", "pos")
    part = R.permuted_split(df, "pos", 997, 0.2, seed=3).where("split = 'train'").select((F.col("rank") + 1).alias("r"))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "lambda" not in plan
    assert part.agg(F.sum("r")).first()[0] == 798 * 799 // 2


def test_a_walk_that_does_not_end_is_an_error(monkeypatch):
    keys = R.shuffle_keys(1)
    assert sorted(R.permute_np(np.arange(5), 5, keys).tolist()) == list(range(5))
    monkeypatch.setattr(R, "WALKS", 0)             # 5 of 8 values
    with pytest.raises(ValueError, match="did not end"):
        R.permute_np(np.arange(5), 5, keys)
