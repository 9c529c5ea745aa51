import pytest
from pyspark.sql import functions as F

from tabreg.plans.housing import CALIFORNIA_COLUMNS
from tabreg.sources import io as IO


def raw(spark, tmp_path, width=9):
    data = str(tmp_path / "cal.data")
    cols = [(F.col("id") * (j + 1)).cast("double").alias(f"c{j}") for j in range(width)]
    spark.range(20).select(*cols).write.option("header", False).csv(data)
    dom = str(tmp_path / "cal.domain")
    spark.createDataFrame([("x: continuous.",)], "l string").write.text(dom)
    return data, dom


def test_convert_is_idempotent(spark, tmp_path):
    data, dom = raw(spark, tmp_path)
    out = str(tmp_path / "out")
    proc = str(tmp_path / "proc")
    IO.convert_if_needed(spark, "CaliforniaHousing", data, dom, out, proc)
    first = spark.read.parquet(f"{out}/CaliforniaHousing.parquet")
    assert first.columns == CALIFORNIA_COLUMNS and first.count() == 20
    IO.convert_if_needed(spark, "CaliforniaHousing", data, dom, out, proc)   # skip path
    assert IO.complete(spark, f"{proc}/CaliforniaHousing.csv")
    with pytest.raises(FileNotFoundError):
        IO.convert_if_needed(spark, "CaliforniaHousing", data + "x", dom, out)


def test_load_dataset_fallbacks(spark, tmp_path):
    data, _ = raw(spark, tmp_path, width=11)
    df = IO.load_dataset(spark, str(tmp_path / "none.parquet"), data)
    assert df.columns == CALIFORNIA_COLUMNS and df.count() == 20   # first 9 columns, all rows
    narrow, _ = raw(spark, tmp_path / "n", width=7)
    assert IO.load_dataset(spark, str(tmp_path / "none.parquet"), narrow).columns == CALIFORNIA_COLUMNS[:7]
    with pytest.raises(FileNotFoundError):
        IO.load_dataset(spark, str(tmp_path / "a"), str(tmp_path / "b"))


def test_conversion_keeps_source_row_order(spark, tmp_path):
    from tabreg.operators.rows import with_source_position
    data = str(tmp_path / "ord.data")
    # files of different sizes, so Spark's size-ordered packing would reorder them
    spark.range(0, 3000, 1, 3).select(*[(F.col("id") * (j + 1)).cast("double").alias(f"c{j}") for j in range(9)]) \
        .write.option("header", False).csv(data)
    dom = str(tmp_path / "ord.domain")
    spark.createDataFrame([("x",)], "l string").write.text(dom)
    out = IO.convert_if_needed(spark, "CaliforniaHousing", data, dom, str(tmp_path / "o"), str(tmp_path / "p"))
    for path, reader in [(f"{out}/CaliforniaHousing.csv", lambda p: IO.read_header_csv(spark, p, IO.HOUSING_DDL)),
                         (f"{out}/CaliforniaHousing.parquet", spark.read.parquet),
                         (f"{tmp_path}/p/CaliforniaHousing.csv", lambda p: IO.read_header_csv(spark, p, IO.HOUSING_DDL))]:
        got = sorted((r["row_pos"], r["longitude"]) for r in with_source_position(reader(path)).collect())
        assert [v for _, v in got] == [float(i) for i in range(3000)]


def test_half_written_copy_is_replaced(spark, tmp_path):
    import os
    src, dest = str(tmp_path / "src.csv"), tmp_path / "processed"
    spark.createDataFrame([(1.0,), (2.0,)], "v double").write.option("header", True).csv(src)
    os.makedirs(dest / "Own.csv")
    IO.publish_processed(spark, src, str(dest), "Own", overwrite=False)
    assert IO.read_header_csv(spark, str(dest / "Own.csv")).count() == 2
    before = sorted(os.listdir(dest / "Own.csv"))
    IO.publish_processed(spark, src, str(dest), "Own", overwrite=False)
    assert sorted(os.listdir(dest / "Own.csv")) == before


def test_conversion_neither_shuffles_nor_holds(spark, tmp_path):
    data, _ = raw(spark, tmp_path)
    plan = IO.scan_in_order(spark, data, IO.HOUSING_DDL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "InMemoryRelation" not in plan


def test_scan_in_order_fallback_and_types(spark, tmp_path, monkeypatch):
    data, _ = raw(spark, tmp_path, width=3)
    want = [(float(i), 2.0 * i, 3.0 * i) for i in range(20)]
    assert [tuple(r) for r in IO.scan_in_order(spark, data).collect()] == want       # inferred, as Spark names them
    assert IO.scan_in_order(spark, data).columns == ["_c0", "_c1", "_c2"]
    assert IO.scan_in_order(spark, data).dtypes == IO.read_headerless_csv(spark, data).dtypes
    monkeypatch.setattr(IO, "LISTED_FILES", 0)
    assert [tuple(r) for r in IO.scan_in_order(spark, data, "a double, b double, c double").collect()] == want


def test_splits_of_one_file_stay_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(IO, "SPLIT_BYTES", 1000)
    path = tmp_path / "one.data"
    path.write_text("".join(f"{i},x{i}\n" for i in range(5000)))
    df = IO.scan_in_order(spark, str(path), "i long, s string")
    assert df.rdd.getNumPartitions() > 1
    assert [r["i"] for r in df.collect()] == list(range(5000))


def test_published_files_are_equal_bytes(spark, tmp_path):
    src, dest = tmp_path / "src.csv", tmp_path / "processed"
    spark.range(0, 5000, 1, 7).selectExpr("id", "'ü,\"' || id AS s").write.option("header", True).csv(str(src))
    IO.publish_processed(spark, str(src), str(dest), "Own", overwrite=True)
    IO.publish_processed(spark, str(src), str(dest), "Own", overwrite=True)          # in place of the first
    data = {p.name: p.read_bytes() for p in src.iterdir() if p.name[0] not in "_."}
    got = {p.name: p.read_bytes() for p in (dest / "Own.csv").iterdir() if p.name[0] not in "_."}
    assert len(data) == 7 and got == data
    assert [p.name for p in dest.iterdir()] == ["Own.csv"]                           # no staging folder is left


def test_failed_copy_leaves_the_old_one(spark, tmp_path, monkeypatch):
    from tabreg.sources import files
    src, dest = tmp_path / "src.csv", tmp_path / "processed"
    spark.range(5).write.option("header", True).csv(str(src))
    IO.publish_processed(spark, str(src), str(dest), "Own", overwrite=True)
    before = sorted(p.name for p in (dest / "Own.csv").iterdir())
    spark.range(9).write.mode("overwrite").option("header", True).csv(str(src))
    listed = files.data_files
    monkeypatch.setattr(files, "data_files", lambda s, p: [(u, n + 1) for u, n in listed(s, p)])
    with pytest.raises(OSError):
        IO.publish_processed(spark, str(src), str(dest), "Own", overwrite=True)
    assert sorted(p.name for p in (dest / "Own.csv").iterdir()) == before
