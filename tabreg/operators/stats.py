"""Whole-table profiles: one aggregate per profile, all columns at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .select import exact_median


def dataset_statistics(df: DataFrame, price: str = "median_house_value",
                       income: str = "median_income", rooms: str = "total_rooms") -> DataFrame:
    """row_count, mean_price, median_price, mean_income, total_rooms_sum.

    The three needed columns are persisted once (the input may be a join);
    one aggregate gives the count, means and sum, and the exact median comes
    from distributed rank selection over the cached column (see ``select``).
    The result is a one-row table of those scalars.
    """
    from pyspark import StorageLevel

    cols = df.select(F.col(price).cast("double").alias("p"), F.col(income).cast("double").alias("i"),
                     F.col(rooms).cast("double").alias("r")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        a = cols.agg(F.count(F.lit(1)).alias("n"), F.count("p").alias("np"), F.avg("p").alias("mp"),
                     F.avg("i").alias("mi"), F.sum("r").alias("sr")).first()
        med = exact_median(cols, "p", n=int(a["np"]))
    finally:
        cols.unpersist()
    spark = df.sparkSession
    return spark.createDataFrame(
        [(int(a["n"]), a["mp"], med, a["mi"], a["sr"])],
        "row_count bigint, mean_price double, median_price double, mean_income double, total_rooms_sum double")


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns of a table (the column count is schema metadata)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                  F.lit(len(df.columns)).cast("long").alias("n_cols"))


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count / mean / sample std / min / max per column, long form, one pass."""
    cols = columns or [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint", "smallint")]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"),
                              F.col(f"{c}__n").cast("long").alias("count"),
                              F.col(f"{c}__mean").alias("mean"),
                              F.col(f"{c}__std").alias("std"),
                              F.col(f"{c}__min").alias("min"),
                              F.col(f"{c}__max").alias("max")) for c in cols])
    return one.select(F.inline(rows))

