"""Projections and the one row predicate of the pipeline.

All are single ``select``/``where`` operators: Catalyst collapses them into
the scan's projection, so column pruning and codegen apply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import THIN_EVERY


def rename_positional(df: DataFrame, names) -> DataFrame:
    """First ``len(names)`` columns renamed by position; extra columns are
    dropped; with fewer columns only the existing ones are renamed."""
    cols = df.columns
    return df.select(*[F.col(o).alias(n) for o, n in zip(cols, names)])


def canonical_select(df: DataFrame, names) -> DataFrame:
    """The canonical columns in order when all are present, else unchanged."""
    names = list(names)
    if all(n in df.columns for n in names):
        return df.select(*names)
    return df


def split_features_target(df: DataFrame, features, target: str, keep=()) -> DataFrame:
    """Features and target kept together in one table (Spark rows cannot be
    re-aligned by position later); all other columns dropped."""
    return df.select(*[F.col(k) for k in keep], *[F.col(c) for c in features], F.col(target))


def concat_horizontal(df: DataFrame, groups) -> DataFrame:
    """Side-by-side concatenation of column groups of the SAME table (each a
    list of Column/str), as one select. Duplicate output names are rejected."""
    cols = []
    for g in groups:
        for c in g:
            cols.append(F.col(c) if isinstance(c, str) else c)
    out = df.select(*cols)
    if len(set(out.columns)) != len(out.columns):
        raise ValueError(f"duplicate column names: {out.columns}")
    return out


def cast_float32(df: DataFrame, columns=None) -> DataFrame:
    cs = set(columns or [c for c, t in df.dtypes if t in ("double", "int", "bigint", "float")])
    return df.select(*[F.col(c).cast("float").alias(c) if c in cs else F.col(c) for c in df.columns])


def identity(df: DataFrame) -> DataFrame:
    return df.select("*")


def constant_fill(spark: SparkSession, rows: int, cols: int, value: float, prefix: str = "c_") -> DataFrame:
    """rows x cols table of one value, ``prefix_j`` columns (spark.range:
    generated in parallel, no driver data)."""
    return spark.range(rows).select(*[F.lit(float(value)).alias(f"{prefix}{j}") for j in range(cols)])


def zeros(spark: SparkSession, rows: int, cols: int, prefix: str = "c_") -> DataFrame:
    return constant_fill(spark, rows, cols, 0.0, prefix)


def ones(spark: SparkSession, rows: int, cols: int, prefix: str = "c_") -> DataFrame:
    return constant_fill(spark, rows, cols, 1.0, prefix)


def history_thin(history: DataFrame, every: int = THIN_EVERY, epoch: str = "epoch",
                 by: str | None = None) -> DataFrame:
    """Keep every ``every``-th epoch (1, 21, 41, ...) and the last one (per
    run when ``by`` is given). The last epoch comes from a per-run max, a
    window partitioned by run (bounded by epochs per run)."""
    if by:
        marked = history.withColumn("_last", F.max(epoch).over(Window.partitionBy(by)))
        keep = ((F.col(epoch) - 1) % every == 0) | (F.col(epoch) == F.col("_last"))
        return marked.where(keep).drop("_last")
    last = F.lit(history.agg(F.max(epoch)).first()[0])
    return history.where(((F.col(epoch) - 1) % every == 0) | (F.col(epoch) == last))
