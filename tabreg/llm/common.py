"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path, ship_package

BATCH_BYTES = 4 << 20      # of one Arrow batch sent to a worker, or one row if that is longer


def prepare(spark: SparkSession) -> None:
    """Workers can import this package; Arrow batches are bounded by bytes, so that
    whole texts of any length, or pairs of sets, keep a worker's memory flat."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) != str(BATCH_BYTES):
        spark.conf.set(key, str(BATCH_BYTES))


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: the lineage ends here, and a
    lost executor costs a re-read only."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    prepare(df.sparkSession)
    return df.mapInArrow(fn, schema)


def batch(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)


def few_rows(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows (counts no further than that)."""
    return df.limit(limit + 1).count() <= limit


def keep_ids(df: DataFrame, ids: DataFrame, key: str, limit: int = 2_000_000) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids``: the ids are broadcast when they
    are at most ``limit`` (16 MB of longs), else both sides are shuffled on the key."""
    return _by_ids(df, ids, key, limit, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, key: str, limit: int = 2_000_000) -> DataFrame:
    """The other rows: those whose ``key`` is null or not in ``ids``."""
    return _by_ids(df, ids, key, limit, "left_anti")


def _by_ids(df, ids, key, limit, how):
    ids = write_table(ids.select(F.col(ids.columns[0]).alias(key)).filter(F.col(key).isNotNull()).distinct(), "ids")
    return df.join(F.broadcast(ids) if few_rows(ids, limit) else ids, key, how).select(*df.columns)


def keep_rows(df: DataFrame, masks: Callable[[Iterator[pa.Array]], Iterator], text: str = "text") -> DataFrame:
    """The rows of ``df`` that pass, all columns as they are: ``masks`` gets each
    batch's text column and yields a boolean array for each, in order. Rows are
    judged where they stand, so no key is needed and nothing is shuffled."""
    at = df.columns.index(text)

    def run(batches):
        seen = []

        def texts():
            for b in batches:
                seen.append(b)
                col = b.column(at)
                yield col if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else col.cast(pa.string())
        for mask in masks(texts()):
            yield seen.pop(0).filter(pa.array(mask, pa.bool_()))
    prepare(df.sparkSession)
    return df.mapInArrow(run, df.schema)
