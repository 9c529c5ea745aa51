"""A registry of runs in a shared folder: a run's tables are published together, once.

``commit_run`` writes every table under a new attempt of the run, where no reader looks,
and then appends the run's rows to the manifest, in one file. Readers take the
tables that the manifest names, of each run the attempt published last. So a write
that fails, or a driver lost between two tables, leaves what was there before; and a
run committed again under its id replaces its tables instead of adding to them.

    <root>/<table>/attempt=<id>/...     rows with their run_id
    <root>/manifest/...                 run_id, table_name, attempt, format, published

Attempts that were replaced or never published stay on disk, unread.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.io import exists

MANIFEST_SCHEMA = "run_id string, table_name string, attempt string, format string, published long"


def stage_table(df: DataFrame, root: str, name: str, run_id: str, attempt: str, fmt: str = "parquet") -> None:
    """Write one table of an attempt: nobody reads it before ``publish``."""
    df.withColumn("run_id", F.lit(run_id)).write.format(fmt).save(f"{root.rstrip('/')}/{name}/attempt={attempt}")


def publish(spark: SparkSession, root: str, run_id: str, attempt: str, formats: dict[str, str], withdraw=()) -> None:
    """Make an attempt's tables (name -> format) the run's; tables in ``withdraw`` that
    the attempt lacks are no longer the run's. One file, moved into place by one rename."""
    now = time.time_ns()
    rows = [(run_id, name, attempt, fmt, now) for name, fmt in formats.items()]
    rows += [(run_id, name, None, None, now) for name in withdraw if name not in formats]
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/manifest")


def commit_run(spark: SparkSession, root: str, run_id: str, tables: dict[str, DataFrame], *,
               formats: dict[str, str] | None = None, withdraw=()) -> str:
    """Publish ``tables`` (name -> rows) as those of ``run_id``: all of them, or none.

    Committing the same id again replaces the tables named, and those in ``withdraw``
    that are not given are dropped from the run. Returns the attempt's id."""
    attempt = "a" + uuid.uuid4().hex
    kinds = {name: (formats or {}).get(name, "parquet") for name in tables}
    for name, df in tables.items():
        stage_table(df, root, name, run_id, attempt, kinds[name])
    publish(spark, root, run_id, attempt, kinds, withdraw)
    return attempt


def committed(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, table_name, attempt, format): the published attempt of each table of each run."""
    path = f"{root.rstrip('/')}/manifest"
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(path) if exists(spark, path) else spark.createDataFrame([], MANIFEST_SCHEMA)
    last = F.max_by(F.struct("attempt", "format"), F.struct("published", "attempt"))
    out = rows.groupBy("run_id", "table_name").agg(last.alias("l")).select("run_id", "table_name", "l.attempt", "l.format")
    return out.filter("attempt is not null")


def read_table(spark: SparkSession, root: str, name: str, run_id: str | None = None, *, schema=None) -> DataFrame:
    """The committed rows of a table, of one run or of all: only their folders are listed
    and read. The driver holds one path for each run. ``schema``: also what an empty
    registry gives; without it, no committed run is a FileNotFoundError."""
    own = committed(spark, root).filter(F.col("table_name") == name)
    if run_id is not None:
        own = own.filter(F.col("run_id") == run_id)
    found = own.select("attempt", "format").collect()
    if not found:
        if schema is None:
            raise FileNotFoundError(f"no committed table {name}{'' if run_id is None else ' of run ' + run_id} under {root}")
        return spark.createDataFrame([], schema)
    out = None
    for fmt in sorted({r["format"] for r in found}):
        paths = [f"{root.rstrip('/')}/{name}/attempt={r['attempt']}" for r in found if r["format"] == fmt]
        reader = spark.read.format(fmt)
        part = (reader if schema is None else reader.schema(schema)).load(paths)
        out = part if out is None else out.unionByName(part)
    return out
