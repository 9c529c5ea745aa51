"""Readers, writers and idempotent ingestion.

Paths are URIs (local, HDFS, object stores); existence checks go through the
Hadoop FileSystem of the path, so they work wherever Spark can read. Explicit
schemas avoid the extra pass that CSV type inference costs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.project import canonical_select, rename_positional
from ..operators.rows import in_source_order
from ..plans.housing import CALIFORNIA_COLUMNS
from .files import copy_folder, data_files, hadoop_path

HOUSING_DDL = ", ".join(f"{c} double" for c in CALIFORNIA_COLUMNS)
LISTED_FILES = 100_000        # file names given to one scan (about 10 MB of settings)
SPLIT_BYTES = 4 << 20         # a smaller file is not split for more tasks


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return bool(fs.exists(p))


def complete(spark: SparkSession, path: str) -> bool:
    """A Spark output directory counts as present once its _SUCCESS marker is."""
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def read_headerless_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Comma CSV without header. With ``schema`` no inference pass is run;
    without it columns are named ``_c0..`` and typed by inference."""
    r = spark.read.option("header", False).option("sep", ",")
    if schema:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


def scan_in_order(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """``read_headerless_csv`` whose partitions are the splits of the files in
    source order (file name, then place in the file), one split a task. A write
    that follows numbers its files likewise, so the outputs keep the row order
    without positions, a shuffle or a sort.

    Spark's file source packs splits by size. The lines come from Hadoop's text
    input instead, which keeps the order of the files it is given, and are parsed
    by Spark's CSV reader on the JVM side. Where the names cannot be listed so
    (more than ``LISTED_FILES``, or with a comma or a glob character), the rows
    are ordered by their source position."""
    files = data_files(spark, path)
    names = [uri for uri, _ in files]
    if not files or len(files) > LISTED_FILES or any(set(n) & set(",{}[]*?\\") for n in names):
        return in_source_order(read_headerless_csv(spark, path, schema))
    sc = spark.sparkContext
    size = sum(n for _, n in files)
    lines = sc._jsc.textFile(",".join(names), max(1, min(size // SPLIT_BYTES, sc.defaultParallelism)))
    table = spark._jsparkSession.createDataset(lines.rdd(), sc._jvm.org.apache.spark.sql.Encoders.STRING())
    r = spark._jsparkSession.read().option("header", False).option("sep", ",")
    r = r.schema(schema) if schema else r.option("inferSchema", True)
    return DataFrame(r.csv(table), spark)


def read_header_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read.option("header", True).option("sep", ",")
    if schema:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, *, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def write_json(df: DataFrame, path: str, *, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def load_dataset(spark: SparkSession, parquet_path: str, csv_path: str,
                 names=CALIFORNIA_COLUMNS) -> DataFrame:
    """Prefer Parquet (select the canonical columns in order when all are
    present, else pass through); else the headerless CSV renamed by position;
    else fail naming both paths."""
    if exists(spark, parquet_path):
        return canonical_select(spark.read.parquet(parquet_path), names)
    if exists(spark, csv_path):
        # the types are known: the first line's width is all that is read ahead
        first = spark.read.text(csv_path).first()
        width = first[0].count(",") + 1 if first else len(names)
        return read_headerless_csv(spark, csv_path, ", ".join(f"{c} double" for c in names[:width]))
    raise FileNotFoundError(f"neither {parquet_path} nor {csv_path} exists")


def convert_if_needed(spark: SparkSession, dataset_name: str, data_path: str, domain_path: str,
                      out_dir: str, processed_dir: str | None = None,
                      names=CALIFORNIA_COLUMNS) -> str:
    """Idempotent ingestion: fail if an input is missing; when both outputs
    (CSV and Parquet, judged by their _SUCCESS markers) exist, skip, only
    publishing the processed copy if it is absent; otherwise read the
    headerless CSV, name its columns, and write both outputs in source row order,
    a file for each split. Each output parses the lines again: nothing is shuffled
    or held. The processed copy is a copy of the CSV's files. Returns ``out_dir``."""
    if not exists(spark, data_path):
        raise FileNotFoundError(f"no data at {data_path}")
    if not exists(spark, domain_path):
        raise FileNotFoundError(f"no column description at {domain_path}")
    out_dir = out_dir.rstrip("/")
    csv_out = f"{out_dir}/{dataset_name}.csv"
    pq_out = f"{out_dir}/{dataset_name}.parquet"
    if complete(spark, csv_out) and complete(spark, pq_out):
        if processed_dir:
            publish_processed(spark, csv_out, processed_dir, dataset_name, overwrite=False)
        return out_dir
    # generic datasets keep their positional names and inferred types
    known = dataset_name == "CaliforniaHousing"
    df = scan_in_order(spark, data_path, ", ".join(f"{c} double" for c in names) if known else None)
    write_csv(df, csv_out)
    write_parquet(df, pq_out)
    if processed_dir:
        publish_processed(spark, csv_out, processed_dir, dataset_name, overwrite=True)
    return out_dir


def publish_processed(spark: SparkSession, csv_dir: str, processed_dir: str, dataset_name: str,
                      *, overwrite: bool) -> str:
    """Copy the converted CSV's files to the processed folder: always when
    ``overwrite``, else only if no complete copy is there (a half-written one
    has no _SUCCESS marker and is replaced)."""
    dest = f"{processed_dir.rstrip('/')}/{dataset_name}.csv"
    if overwrite or not complete(spark, dest):
        copy_folder(spark, csv_dir, dest)
    return dest


def write_run_record(spark: SparkSession, record: dict, path: str, schema: str | None = None) -> None:
    """Append one run's metadata/config as a JSON line to a queryable registry."""
    df = spark.createDataFrame([record], schema) if schema else spark.createDataFrame([record])
    write_json(df, path, mode="append")
