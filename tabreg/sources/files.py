"""Files as files: opened inside tasks by URI, and folders copied by tasks.

Spark's own readers hand a task its rows; a task that needs a whole small file, or
its bytes, opens it here by the folder's URI. PyArrow knows local and mounted
folders, HDFS (with libhdfs on the executors), S3 and GCS; credentials come from the
executors' environment.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

CHUNK = 8 << 20      # bytes a copying task holds at once


def hadoop_path(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a URI."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as Spark would resolve it; tasks need it so."""
    fs, p = hadoop_path(spark, path)
    return fs.makeQualified(p).toString()


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """(PyArrow file system, path in it) of a folder or file named by a URI."""
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    uri = re.sub(r"^file:/+", "/", uri)
    return pafs.FileSystem.from_uri(uri)


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(URI, bytes) of the file ``path``, or of the files right in it, by name.
    Names that start with ``_`` or ``.`` are no data."""
    fs, p = hadoop_path(spark, path)
    out = [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(p)
           if s.isFile() and s.getPath().getName()[0] not in "_."]
    return sorted(out)


def _copy(batches, dest: str):
    target, root = open_fs(dest)
    for b in batches:
        copied = []
        for uri in b.column(0).to_pylist():
            source, path = open_fs(uri)
            name = path.rsplit("/", 1)[1]
            part = f"{root}/_{uuid.uuid4().hex}"       # attempts of one task do not share a file
            size = 0
            with source.open_input_stream(path) as src, target.open_output_stream(part) as out:
                while chunk := src.read(CHUNK):
                    out.write(chunk)
                    size += len(chunk)
            if target.get_file_info(f"{root}/{name}").type == pafs.FileType.NotFound:
                target.move(part, f"{root}/{name}")
            else:                                      # another attempt was first
                target.delete_file(part)
            copied.append(size)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(copied, pa.int64())], names=["uri", "copied"])


def copy_folder(spark: SparkSession, src: str, dest: str) -> None:
    """The data files of ``src``, byte for byte, as the folder ``dest``.

    Tasks copy the files (a row for each, spread over the cluster) into a staging
    folder next to ``dest``, whose name readers pass over; it takes the place of
    ``dest`` when every byte has arrived, and ``_SUCCESS`` is written last. A copy
    that fails leaves ``dest`` as it was."""
    files = data_files(spark, src)
    parent, name = dest.rstrip("/").rsplit("/", 1)
    stage = f"{parent}/_{name}-{uuid.uuid4().hex}"
    fs, stage_path = hadoop_path(spark, stage)
    fs.mkdirs(stage_path)
    if files:
        ship_package(spark)
        uri = qualified(spark, stage)
        rows = spark.createDataFrame(files, "uri string, size long")
        done = rows.select("uri").repartition(min(len(files), 4 * spark.sparkContext.defaultParallelism)) \
            .mapInArrow(lambda it: _copy(it, uri), "uri string, copied long")
        wrong = done.join(rows, "uri").filter("copied != size").agg(F.count("*")).first()[0]
        if wrong or len(data_files(spark, stage)) != len(files):
            raise OSError(f"{src}: {wrong} of {len(files)} files were not copied whole")
    _, dest_path = hadoop_path(spark, dest)
    fs.delete(dest_path, True)
    if not fs.rename(stage_path, dest_path):
        raise OSError(f"{stage} could not be renamed to {dest}")
    fs.create(hadoop_path(spark, dest.rstrip("/") + "/_SUCCESS")[1], True).close()
