"""Digests of files, read in pieces inside tasks.

A file is looked up, measured and read where the tasks run; the driver opens nothing. Files are dealt
over tasks by size, so that the largest ones are spread first. An md5 reads a file from its first byte to its last, so one
file is one task, but in pieces of :data:`PIECE` bytes: its length has no limit. Arrow's file systems open the
paths (local or shared mounts, HDFS, S3, GCS, ABFS); files that only Spark's readers reach are read
whole by those, up to 2 GiB each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkrank.sources.collection import checkpointed

PIECE = 8 << 20
TASK_BYTES = 256 << 20

MEASURED = pa.schema([("name", pa.string()), ("path", pa.string()), ("full", pa.string()), ("size", pa.int64()), ("reached", pa.bool_())])
HASHED = pa.schema([("name", pa.string()), ("path", pa.string()), ("md5", pa.string())])


def _opened(path: str):
    """The file system of a path and the path inside it."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of each file, null if it is missing; ``reached`` tells whether its store could be asked."""
    for batch in batches:
        sizes, reached = [], []
        for path in batch.column(2).to_pylist():
            try:
                store, inner = _opened(path)
                info = store.get_file_info(inner)
                sizes.append(info.size if info.is_file else None)
                reached.append(True)
            except (pa.ArrowException, OSError, ValueError, ImportError):
                sizes.append(None)
                reached.append(False)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(reached)], schema=MEASURED)


def _hash(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch.column(2).to_pylist():
            store, inner = _opened(path)
            digest = hashlib.md5()
            with store.open_input_stream(inner, buffer_size=0) as stream:
                while piece := stream.read(PIECE):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], schema=HASHED)


def file_manifest(spark: SparkSession, files: Mapping[str, str] | DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``name, path, md5`` of input files; the md5 of a missing file is null.

    ``files`` maps names to paths, or is a table ``name, path`` of any length. For tables
    of many files :func:`readers.table_fingerprint` reads rows instead.
    """
    wanted = files.select("name", "path") if isinstance(files, DataFrame) else spark.createDataFrame(list(files.items()), "name string, path string")
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    here = F.lit("" if default.startswith("file:") else default.rstrip("/"))
    full = F.when(F.col("path").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.col("path")).otherwise(F.concat(here, F.col("path")))
    cores = spark.sparkContext.defaultParallelism
    asked = wanted.select("name", "path", full.alias("full")).repartition(cores, "path")
    sizes = checkpointed(asked.mapInArrow(_measure, "name string, path string, full string, size long, reached boolean"))
    there = sizes.filter("size is not null")
    total = there.agg(F.sum("size")).first()[0] or 0
    tasks = max(cores, int(-(-total // task_bytes)))
    # round by round inside a class of like sizes, the classes of large files first
    like = F.floor(F.log2(F.greatest(F.col("size"), F.lit(1))))
    turn = F.row_number().over(W.partitionBy("like").orderBy(F.col("size").desc(), "path"))
    dealt = there.withColumn("like", like).withColumn("task", F.pmod(turn + F.col("like"), F.lit(tasks)))
    hashed = dealt.repartitionByRange(tasks, "task").select("name", "path", "full").mapInArrow(_hash, "name string, path string, md5 string")
    absent = sizes.filter("size is null and reached").select("name", "path", F.lit(None).cast("string").alias("md5"))
    out = hashed.unionByName(absent)
    other = sizes.filter("not reached")
    return out if other.isEmpty() else out.unionByName(_by_readers(spark, other))


def _by_readers(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Digests of files that only Spark's readers open."""
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    paths = [r.full for r in files.select("full").distinct().collect()]  # a read names its files
    there = {path(p).getFileSystem(conf).makeQualified(path(p)).toString(): p for p in paths if path(p).getFileSystem(conf).exists(path(p))}
    if not there:
        return files.select("name", "path", F.lit(None).cast("string").alias("md5"))
    found = spark.read.format("binaryFile").load(list(there)).select(F.col("path").alias("found"), F.md5("content").alias("md5"))
    names = spark.createDataFrame(list(there.items()), "found string, full string")
    return files.join(names.join(found, "found"), "full", "left").select("name", "path", "md5")
