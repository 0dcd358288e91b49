"""The stored vector collection: a Parquet table partitioned by tag."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkrank import schemas


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors see, as named by the cluster.

    Only a session on one machine, where any folder is shared, may do without.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and context.master.startswith("local"):
        folder = os.path.join(tempfile.gettempdir(), "sparkrank")
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return marker.getFileSystem(conf).exists(marker)


def write_collection(collection: DataFrame, path: str) -> None:
    """Write a collection, one folder per tag.

    Rows are rebalanced by tag: the files of a small tag are merged, and a tag
    that is too large for one task is split into several files.
    """
    columns = ["_id", "parent_id", "title", "text", "embedding", "ticker"]
    rows = collection.select(*columns).hint("rebalance", "ticker")
    rows.write.mode("overwrite").partitionBy("ticker").parquet(path)


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.COLLECTION).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder, for results read many times."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def get_or_create(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    write: Callable[[DataFrame, str], None],
    read: Callable[[SparkSession, str], DataFrame],
) -> DataFrame:
    """What is stored at ``path``; built only when no complete write is there.

    The path holds a fingerprint of the inputs, so changed data never meets a
    stale table, and a write that was cut off is done again.
    """
    if not is_complete(spark, path):
        write(build(), path)
    return read(spark, path)


def write_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
