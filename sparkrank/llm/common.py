"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrank.sources.collection import shared_folder

SPACE = re.compile(rb"[ \t-\r]")
BLOCK_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the driver ends."""
    path = f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"
    _file_system(spark, path, lambda fs, p: fs.deleteOnExit(p))
    return path


def _file_system(spark: SparkSession, path: str, act: Callable) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    act(hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once as a table in the shared folder and read from there.

    It cuts the lineage like a checkpoint, but computes the rows once. The files
    outlive lost executors.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def drop_stored(df: DataFrame) -> None:
    """Delete the files behind ``stored``; nothing may read them any more."""
    path = getattr(df, "_llm_path", None)
    if path:
        _file_system(df.sparkSession, path, lambda fs, p: fs.delete(p, True))


def _worker_state() -> dict:
    name = "sparkrank_worker_state"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def release() -> None:
    """Free what ``per_process`` keeps; operators without such a thing call it, as workers serve them all."""
    kept = _worker_state()
    for other in [k for k, v in kept.items() if isinstance(v, tuple)]:
        del kept[other]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, few at a time, for work that makes many objects of a row; no empty ones."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def per_process(key: str, make: Callable, version: str = ""):
    """What ``make`` gives, kept by a worker process for its later tasks of the same ``version``.

    Functions travel to the workers by value, so module globals do not last. A
    process keeps one such thing at a time: another key or version frees it.
    """
    kept = _worker_state()
    if kept.get(key, ("", None))[0] != version or key not in kept:
        release()
        kept[key] = (version, make())
    return kept[key][1]


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(binary).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """The strings of a column; null counts as empty, broken UTF-8 is replaced."""
    return [x.decode("utf-8", "replace") for x in utf8(column)]


def space_blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """``data`` in blocks of about ``size`` bytes, cut at white space only."""
    at = 0
    while len(data) - at > size:
        cut = SPACE.search(data, at + size)
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end
    if at < len(data):
        yield data[at:]


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [pa.array(c, type=f.type, from_pandas=False) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def sorted_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str]
) -> Iterator[dict[str, np.ndarray]]:
    """Groups of equal keys from batches that are sorted by them.

    Columns are numbers without nulls. One group is held at a time, so callers
    bound the size of groups.
    """
    held: list[dict[str, np.ndarray]] = []

    def joined(parts):
        return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]} if len(parts) > 1 else parts[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        data = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(batch.schema.names)}
        n = batch.num_rows
        change = np.zeros(n - 1, bool)
        for k in keys:
            change |= data[k][1:] != data[k][:-1]
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), n]
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            part = {c: v[lo:hi] for c, v in data.items()}
            if held and any(held[-1][k][-1] != part[k][0] for k in keys):
                yield joined(held)
                held = []
            held.append(part)
    if held:
        yield joined(held)


def phrase_hashes(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A number for the ``size`` words from each place on, given the hashes of the words."""
    out = np.zeros(len(at), np.uint64)
    for j in range(size):
        out = (out ^ hashes[at + j]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def held_out() -> Column:
    """Whether crc32 of the document id as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
