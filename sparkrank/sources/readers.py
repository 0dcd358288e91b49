"""Readers with fixed schemas."""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrank import schemas
from sparkrank.sources.collection import checkpointed
from sparkrank.sources.files import file_manifest  # noqa: F401  one of the readers

TARGET_BYTES = 128 << 20


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Corpus or query records, one JSON object per line."""
    return spark.read.schema(schemas.DOCUMENT).json(path, mode="FAILFAST")


def read_judgments(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated judgments with a header line."""
    return spark.read.schema(schemas.JUDGMENT).csv(path, sep="\t", header=True, mode="FAILFAST")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METRICS).csv(path, header=True)


class TooManyBadRows(Exception):
    """More rows than tolerated can't be read."""


def read_with_quarantine(spark: SparkSession, path: str, kind: str, quarantine: str, tolerated: float = 0.0) -> DataFrame:
    """The sound rows of ``documents``, ``judgments`` or ``metrics`` files; the others go to a side table.

    ``quarantine`` is the folder of that table: the ``line`` as it stands, its ``file`` and the ``block`` of the file it lies
    in (the first byte of the split that read it). If their share is above ``tolerated``, the rows are written all the same and
    :class:`TooManyBadRows` is raised. Lines are parsed once with all their columns, into a
    checkpoint, so a value that can't be read counts whichever columns are used later.
    """
    schema, options = {
        "documents": (schemas.DOCUMENT, {"format": "json"}),
        "judgments": (schemas.JUDGMENT, {"format": "csv", "sep": "\t", "header": True}),
        "metrics": (schemas.METRICS, {"format": "csv", "header": True}),
    }[kind]
    given = spark.read.format(options.pop("format")).schema(f"{schema}, __bad string")
    rows = given.options(mode="PERMISSIVE", columnNameOfCorruptRecord="__bad", enforceSchema=True, **options).load(path)
    places = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block")]
    parsed = checkpointed(rows.select("*", *places))
    bad = parsed.filter("__bad is not null")
    bad.select(F.col("__bad").alias("line"), F.col("__file").alias("file"), F.col("__block").alias("block")).write.mode("append").parquet(quarantine)
    every, broken = parsed.agg(F.count(F.lit(1)), F.count("__bad")).first()
    if broken > tolerated * every:
        raise TooManyBadRows(f"{broken} of {every} rows of {path}; they are in {quarantine}")
    return parsed.filter("__bad is null").drop("__bad", "__file", "__block")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give a small input to all cores.

    A file with one row group is one task, however much work its rows cause.
    Inputs of few files that are small for the cluster are dealt out again;
    anything larger has enough splits of its own and is left where it is, so no
    large table is ever shuffled here.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    files = df.inputFiles()
    if not files or len(files) >= cores:
        return df
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    size = sum(path(f).getFileSystem(conf).getFileStatus(path(f)).getLen() for f in files)
    return df.repartition(cores) if size < cores * TARGET_BYTES else df


def table_fingerprint(df: DataFrame) -> DataFrame:
    """One row with a fingerprint of all rows, whatever their order.

    Two independent sums of row hashes and the row count; partial sums are
    combined before the shuffle.
    """
    columns = sorted(df.columns)
    rows = df.select(
        F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b")
    )

    def total(c: str):
        return F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string")

    return rows.agg(
        F.md5(F.concat_ws("/", F.count(F.lit(1)).cast("string"), total("a"), total("b"))).alias("md5")
    )


def input_fingerprint(df: DataFrame) -> str:
    """Fingerprint of the files and the plan of a table, or of its rows without files.

    Path, length and modification time of each file are enough to notice new
    data; no content is read, which for a large corpus would cost a full scan.
    The plan tells tables apart that take different rows from the same files.
    """
    files = [unquote(f) for f in df.inputFiles()]
    if not files:
        return table_fingerprint(df).first()["md5"]
    found = df.sparkSession.read.format("binaryFile").load(files)
    state = table_fingerprint(found.select("path", "length", "modificationTime")).first()["md5"]
    # all fields of every node, as toString() shows 25 only; without names, which the schema adds
    plan = df._jdf.queryExecution().analyzed().canonicalized().treeString(True, False, 2**31 - 1, False, False)
    return hashlib.md5(f"{state}/{df.schema.json()}/{plan}".encode()).hexdigest()
