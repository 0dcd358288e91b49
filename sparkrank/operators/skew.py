"""Joins in which one key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.sources.collection import checkpointed

HEAVY_ROWS = 1 << 20  # rows of one key that one task may take
HEAVY_KEYS = 1_000_000  # keys with more rows are broadcast up to this number


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """A join side marked for broadcast when it has at most ``rows`` rows.

    The side is written to the checkpoint folder once and counted there. A side
    that is larger is left to the shuffle join Spark plans by itself.
    """
    written = checkpointed(df)
    return F.broadcast(written) if written.count() <= rows else written


def heavy_keys(many: DataFrame, key: str, rows: int = HEAVY_ROWS) -> DataFrame:
    """``key, __salts`` of the keys with more than ``rows`` rows: as many salts as tasks they fill.

    One counting pass, combined before the shuffle. At most one key in ``rows`` rows is heavy.
    """
    counted = many.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > rows)
    return counted.select(key, F.ceil(F.col("__n") / rows).cast("int").alias("__salts"))


def join_spread(many: DataFrame, few: DataFrame, key: str, by: str, rows: int = HEAVY_ROWS) -> DataFrame:
    """Inner join on ``key`` of a long table with a short lookup table.

    A key may be in most rows of ``many``. The rows of a key with more than ``rows`` rows are
    dealt over tasks in proportion to their count, by the hash of column ``by``, and the rows of
    ``few`` with this key are repeated as often. All other rows, and all of them where no key
    is heavy, are joined as they are.
    """
    heavy = checkpointed(heavy_keys(many, key, rows))
    n = heavy.count()
    if not n:
        return many.join(few, key)
    if n <= HEAVY_KEYS:
        heavy = F.broadcast(heavy)
    salts = F.coalesce("__salts", F.lit(1))
    salted = few.join(heavy, key, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    dealt = many.join(heavy, key, "left").withColumn("__salt", F.pmod(F.xxhash64(by), salts).cast("int"))
    return dealt.drop("__salts").join(salted.drop("__salts"), [key, "__salt"]).drop("__salt")
