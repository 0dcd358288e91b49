"""Order-dependent calculations that do not need one sorted task.

A running value over all rows (or over one very large key) would send every row
to a single task. Here rows are cut into ranges of positions: a window
works inside each range, one summary row per range carries the total forward,
and the two are added. ``pos`` is a whole number that gives the order, such as a
line number or a hash. Where positions lie close together a range is ``width`` positions; where they
do not, which their count and span show, the ranges start at every ``width / 2``-th
position of all, in order. Rows without a position come first, in no stated order; rows with null
keys form one group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WIDTH = 1 << 15
SPARSE = 4  # positions are sparse when their span holds more than so many for each row
SORTED = 64  # ranges whose starts one task finds

RANGE = "__range"
KEY = "__key"
BEFORE_ALL = -(1 << 63)  # range of the rows without a position


def range_starts(df: DataFrame, pos: str, width: int = WIDTH) -> np.ndarray | None:
    """Positions at which ranges start, where positions are sparse; null where they lie close together.

    Only positions are shuffled, and one in ``width / 2`` reaches the driver: 8 bytes for
    every 16,384 rows.
    """
    at = df.select(F.col(pos).cast("long").alias("at")).filter("at is not null")
    n, low, high = at.agg(F.count("at"), F.min("at"), F.max("at")).first()
    if not n or high - low < SPARSE * max(n, width):
        return None
    step = max(1, width // 2)

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(range(-seen % step, batch.num_rows, step), pa.int64()))], ["at"])
            seen += batch.num_rows

    spread = at.repartitionByRange(-(-n // (SORTED * width)), "at").sortWithinPartitions("at")
    return np.unique(np.array([r["at"] for r in spread.mapInArrow(pick, "at long").toLocalIterator()], np.int64))


def with_range(df: DataFrame, pos: str, width: int = WIDTH, dense: bool = False) -> DataFrame:
    """Add the range of each row; ``dense`` states that positions lie close together, and saves the look at them."""
    starts = None if dense else range_starts(df, pos, width)
    if starts is None:
        at = F.expr(f"`{pos}` div {int(width)}")
    else:
        known = df.sparkSession.sparkContext.broadcast(starts)

        @F.pandas_udf("long")
        def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(np.searchsorted(known.value, batch.to_numpy(np.int64), "right"), index=batch.index)

        at = F.when(F.col(pos).isNotNull(), place(F.coalesce(F.col(pos).cast("long"), F.lit(0))))
    return df.withColumn(RANGE, F.coalesce(at, F.lit(BEFORE_ALL)))


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The keys as one struct, which meets its like in a join even where a key is null."""
    return (df.withColumn(KEY, F.struct(*keys)), [KEY]) if keys else (df, [])


def _inside(keys: Sequence[str], pos: str):
    return (
        W.partitionBy(*keys, RANGE).orderBy(pos).rowsBetween(W.unboundedPreceding, W.currentRow)
    )


def _earlier_ranges(keys: Sequence[str]):
    return W.partitionBy(*keys).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)


def _join_ranges(rows: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(ranges, [*keys, RANGE], "inner")


def running_sums(
    df: DataFrame,
    values: dict[str, Column],
    pos: str,
    keys: Sequence[str] = (),
    width: int = WIDTH,
    dense: bool = False,
) -> DataFrame:
    """Add one column per entry of ``values``: its sum up to and with the row."""
    ranged, keys = _keyed(with_range(df, pos, width, dense), keys)
    local, before = {n: f"__in_{n}" for n in values}, {n: f"__before_{n}" for n in values}
    totals = ranged.groupBy(*keys, RANGE).agg(*[F.sum(v).alias(local[n]) for n, v in values.items()])
    carried = totals.select(
        *keys,
        RANGE,
        *[
            F.coalesce(F.sum(local[n]).over(_earlier_ranges(keys)), F.lit(0)).alias(before[n])
            for n in values
        ],
    )
    inside = ranged.withColumns({local[n]: F.sum(v).over(_inside(keys, pos)) for n, v in values.items()})
    summed = _join_ranges(inside, carried, keys).withColumns(
        {n: F.col(local[n]) + F.col(before[n]) for n in values}
    )
    return summed.drop(RANGE, KEY, *local.values(), *before.values())


def occurrence_number(
    df: DataFrame, key: str, pos: str, name: str = "occurrence", width: int = WIDTH
) -> DataFrame:
    """Number the rows of each key from 0 in order of ``pos``."""
    counted = running_sums(df, {name: F.lit(1)}, pos, [key], width)
    return counted.withColumn(name, F.col(name) - 1)


def carry_forward(
    df: DataFrame, value: str, pos: str, name: str, keys: Sequence[str] = (), width: int = WIDTH
) -> DataFrame:
    """Add ``name``: the last value that is not null up to and with the row."""
    ranged, keys = _keyed(with_range(df, pos, width), keys)
    latest = ranged.groupBy(*keys, RANGE).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(pos))).alias("__last")
    )
    carried = latest.select(
        *keys, RANGE, F.last("__last", ignorenulls=True).over(_earlier_ranges(keys)).alias("__before")
    )
    inside = ranged.withColumn("__in", F.last(value, ignorenulls=True).over(_inside(keys, pos)))
    joined = _join_ranges(inside, carried, keys)
    return joined.withColumn(name, F.coalesce("__in", "__before")).drop(RANGE, KEY, "__in", "__before")


def place_in_run(
    df: DataFrame, flag: str, pos: str, name: str = "place", width: int = WIDTH
) -> DataFrame:
    """Add ``name``: the 1-based place of a flagged row in its run of flagged rows.

    Rows that are not flagged get 0. A run may cross any number of ranges.
    """
    ranged = with_range(df, pos, width)
    inside = ranged.withColumn(
        "__row", F.row_number().over(W.partitionBy(RANGE).orderBy(pos))
    ).withColumn(
        "__stop",
        F.coalesce(F.max(F.when(~F.col(flag), F.col("__row"))).over(_inside([], pos)), F.lit(0)),
    )
    # flagged rows that stand at the end of each range, and whether the range
    # has a break at all; already grouped by range, so without another shuffle
    tails = inside.groupBy(RANGE).agg(
        F.max_by(F.col("__row") - F.col("__stop"), "__row").alias("__tail"),
        F.max(F.when(F.col("__stop") > 0, 1).otherwise(0)).alias("__broken"),
    )
    up_to = W.orderBy(RANGE).rowsBetween(W.unboundedPreceding, W.currentRow)
    groups = tails.withColumn("__group", F.sum("__broken").over(up_to))
    in_group = W.partitionBy("__group").orderBy(RANGE).rowsBetween(W.unboundedPreceding, W.currentRow)
    open_runs = groups.withColumn("__open", F.sum("__tail").over(in_group))
    carried = open_runs.select(
        RANGE, F.coalesce(F.lag("__open").over(W.orderBy(RANGE)), F.lit(0)).alias("__before")
    )
    placed = _join_ranges(inside, carried, [])
    run = F.col("__row") - F.col("__stop") + F.when(F.col("__stop") == 0, F.col("__before")).otherwise(0)
    return placed.withColumn(name, F.when(F.col(flag), run).otherwise(0)).drop(
        RANGE, "__row", "__stop", "__before"
    )
