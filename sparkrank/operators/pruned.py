"""Exact nearest neighbours without comparing every query with every vector.

A bounded sample of the vectors are pivots. Their order in space deals the vectors of a scope (a tag, or all
vectors) to slots, so that near ones lie together. Inside a slot some of its vectors are pivots again: each vector belongs to
the cell of its nearest one, and a cell knows the least and the greatest distance of its vectors to the pivot. For a query at
distance ``d`` from a pivot, the triangle inequality says that no vector of the cell is nearer than ``d - greatest`` or
``least - d``, and a single vector at distance ``e`` from the pivot not nearer than ``|d - e|``.

The search goes in two rounds. In the first a query meets its own slot, cells with the least bounds first, which
gives it a distance of its ``k``-th hit; in the second it meets the other slots with that bound, and only cells and
vectors that can still be hits are compared. Rows are those of the full search: bounds have a margin for rounding, and equal
distances go to the smaller id.

Visits are never rows: queries and slots meet in groups of bounded bytes, and a row is copied once for each group it is in, of which
there are at most ``PARTS`` of queries and ``knn.CUTS`` of vectors until groups reach their limit in bytes. So where bounds leave out nothing, time
grows with the pairs, but rows moved with the rows; such queries are compared with a whole slot in large products of
matrices, which take a few times less than cells one by one. Nothing but the pivots is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sparkrank.operators import knn
from sparkrank.operators.skew import broadcast_if_small
from sparkrank.sources.collection import checkpointed

MAX_PIVOTS = 2_048
PIVOT_BYTES = 16 << 20
MAX_CELLS = 128  # of a slot
SLOT_VECTORS = 10_000
QUERY_BLOCK = 10_000  # queries that meet a slot in a task
PARTS = 8  # of the queries that meet a slot, while they are below their limit in bytes: more groups than cores, so that these are evenly busy
FEW_GROUPS = 256
SPREAD = 4  # partitions for each of few groups
HOME_QUERIES = 2_500  # queries that meet their own slot in a task, of which there are fewer tasks
GROUP = 1_024  # queries near one pivot that go through the cells together
FIRST_CELLS = 4  # looked at before bounds of queries without a limit are judged
PLAIN = 0.4  # the share of the vectors from which on a query is compared with all of them
BROADCAST_SPOTS = 1_000_000
MARGIN = 1e-9


def sound(vector: Column | str) -> Column:
    """Whether a vector has components, all of them finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` to all rows of ``b``, from the differences themselves."""
    out = np.empty((len(a), len(b)))
    step = (1 << 17) // max(a.shape[1] * len(b), 1)  # differences that stay in the cache
    if step:
        for i in range(0, len(a), step):
            part = a[i : i + step, None, :] - b[None, :, :]
            out[i : i + step] = np.sqrt(np.einsum("ijk,ijk->ij", part, part))
    else:
        for j in range(len(a)):
            gap = b - a[j]
            out[j] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def _nearest_pivots(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row and the distance to it."""
    at, away = np.empty(len(rows), np.int64), np.empty(len(rows))
    for i in range(0, len(rows), 2_048):
        part = distances(rows[i : i + 2_048], pivots)
        at[i : i + 2_048] = part.argmin(axis=1)
        away[i : i + 2_048] = part.min(axis=1)
    return at, away


def _in_order(pivots: np.ndarray) -> np.ndarray:
    """Pivots so that near ones follow each other: halved along their widest axis again and again."""
    def halve(rows: np.ndarray) -> list[int]:
        if len(rows) <= 2:
            return rows.tolist()
        axis = np.ptp(pivots[rows], axis=0).argmax()
        rows = rows[np.argsort(pivots[rows, axis], kind="stable")]
        half = len(rows) // 2
        return halve(rows[:half]) + halve(rows[half:])

    return pivots[halve(np.arange(len(pivots)))]


def _placed(df: DataFrame, pivots, metric: str) -> DataFrame:
    """Rows with ``spot``, the number of the nearest pivot."""
    def run(batches):
        for batch in batches:
            rows = knn._matrix(batch.column("embedding"))
            spots = _nearest_pivots(knn._unit(rows) if metric == "cosine" else rows, pivots.value)[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spots.astype(np.int32))], names=[*batch.schema.names, "spot"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("spot", IntegerType())]))


def _search(k: int, metric: str, counter) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The best ``k`` of a slot for each query that meets it."""

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return knn.HITS_ARROW.empty_table()
        rows, (ids, tags) = knn.sound_rows(vectors, "_id", "ticker")
        asked, (names, limits) = knn.sound_rows(queries, "query_id", "most")
        few = knn.fewest_copies(rows, ids, k)  # or each query near a group of copies would pick them all
        rows, ids, tags = rows[few], ids.take(pa.array(few)), tags.take(pa.array(few))
        if metric == "cosine":
            rows, asked = knn._unit(rows), knn._unit(asked)
        n = len(rows)
        pivots = rows[np.unique(np.linspace(0, n - 1, min(n, MAX_CELLS, int(2 * np.sqrt(n)) + 1)).astype(int))]
        cell, along = _nearest_pivots(rows, pivots)
        order = np.lexsort((along, cell))
        rows, cell, along = rows[order], cell[order], along[order]
        ids, tags = ids.take(pa.array(order)), tags.take(pa.array(order))
        used, starts = np.unique(cell, return_index=True)
        ends, pivots = np.append(starts[1:], n), pivots[used]
        least, most = along[starts], along[ends - 1]

        best = knn.Nearest(ids, rows, asked, k, metric, limits.to_numpy(zero_copy_only=False))
        home = _nearest_pivots(asked, pivots)[0]
        by_home = np.argsort(home, kind="stable")
        plain = []
        for group in np.split(by_home, np.flatnonzero(np.diff(home[by_home])) + 1):
            for i in range(0, len(group), GROUP):
                plain.append(_visit(best, group[i : i + GROUP], pivots, least, most, along, starts, ends))
        plain = np.concatenate(plain)
        best.again(plain)
        best.compare(plain, np.arange(len(rows)))
        if counter is not None:
            counter.add(best.compared)
        return best.table(names, ids, tags)

    return run


def _visit(best: knn.Nearest, group: np.ndarray, pivots, least, most, along, starts, ends) -> np.ndarray:
    """The cells that can hold hits of some queries, those with the least bounds first.

    Once all queries have ``k`` hits, some cells are looked at together, and compared as one where most queries need most of them.
    Returns the queries whose bounds then leave out too little: all vectors in large blocks take less time than cells one by one.
    """
    away = distances(best.asked[group], pivots)
    bounds = np.maximum(np.maximum(away - most, least - away), 0)
    order = np.lexsort((away.mean(axis=0), bounds.mean(axis=0)))
    sizes = np.cumsum((ends - starts)[order])
    i, plain = 0, None
    while i < len(order) and len(group):
        # distances were rounded
        reach = np.sqrt(best.worst[group] + 4 * 10.0**-knn.DISTANCE_DIGITS) * (1 + MARGIN) + MARGIN
        until = i + 1
        if np.isfinite(reach).all():
            if plain is None and (i == 0 or i >= FIRST_CELLS):
                needed = (bounds <= reach[:, None]) @ (ends - starts)
                plain = group[needed > PLAIN * sizes[-1]]
                kept = needed <= PLAIN * sizes[-1]
                group, away, bounds, reach = group[kept], away[kept], bounds[kept], reach[kept]
                continue
            until = max(until, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + knn.CELL_BLOCK, side="right")))
        cells, i = order[i:until], until
        need = bounds[:, cells] <= reach[:, None]
        parts = []
        for c, own in zip(cells.tolist(), need.T):
            inside, d, r = along[starts[c] : ends[c]], away[own, c], reach[own]
            lo, hi = (np.searchsorted(inside, (d - r).min()), np.searchsorted(inside, (d + r).max(), side="right")) if len(d) else (0, 0)
            parts.append(np.arange(starts[c] + lo, starts[c] + hi))
        any_cell = need.any(axis=1)
        pairs = sum(n * len(p) for n, p in zip(need.sum(axis=0).tolist(), parts))
        if len(parts) == 1 or 2 * pairs > any_cell.sum() * sum(map(len, parts)):
            best.compare(group[any_cell], np.concatenate(parts))
        else:
            for own, part in zip(need.T, parts):
                best.compare(group[own], part)
    return group[:0] if plain is None else plain


def _scope(tag: str) -> Column:
    return F.coalesce(F.concat(F.lit("tag:"), F.col(tag)), F.lit("all"))


def _dealt(name: str, n: Column) -> Column:
    return F.pmod(F.xxhash64(name), n).cast("int")


def _numbers(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def _with_slots(df: DataFrame, name: str, spots: DataFrame | None) -> DataFrame:
    """Rows of a scope with their slot; those near one pivot are in one slot, or dealt over as many as they fill."""
    if spots is None:
        return df.withColumn("slot", F.lit(0))
    known = df.join(spots, ["scope", "spot"], "left")
    slot = F.coalesce(F.col("first") + _dealt(name, F.col("span")), _dealt(name, F.col("slots")))
    return known.withColumn("slot", slot.cast("int")).drop("first", "span", "spot")


def nearest(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 100,
    *,
    metric: str = "l2",
    max_pivots: int = MAX_PIVOTS,
    cell_bytes: int = knn.CELL_BYTES,
    query_block: int = QUERY_BLOCK,
    counter=None,
) -> DataFrame:
    """The rows of :func:`knn.nearest`, found by distance bounds.

    ``counter``, an accumulator, sums up the vectors that were compared with queries.
    """
    spark = queries.sparkSession
    known = checkpointed(vectors.select("_id", "ticker", "embedding").filter(sound("embedding")))
    asked = checkpointed(queries.select("query_id", _scope("ticker").alias("scope"), "embedding").filter(sound("embedding")))
    asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])  # queries may be the vectors themselves
    width, total = known.agg(F.max(F.size("embedding")), F.count(F.lit(1))).first()
    if width is None:
        return _none(queries)
    scopes = F.explode(F.array_distinct(F.array(F.lit("all"), _scope("ticker")))).alias("scope")
    # only scopes that are asked for
    parts = knn.cuts(F.col("n_asked"), query_block, 8 * width + 16 * k, cell_bytes, PARTS)
    sizes = known.select(scopes).groupBy("scope").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.join(asked.groupBy("scope").agg(F.count(F.lit(1)).alias("n_asked")), "scope")
    slots = knn.cuts(F.col("n"), SLOT_VECTORS, 8 * width, cell_bytes)
    sizes = broadcast_if_small(sizes.select("scope", "n", slots.alias("slots"), parts.alias("parts")), knn.BROADCAST_TAGS)
    most_slots, groups = sizes.agg(F.max("slots"), F.sum(F.col("slots") * F.col("parts"))).first()
    several, groups = (most_slots or 1) > 1, groups or 1

    spots = None
    held, wanted = known, asked
    if several:
        n_pivots = min(max_pivots, int(np.ceil(np.sqrt(total))), max(PIVOT_BYTES // (8 * width), 1))
        sample = known.orderBy(F.xxhash64("_id"), "_id").limit(n_pivots).select("embedding").toArrow()
        books = knn._matrix(sample["embedding"])
        shared = spark.sparkContext.broadcast(_in_order(knn._unit(books) if metric == "cosine" else books))
        held, wanted = _placed(known, shared, metric), _placed(asked, shared, metric)
        spots = _spots(held.select("spot", scopes).join(sizes.filter("slots > 1"), "scope"))
    held = _with_slots(held.select("*", scopes).join(sizes, "scope"), "_id", spots).drop("n")
    wanted = _with_slots(wanted.join(sizes, "scope"), "query_id", spots).drop("n")
    if several:
        wanted = checkpointed(wanted)
    search, keys = _search(k, metric, counter), ["scope", "slot", "block"]

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        if groups <= FEW_GROUPS:  # small in bytes, but not in time: most go to a task of their own
            left, right = (side.repartition(SPREAD * int(groups), *keys) for side in (left, right))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, knn.HITS)

    left = held.select("_id", "ticker", "embedding", "scope", "slot")
    right = wanted.withColumn("most", F.lit(float("inf")))
    homes = broadcast_if_small(
        wanted.groupBy("scope", "slot").agg(knn.cuts(F.count(F.lit(1)), min(query_block, HOME_QUERIES), 8 * width + 16 * k, cell_bytes, PARTS).alias("blocks")), BROADCAST_SPOTS
    )
    right = right.drop("slots", "parts").join(homes, ["scope", "slot"]).withColumn("block", _dealt("query_id", F.col("blocks"))).drop("blocks")
    left = left.join(homes, ["scope", "slot"]).withColumn("block", _numbers("blocks")).drop("blocks")
    found = checkpointed(knn._ranked(met(left, right), k, "query_id"))
    if not several:
        return found

    # a query without k hits yet has no bound
    reached = found.groupBy("query_id").agg(F.max("distance").alias("worst"), F.count(F.lit(1)).alias("hits"))
    most = F.when(F.col("hits") >= k, F.col("worst") * (2.0 if metric == "cosine" else 1.0)).otherwise(F.lit(float("inf")))
    limited = wanted.filter("slots > 1").join(reached.select("query_id", most.alias("most")), "query_id", "left")
    others = F.explode(F.filter(F.sequence(F.lit(0), F.col("slots") - 1), lambda s: s != F.col("home")))
    right = limited.withColumnRenamed("slot", "home").withColumn("slot", others).withColumn("block", _dealt("query_id", F.col("parts")))
    right = right.withColumn("most", F.coalesce("most", F.lit(float("inf")))).drop("slots", "parts", "home")
    left = held.filter("slots > 1").select("_id", "ticker", "embedding", "scope", "slot", _numbers("parts").alias("block"))
    return checkpointed(knn._ranked(met(left, right).unionByName(found.drop("rank")), k, "query_id"))


def _spots(rows: DataFrame) -> DataFrame:
    """``scope, spot, first, span``: the slots that the vectors near a pivot fill, from counts in the order of pivots."""
    counts = rows.groupBy("scope", "spot", "n", "slots").agg(F.count(F.lit(1)).alias("own"))
    # one row for each pivot of a scope
    until = F.sum("own").over(W.partitionBy("scope").orderBy("spot"))
    last = F.floor((until - 1) * F.col("slots") / F.col("n"))
    first = F.floor((until - F.col("own")) * F.col("slots") / F.col("n"))
    spots = counts.select("scope", "spot", first.cast("int").alias("first"), (last - first + 1).cast("int").alias("span"))
    return broadcast_if_small(spots, BROADCAST_SPOTS)


def _none(queries: DataFrame) -> DataFrame:
    return queries.sparkSession.createDataFrame([], knn.HITS + ", rank int")
