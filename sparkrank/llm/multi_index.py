"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut into two halves, each quantised by its own k-means, so a cell is a pair
of centroids. A query visits cells in the order of the summed distances of its halves to
the centroids, found with a heap over the sorted centroids of both sides, until the
cells hold the wanted share of all entries, and ``k + 1`` at least. Entries of visited cells are ranked by their exact
distances.

Codebooks are fitted on a bounded sample (``SAMPLE`` distinct vectors by the hash of
their ids) with a fixed number of centroids; with the number of entries of each cell
they are all that is broadcast. Every vector is indexed. Equal vectors are one entry, which keeps
their ``k + 1`` smallest ids: more can never be among the nearest. Large cells are dealt over
blocks, and so are the queries that meet in one, so groups have a fixed size.

``VISIT`` decides recall. Independent random directions, the hardest case, need a large
share; data with clusters reach the same recall with far less.

Defined cases: vectors that are null, zero, or hold null or non-finite components
take no part, nor do rows without an id, nor those whose length is not the most frequent one; repeated
rows are one; of two rows that share an id neither is a neighbour of the other; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrank.llm.common import sorted_groups, stored

K = 10
SAMPLE = 8192
CENTROIDS = 16  # of each half
VISIT = 0.65  # share of the entries in visited cells
BLOCK = 2048  # entries of a cell in a group
QUERIES = 4096  # queries in a group


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``."""
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T, 0)


def kmeans(points: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        nearest = squared(points, centres).argmin(1)
        for j in range(len(centres)):
            if (nearest == j).any():
                centres[j] = points[nearest == j].mean(0)
    return centres


class Codebooks:
    """Centroids of the two halves, and the number of entries in each pair's cell."""

    def __init__(self, sample: np.ndarray, k: int = CENTROIDS):
        self.half = max(1, sample.shape[1] // 2)
        self.books = [kmeans(part, k) for part in self.halves(sample)]
        self.width = len(self.books[1])
        self.counts = np.zeros(len(self.books[0]) * self.width, np.int64)

    def arrays(self) -> tuple:
        """What a broadcast holds: an instance would need this module on the workers."""
        return self.half, self.books, self.counts

    @classmethod
    def of(cls, arrays: tuple) -> Codebooks:
        out = cls.__new__(cls)
        out.half, out.books, out.counts = arrays
        out.width = len(out.books[1])
        return out

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[:, : self.half], vectors[:, self.half :]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        a, b = (squared(part, book).argmin(1) for part, book in zip(self.halves(vectors), self.books, strict=True))
        return a * self.width + b

    def visit(self, vector: np.ndarray, wanted: float) -> list[int]:
        """Cells with entries, nearest pairs first, until they hold ``wanted`` entries."""
        near = [squared(part, book)[0] for part, book in zip(self.halves(vector[None, :]), self.books, strict=True)]
        order = [np.argsort(d, kind="stable") for d in near]
        first, second = (d[o] for d, o in zip(near, order, strict=True))
        heap, seen, cells, total = [(first[0] + second[0], 0, 0)], {(0, 0)}, [], 0
        while heap and total < wanted:
            _, i, j = heapq.heappop(heap)
            cell = int(order[0][i] * self.width + order[1][j])
            if self.counts[cell]:
                cells.append(cell)
                total += int(self.counts[cell])
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(first) and b < len(second) and (a, b) not in seen:
                    seen.add((a, b))
                    heapq.heappush(heap, (first[a] + second[b], a, b))
        return cells


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assign(books):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Codebooks.of(books.value)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(1))
                yield pa.RecordBatch.from_pydict({"id": batch.column(0), "cell": pa.array(known.cells(vectors), pa.int64()), "vector": pa.array([v.tobytes() for v in vectors], pa.binary())})

    return run


def _visit(books, wanted: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Codebooks.of(books.value)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(1))
                cells = pa.array([known.visit(v, wanted) for v in vectors], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict({"id": batch.column(0), "cells": cells, "vector": pa.array([v.tobytes() for v in vectors], pa.binary())})

    return run


def _rank(k: int):
    """The ``k`` nearest entries of a group for each of its queries."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["cell", "block", "part"]):
            asks = group["asks"]
            if asks.all() or not asks.any():
                continue
            vectors = np.frombuffer(b"".join(group["vector"]), np.float64).reshape(len(asks), -1)
            entries, ids = vectors[~asks], group["id"][~asks]
            out = [[], [], []]
            queries = np.flatnonzero(asks)
            for at in range(0, len(queries), 256):
                rows = queries[at : at + 256]
                rough = squared(vectors[rows], entries)
                limit = np.partition(rough, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
                for row, near, most in zip(rows, rough, limit, strict=True):
                    picked = np.flatnonzero(near <= most + 1e-9 * (1 + most))
                    exact = np.sqrt(((entries[picked] - vectors[row]) ** 2).sum(1))
                    best = np.lexsort((ids[picked], exact))[:k]
                    out[0].append(np.full(len(best), group["id"][row]))
                    out[1].append(ids[picked][best])
                    out[2].append(exact[best])
            yield pa.RecordBatch.from_pydict({n: np.concatenate(c) for n, c in zip(("query_id", "entry", "score"), out, strict=True)})

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter("id is not null and vector is not null").filter(finite & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return rows.filter(F.size("vector") == (sizes.size if sizes else 0))


def nearest(
    vectors: DataFrame, asked, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", visit: float = VISIT, centroids: int = CENTROIDS, sample: int = SAMPLE
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows for which ``asked``, a condition on ``id``, holds."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors, id_col, vector_col).distinct(), "vectors")
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).filter(F.col("r") <= k + 1)
    entries = first.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    entries = stored(entries.select(F.col("ids")[0].alias("id"), "ids", "vector"), "entries")
    picked = entries.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").collect()
    if not picked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    books = Codebooks(np.array([r.vector for r in picked]), centroids)
    assigned = stored(entries.select("id", "vector").mapInArrow(_assign(spark.sparkContext.broadcast(books.arrays())), "id long, cell long, vector binary"), "cells")
    for r in assigned.groupBy("cell").agg(F.count("*").alias("n")).collect():
        books.counts[r.cell] = r.n
    shared = spark.sparkContext.broadcast(books.arrays())
    asking = rows.filter(asked)
    parts = max(1, -(-asking.count() // QUERIES))
    sizes = F.broadcast(spark.createDataFrame([(c, -(-int(n) // BLOCK)) for c, n in enumerate(books.counts) if n], "cell long, blocks int"))
    dealt = assigned.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    stock = dealt.select("cell", "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(False).alias("asks"), "id", "vector")
    visits = asking.select("id", "vector").mapInArrow(_visit(shared, max(visit * int(books.counts.sum()), k + 1)), "id long, cells array<long>, vector binary")
    visits = visits.select("id", "vector", F.explode("cells").alias("cell")).join(sizes, "cell")
    visits = visits.select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), F.lit(True).alias("asks"), "id", "vector")
    keys = ["cell", "block", "part"]
    met = stock.union(visits).repartition(*keys).sortWithinPartitions(*keys)
    ranked = met.mapInArrow(_rank(k + 1), "query_id long, entry long, score double")
    # the nearest k + 1 entries of a query hold its nearest k rows
    order = Window.partitionBy("query_id").orderBy("score", "entry")
    best = ranked.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).drop("r")
    named = best.join(entries.select(F.col("id").alias("entry"), "ids"), "entry").select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    # an id that several different vectors share counts with its nearest
    named = named.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return named.select("query_id", F.row_number().over(final).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
