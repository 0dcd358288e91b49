"""Exact nearest neighbours within a tag.

Pairs of query and vector are never rows: blocks of vectors meet blocks of
queries inside a task, and only the best ``k`` of each query leave the task.

Three physical forms give the same rows:

* ``broadcast``: the query side was counted and is small. It travels with the
  task code, and the vectors are scanned once where they lie, without a shuffle.
* ``pruned``: any number of queries. Vectors lie in cells around pivots, and the
  triangle inequality leaves out cells and vectors that can't be hits; see
  :mod:`sparkrank.operators.pruned`.
* ``blocks``: any number of queries, each compared with every vector of its tag, for vectors
  without any structure. Both sides are cut into cells, so a tag that holds a third of all vectors becomes
  many cells. A row is copied for each cell of the other side, so a side is cut at most
  ``CUTS`` times; beyond that cells grow, up to their limit in bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkrank.operators.skew import broadcast_if_small

# Distances are compared after rounding, so that equal distances tie whatever
# the order of summation; ties go to the smaller id.
DISTANCE_DIGITS = 9

BROADCAST_QUERIES = 20_000
BROADCAST_BYTES = 64 << 20
BROADCAST_HITS = 500_000  # queries times k that one task may have to hold
BROADCAST_TAGS = 100_000
CELL_VECTORS = 200_000
CELL_QUERIES = 4_000
CELL_BYTES = 64 << 20  # of the vectors, or of the queries, of a cell in a worker
CUTS = 4  # parts of a side of a scope, and so copies of a row of the other side, while cells are below their limit in bytes
MERGE_GROUPS = 1_024  # groups of tasks whose hits are merged before the last step
QUERY_BLOCK = 256  # queries per matrix product
VECTOR_BLOCK = 8_192  # vectors per matrix product
CELL_BLOCK = 2_048  # the same where hits are arrays, so that a block stays in the cache
PICKS = 1 << 16  # pairs whose differences are held at once
MANY = 2  # picks of a query, as multiples of k, from which on the best k of the block are looked for first
FINE = 128  # one pick of so many pairs in single precision has a block compared in double precision

HITS = "query_id string, corpus_id string, ticker string, distance double"
HITS_ARROW = pa.schema(
    [
        ("query_id", pa.string()),
        ("corpus_id", pa.string()),
        ("ticker", pa.string()),
        ("distance", pa.float64()),
    ]
)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as one float matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.where(length > 0, length, 1.0)[:, None]


class _Best:
    """The best ``k`` rows seen so far of one group of queries."""

    def __init__(self, ids: list[str], rows: np.ndarray, k: int, metric: str):
        self.ids, self.k, self.metric = ids, k, metric
        # for vectors of length one, |a - b|^2 = 2 (1 - cos)
        self.scale = 0.5 if metric == "cosine" else 1.0
        self.rows = _unit(rows) if metric == "cosine" else rows
        self.squares = np.einsum("ij,ij->i", self.rows, self.rows)
        self.worst = np.full(len(ids), np.inf)
        self.found: list[list[tuple[float, str, str | None]]] = [[] for _ in ids]

    def add(self, ids: pa.Array, tags: pa.Array, rows: np.ndarray) -> None:
        """Compare with a batch; ids and tags stay Arrow, only picks become Python."""
        sound = np.isfinite(rows).all(axis=1)
        if not sound.all():
            where = pa.array(np.flatnonzero(sound))
            ids, tags, rows = ids.take(where), tags.take(where), rows[sound]
        for start in range(0, len(rows), VECTOR_BLOCK):
            part = slice(start, start + VECTOR_BLOCK)
            self._add_block(ids[part], tags[part], rows[part])

    def _add_block(self, ids: pa.Array, tags: pa.Array, rows: np.ndarray) -> None:
        if self.metric == "cosine":
            rows = _unit(rows)
        squares = np.einsum("ij,ij->i", rows, rows)
        for start in range(0, len(self.ids), QUERY_BLOCK):
            block = slice(start, start + QUERY_BLOCK)
            # one matrix product finds who can still be among the best ...
            near = self.squares[block, None] - 2.0 * (self.rows[block] @ rows.T) + squares[None, :]
            slack = 4e-9 + 1e-12 * (self.squares[block] + squares.max())
            limit = self.worst[block]
            if near.shape[1] > self.k:
                kth = np.partition(near, self.k - 1, axis=1)[:, self.k - 1]
                limit = np.minimum(limit, kth)
            wanted = near <= (limit + slack)[:, None]
            for i in np.flatnonzero(wanted.any(axis=1)):
                self._merge(start + i, np.flatnonzero(wanted[i]), ids, tags, rows)

    def _merge(self, query: int, picks: np.ndarray, ids, tags, rows) -> None:
        # ... and those get their distance from the differences themselves
        gap = rows[picks] - self.rows[query]
        exact = np.round((gap * gap).sum(axis=1) * self.scale, DISTANCE_DIGITS)
        where = pa.array(picks)
        named = zip(exact.tolist(), ids.take(where).to_pylist(), tags.take(where).to_pylist())
        merged = self.found[query] + list(named)
        merged.sort(key=lambda hit: hit[:2])
        self.found[query] = merged[: self.k]
        if len(merged) >= self.k:
            self.worst[query] = self.found[query][-1][0] / self.scale

    def table(self) -> pa.RecordBatch:
        rows = [(q, h) for q, hits in zip(self.ids, self.found) for h in hits]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([q for q, _ in rows], pa.string()),
                pa.array([h[1] for _, h in rows], pa.string()),
                pa.array([h[2] for _, h in rows], pa.string()),
                pa.array([h[0] for _, h in rows], pa.float64()),
            ],
            schema=HITS_ARROW,
        )


class Nearest:
    """The best ``k`` of the vectors of a cell for each of its queries, held as arrays.

    ``limits`` are squared distances beyond which a query wants no hit.
    """

    def __init__(self, ids: pa.Array, rows: np.ndarray, asked: np.ndarray, k: int, metric: str, limits: np.ndarray | None = None):
        self.k, self.scale = k, 0.5 if metric == "cosine" else 1.0
        self.rows, self.asked = (_unit(rows), _unit(asked)) if metric == "cosine" else (rows, asked)
        self.squares, self.asked_squares = (np.einsum("ij,ij->i", r, r) for r in (self.rows, self.asked))
        # ties go to the smaller id
        self.order = pc.rank(ids, sort_keys="ascending", tiebreaker="first").to_numpy(zero_copy_only=False)
        self.distance = np.full((len(asked), k), np.inf)
        self.place = np.full((len(asked), k), -1)
        self.worst = np.full(len(asked), np.inf) if limits is None else limits.copy()
        self.compared = 0
        self.single = self._in_single()
        self.near, self.wanted = np.empty(QUERY_BLOCK * CELL_BLOCK, np.float32), np.empty(QUERY_BLOCK * CELL_BLOCK, bool)

    def _in_single(self) -> tuple[np.ndarray, ...] | None:
        """Both sides in single precision, around the middle of the vectors and at most one long; the squares of the
        queries, what single precision may be wrong by, and the scale of squares. None if numbers are too large or small."""
        longest = np.sqrt(max(self.squares.max(initial=0), self.asked_squares.max(initial=0)))
        if not 1e-100 < longest < 1e100:
            return None
        middle = self.rows.mean(axis=0)
        scale = 0.5 ** np.ceil(np.log2(2 * longest))  # a power of two changes no digits
        rows, asked = (self.rows - middle) * scale, (self.asked - middle) * scale
        squares, own = (np.einsum("ij,ij->i", r, r) for r in (rows, asked))
        most = squares.max(initial=0)
        wrong = (rows.shape[1] + 8) * 2.0**-24 * (2 * np.sqrt(own * most) + most) + 1e-35
        # with a column for the squares, one product gives distances but for the square of the query
        rows = np.concatenate([rows, squares[:, None]], axis=1, dtype=np.float32)
        asked = np.concatenate([-2.0 * asked, np.ones((len(asked), 1))], axis=1, dtype=np.float32)
        return rows, asked, own, wrong, scale * scale

    def again(self, queries: np.ndarray) -> None:
        """Drops the hits of some queries, which are compared anew; what they told of the distance of hits stays."""
        self.distance[queries], self.place[queries] = np.inf, -1

    def compare(self, queries: np.ndarray, places: np.ndarray) -> None:
        """Some vectors against some queries."""
        self.compared += len(queries) * len(places)
        for j in range(0, len(places), CELL_BLOCK):
            part = places[j : j + CELL_BLOCK]
            rows = None if self.single is None else self.single[0][part]
            for i in range(0, len(queries), QUERY_BLOCK):
                self._block(queries[i : i + QUERY_BLOCK], part, rows)

    def _block(self, queries: np.ndarray, places: np.ndarray, rows: np.ndarray | None) -> None:
        # one matrix product in single precision finds who can still be among the best ...
        found = None if rows is None else self._coarse(queries, rows)
        if found is None or len(found) * FINE > len(queries) * len(places):  # many lie too close together for it
            found = self._fine(queries, places)
        at, found = np.divmod(found, len(places))
        for i in range(0, len(at), PICKS):
            self._merge(queries[at[i : i + PICKS]], places[found[i : i + PICKS]])

    def _coarse(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        _, asked, own, wrong, scale = self.single
        own, n = own[queries], len(queries) * len(rows)
        near = np.matmul(asked[queries], rows.T, out=self.near[:n].reshape(len(queries), -1))
        limit = self.worst[queries] * scale - own
        slack = 2 * wrong[queries] + 2.0**-22 * own + scale * self._slack(queries)
        return self._picks(near, limit, slack, self.wanted[:n].reshape(near.shape))

    def _fine(self, queries: np.ndarray, places: np.ndarray) -> np.ndarray:
        near = (-2.0 * self.asked[queries]) @ self.rows[places].T + self.squares[places]
        return self._picks(near, self.worst[queries] - self.asked_squares[queries], self._slack(queries))

    def _picks(self, near: np.ndarray, limit: np.ndarray, slack: np.ndarray, wanted: np.ndarray | None = None) -> np.ndarray:
        """Places in ``near`` of what is within the limits, or within those of the best ``k`` here where these leave out little."""

        def within(limit: np.ndarray) -> np.ndarray:
            # rounded up to the precision of the product
            most = np.nextafter((limit + slack).astype(near.dtype), near.dtype.type(np.inf))
            return np.less_equal(near, most[:, None], out=wanted)

        found = within(limit)
        if near.shape[1] > self.k and np.count_nonzero(found) > MANY * self.k * len(near):
            found = within(np.minimum(limit, np.partition(near, self.k - 1, axis=1)[:, self.k - 1]))
        return np.flatnonzero(found)

    def _slack(self, queries: np.ndarray) -> np.ndarray:
        return 4e-9 + 1e-12 * (self.asked_squares[queries] + self.squares.max())

    def _merge(self, queries: np.ndarray, places: np.ndarray) -> None:
        # ... and those get their distance from the differences themselves
        gap = self.rows[places] - self.asked[queries]
        exact = np.round((gap * gap).sum(axis=1) * self.scale, DISTANCE_DIGITS)
        kept = exact <= self.distance[queries, -1]
        own, numbers = np.unique(queries[kept], return_inverse=True)
        held = self.place[own] >= 0
        number = np.concatenate([np.nonzero(held)[0], numbers])
        exact = np.concatenate([self.distance[own][held], exact[kept]])
        places = np.concatenate([self.place[own][held], places[kept]])
        sort = np.lexsort((self.order[places], exact, number))
        number = number[sort]
        nth = np.arange(len(number)) - np.searchsorted(number, number)
        best = nth < self.k
        to = own[number[best]], nth[best]
        self.distance[to], self.place[to] = exact[sort][best], places[sort][best]
        self.worst[own] = np.minimum(self.worst[own], self.distance[own, -1] / self.scale)

    def table(self, names: pa.Array, ids: pa.Array, tags: pa.Array) -> pa.Table:
        """Hits with the names of queries, and ids and tags of vectors."""
        query, nth = np.nonzero(self.place >= 0)
        at = pa.array(self.place[query, nth])
        return pa.Table.from_arrays([names.take(pa.array(query)), ids.take(at), tags.take(at), pa.array(self.distance[query, nth])], schema=HITS_ARROW)


def sound_rows(rows: pa.Table, *columns: str) -> tuple[np.ndarray, list[pa.Array]]:
    """The vectors of finite numbers of a table, and other columns of their rows."""
    matrix = _matrix(rows["embedding"])
    at = np.flatnonzero(np.isfinite(matrix).all(axis=1))
    return matrix[at], [rows[c].combine_chunks().take(pa.array(at)) for c in columns]


def fewest_copies(rows: np.ndarray, ids: pa.Array, k: int) -> np.ndarray:
    """Places of the vectors that can be among the best ``k``: of equal ones, those with the smallest ids."""
    data = pa.py_buffer(np.ascontiguousarray(rows, np.float64))
    equal = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * rows.shape[1]), len(rows), [None, data])
    codes = equal.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    if np.bincount(codes, minlength=1).max() <= k:
        return np.arange(len(rows))
    order = pc.rank(ids, sort_keys="ascending", tiebreaker="first").to_numpy(zero_copy_only=False)
    sort = np.lexsort((order, codes))
    nth = np.arange(len(rows)) - np.searchsorted(codes[sort], codes[sort])
    return np.sort(sort[nth < k])


def cuts(n: Column, rows: int, row_bytes: int, most_bytes: int = CELL_BYTES, most: int | None = None) -> Column:
    """Parts of ``n`` rows: of ``rows`` rows each, but no more than ``most`` (``CUTS``) unless the limit in bytes asks for them."""
    return F.greatest(F.least(F.ceil(n / F.lit(rows)), F.lit(CUTS if most is None else most)), F.ceil(n * F.lit(row_bytes / most_bytes)), F.lit(1)).cast("int")


def _scan(vectors: DataFrame, queries: pa.Table, k: int, metric: str) -> DataFrame:
    """Best ``k`` per query and task, for queries that travel with the code."""
    groups: dict[str | None, tuple[list[str], np.ndarray]] = {}
    tags = np.array(queries["ticker"].to_pylist(), dtype=object)
    ids = queries["query_id"].to_pylist()
    rows = _matrix(queries["embedding"])
    for tag in set(tags):
        at = [i for i, t in enumerate(tags) if t == tag]
        groups[tag] = ([ids[i] for i in at], rows[at])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {tag: _Best(*group, k, metric) for tag, group in groups.items()}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            corpus_ids, tags = batch.column("_id"), batch.column("ticker")
            matrix = _matrix(batch.column("embedding"))
            if None in best:
                best[None].add(corpus_ids, tags, matrix)
            coded = tags.dictionary_encode()
            codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            for code, tag in enumerate(coded.dictionary.to_pylist()):
                if tag not in best:
                    continue
                at = np.flatnonzero(codes == code)
                if len(at) == len(codes):  # a file of one tag needs no copy
                    best[tag].add(corpus_ids, tags, matrix)
                else:
                    where = pa.array(at)
                    best[tag].add(corpus_ids.take(where), tags.take(where), matrix[at])
        for state in best.values():
            yield state.table()

    wanted = sorted(tag for tag in groups if tag is not None)
    if None not in groups and len(wanted) <= 1_000:
        vectors = vectors.filter(F.col("ticker").isin(wanted))  # prunes tag partitions
    return vectors.filter(F.col("embedding").isNotNull()).mapInArrow(scan, HITS)


def _cells(
    queries: DataFrame, vectors: DataFrame, k: int, metric: str, cell_vectors: int, cell_queries: int, width: int
) -> DataFrame:
    """Best ``k`` per query and cell; a tag is cut as :func:`cuts` says."""

    def parts(rows: int, more: int = 0):
        return cuts(F.count(F.lit(1)), rows, 8 * width + more)

    def slot(column: str, n: str):
        return F.pmod(F.xxhash64(column), F.col(n)).cast("int")

    def numbers(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    by_tag = F.concat(F.lit("tag:"), F.col("ticker"))
    scoped = queries.select(
        "query_id", "embedding", F.coalesce(by_tag, F.lit("all")).alias("scope")
    )
    # one row per tag; counting reads no vectors, as those without one only make
    # a cell smaller
    query_parts = broadcast_if_small(
        scoped.groupBy("scope").agg(parts(cell_queries, 16 * k).alias("query_parts")), BROADCAST_TAGS
    )
    vector_parts = broadcast_if_small(
        vectors.groupBy("ticker").agg(parts(cell_vectors).alias("vector_parts")), BROADCAST_TAGS
    )
    scopes = F.explode(F.array(F.lit("all"), by_tag)).alias("scope")

    left = (
        vectors.filter(F.col("embedding").isNotNull()).join(vector_parts.withColumnRenamed("ticker", "__t"), F.col("ticker").eqNullSafe(F.col("__t")))
        .withColumn("slot", slot("_id", "vector_parts"))
        .select("_id", "ticker", "embedding", "slot", scopes)
        .join(query_parts, "scope")
        .select("_id", "ticker", "embedding", "slot", "scope", numbers("query_parts").alias("block"))
    )
    cells = vector_parts.select("ticker", numbers("vector_parts").alias("slot")).select(
        "ticker", "slot", scopes
    )
    right = (
        scoped.join(query_parts, "scope")
        .withColumn("block", slot("query_id", "query_parts"))
        .join(cells, "scope")
        .select(
            "query_id",
            "embedding",
            *[F.col(c).alias(c) for c in ("ticker", "slot", "scope", "block")],
        )
    )

    def score(vector_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        if vector_rows.num_rows == 0 or query_rows.num_rows == 0:
            return HITS_ARROW.empty_table()
        rows, (ids, tags) = sound_rows(vector_rows, "_id", "ticker")
        asked, (names,) = sound_rows(query_rows, "query_id")
        if not len(rows) or not len(asked):
            return HITS_ARROW.empty_table()
        few = fewest_copies(rows, ids, k)
        rows, ids, tags = rows[few], ids.take(pa.array(few)), tags.take(pa.array(few))
        best = Nearest(ids, rows, asked, k, metric)
        best.compare(np.arange(len(asked)), np.arange(len(rows)))
        return best.table(names, ids, tags)

    keys = ["scope", "block", "ticker", "slot"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, HITS)


def nearest(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 100,
    *,
    metric: str = "l2",
    strategy: str = "auto",
    max_queries: int = BROADCAST_QUERIES,
    max_bytes: int = BROADCAST_BYTES,
    cell_vectors: int = CELL_VECTORS,
    cell_queries: int = CELL_QUERIES,
) -> DataFrame:
    """The ``k`` nearest vectors of each query among those with its tag.

    ``queries`` has ``query_id, ticker, embedding`` (a null ticker searches all
    vectors), ``vectors`` has ``_id, ticker, embedding``. Returns ``query_id,
    corpus_id, ticker, distance, rank``; a tag with fewer vectors gives fewer
    rows. ``metric`` is ``l2`` (squared distance) or ``cosine`` (1 - cosine).
    Vectors and queries that are null or hold a null, NaN or infinite component
    take no part.

    ``auto`` reads at most ``max_queries + 1`` queries to learn whether the
    query side is small in rows, bytes and hits to hold, and takes ``blocks`` if
    it is not.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric: {metric}")
    if strategy not in ("auto", "broadcast", "pruned", "blocks"):
        raise ValueError(f"unknown strategy: {strategy}")
    queries = queries.select("query_id", "ticker", "embedding").filter(F.col("embedding").isNotNull())
    vectors = vectors.select("_id", "ticker", "embedding")

    probe = None
    if strategy in ("auto", "broadcast"):
        most = min(max_queries, max(BROADCAST_HITS // k, 1))
        probe = queries.limit(most + 1).toArrow()
        small = probe.num_rows <= most and probe.nbytes <= max_bytes
        if not small:
            if strategy == "broadcast":
                raise ValueError("the query side is too large to broadcast")
            probe = None
    if probe is not None:
        hits = _scan(vectors, probe, k, metric)
    elif strategy != "blocks":
        from sparkrank.operators import pruned  # it builds on this module

        return pruned.nearest(queries, vectors, k, metric=metric)
    else:
        width = vectors.filter(F.col("embedding").isNotNull()).select(F.size("embedding").alias("w")).first()
        hits = _cells(queries, vectors, k, metric, cell_vectors, cell_queries, max(width.w if width else 1, 1))

    # every task hands on k hits of a query, so they are merged in two steps: no
    # group of the first holds more than its share of the tasks
    grouped = hits.withColumn("__group", F.spark_partition_id() % MERGE_GROUPS)
    merged = _ranked(grouped, k, "query_id", "__group").drop("__group", "rank")
    return _ranked(merged, k, "query_id")


def _ranked(hits: DataFrame, k: int, *keys: str) -> DataFrame:
    nearest_first = W.partitionBy(*keys).orderBy("distance", "corpus_id")
    return hits.withColumn("rank", F.row_number().over(nearest_first)).filter(F.col("rank") <= k)
