"""Search by bounds against the full search."""

import numpy as np
import pyarrow as pa
import pytest

from sparkrank.operators import knn, pruned


def clustered(spark, n, seed=0, dim=16, centres=12):
    """Vectors around a few centres, with ties, repeated vectors and broken ones."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim)) * 10
    rows = middle[rng.integers(0, centres, n)] + rng.normal(size=(n, dim))
    rows[n // 2 : n // 2 + 20] = rows[0]
    data = [(f"v{i}", ("a", "a", "b", None)[i % 4], r.tolist()) for i, r in enumerate(rows)]
    data += [("nan", "a", [float("nan")] * dim), ("none", "a", None), ("gap", "b", [None] * dim), ("lone", "c", [1.0] * dim)]
    return spark.createDataFrame(data, "_id string, ticker string, embedding array<double>")


def rows(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "corpus_id", "distance").collect())


@pytest.mark.parametrize(("metric", "k"), [("l2", 7), ("cosine", 7), ("l2", 400)])
def test_same_rows_as_the_full_search(spark, metric, k):
    vectors = clustered(spark, 600)
    queries = vectors.filter("_id rlike '5$' or _id in ('lone', 'nan', 'none', 'v0', 'v3')").withColumnRenamed("_id", "query_id")
    small = {"cell_bytes": 4_000, "query_block": 7} if k == 7 else {}
    got = pruned.nearest(queries, vectors, k, metric=metric, **small)
    assert rows(got) == rows(knn.nearest(queries, vectors, k, metric=metric, strategy="broadcast"))


def test_few_distances_on_clustered_vectors(spark):
    vectors = clustered(spark, 4_000, dim=8, centres=40)
    queries = vectors.filter("_id rlike '^v[0-9]*5$'").withColumnRenamed("_id", "query_id")
    pairs = queries.groupBy("ticker").count().collect()
    sizes = {r.ticker: r["count"] for r in vectors.filter("_id like 'v%'").groupBy("ticker").count().collect()}
    every = sum(r["count"] * (sizes[r.ticker] if r.ticker else sum(sizes.values())) for r in pairs)
    counter = spark.sparkContext.accumulator(0)
    got = pruned.nearest(queries, vectors, 10, counter=counter)
    assert rows(got) == rows(knn.nearest(queries, vectors, 10, strategy="broadcast"))
    assert 0 < counter.value < 0.3 * every


def test_nothing_to_search(spark):
    vectors = clustered(spark, 40)
    queries = vectors.withColumnRenamed("_id", "query_id")
    assert pruned.nearest(queries, vectors.filter("false"), 3).count() == 0
    assert pruned.nearest(queries.filter("false"), vectors, 3).count() == 0
    assert pruned.nearest(queries.filter("ticker = 'c'"), vectors.filter("ticker = 'a'"), 3).count() == 0


def test_large_query_sets_take_the_bounds(spark, monkeypatch):
    vectors = clustered(spark, 60)
    queries = vectors.withColumnRenamed("_id", "query_id")
    called = []
    monkeypatch.setattr(pruned, "nearest", lambda *a, **b: called.append(1) or queries)
    knn.nearest(queries, vectors, 3, max_queries=5)
    assert called


def test_rows_moved_do_not_grow_with_the_pairs(spark, monkeypatch):
    """On vectors without structure, bounds leave out nothing; queries times pivots were written as rows."""
    rng = np.random.default_rng(1)
    data = [(f"v{i}", None, r.tolist()) for i, r in enumerate(rng.normal(size=(400, 32)))]
    vectors = spark.createDataFrame(data, "_id string, ticker string, embedding array<double>")
    queries = vectors.withColumnRenamed("_id", "query_id")
    written, write = [], pruned.checkpointed

    def counted(df):
        out = write(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(pruned, "checkpointed", counted)
    got = pruned.nearest(queries, vectors, 3, cell_bytes=128 * 256)  # four slots
    assert rows(got) == rows(knn.nearest(queries, vectors, 3, strategy="broadcast"))
    assert max(written) <= 3 * 400


def _found(queries, vectors, k, metric="l2", limits=None):
    best = knn.Nearest(pa.array([f"v{i:05}" for i in range(len(vectors))]), vectors, queries, k, metric, limits)
    best.compare(np.arange(len(queries)), np.arange(len(vectors)))
    return best


def _full(queries, vectors, k):
    rows = [np.round(((vectors - q) ** 2).sum(axis=1), knn.DISTANCE_DIGITS) for q in queries]
    return [sorted(zip(d.tolist(), range(len(d))))[:k] for d in rows]


@pytest.mark.parametrize(("offset", "spread"), [(0.0, 1.0), (1e4, 1e-3), (0.0, 1e-7), (1e120, 0.0), (0.0, 1e30)])
def test_single_precision_loses_no_hit(offset, spread):
    """Vectors too close together, too long or too short for it, and copies, next to ordinary ones."""
    rng = np.random.default_rng(3)
    vectors = offset + spread * rng.normal(size=(3_000, 6))
    vectors[100:140] = vectors[7]
    vectors[:5] = rng.normal(size=(5, 6))
    queries = np.concatenate([vectors[5:200:4], offset + spread * rng.normal(size=(40, 6))])
    if not offset > 1e100:
        best = _found(queries, vectors, 9)
        assert [list(zip(d, p)) for d, p in zip(best.distance.tolist(), best.place.tolist())] == _full(queries, vectors, 9)
    else:  # squares of differences are exact only where nothing overflows
        assert _found(queries, vectors, 9).single is None


def test_only_hits_are_picked(monkeypatch):
    """Limits of the first blocks let through most of a block, whose differences were all taken."""
    rng = np.random.default_rng(4)
    vectors, queries = rng.normal(size=(6_000, 32)), rng.normal(size=(300, 32))
    picked, merge = [], knn.Nearest._merge
    monkeypatch.setattr(knn.Nearest, "_merge", lambda self, q, p: picked.append(len(q)) or merge(self, q, p))
    best = _found(queries, vectors, 5, limits=np.full(300, 60.0))
    assert [list(zip(d, p)) for d, p in zip(best.distance.tolist(), best.place.tolist())] == _full(queries, vectors, 5)
    assert sum(picked) <= 300 * 5 * 2 * 3  # twice k a block


def test_copies_that_cannot_be_hits_are_left_out():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(50, 4))
    rows[10:] = rows[3]
    ids = pa.array([f"v{(7 * i) % 50:02}" for i in range(50)])
    few = knn.fewest_copies(rows, ids, 3)
    copies = sorted([3, *range(10, 50)], key=lambda i: (7 * i) % 50)[:3]
    assert few.tolist() == sorted({0, 1, 2, 4, 5, 6, 7, 8, 9, *copies})


def test_queries_whose_bounds_leave_out_nothing_meet_few_blocks(spark, monkeypatch):
    """On vectors without structure, cells one by one took most of the time, and few groups shared a task."""
    rng = np.random.default_rng(6)
    data = [(f"v{i}", None, r.tolist()) for i, r in enumerate(rng.normal(size=(600, 32)))]
    vectors = spark.createDataFrame(data, "_id string, ticker string, embedding array<double>")
    queries = vectors.withColumnRenamed("_id", "query_id")
    table, limits = vectors.toArrow(), np.full(600, 60.0)
    asked = queries.toArrow().append_column("most", pa.array(limits))
    calls, compare = [], knn.Nearest.compare
    monkeypatch.setattr(knn.Nearest, "compare", lambda self, q, p: calls.append(len(q)) or compare(self, q, p))
    hits = pruned._search(3, "l2", None)(table, asked)
    assert calls == [600]
    got = pruned.nearest(queries, vectors, 3, cell_bytes=256 * 200)
    full = knn.nearest(queries, vectors, 3, strategy="broadcast")
    assert rows(got) == rows(full)
    assert sorted(zip(hits["query_id"].to_pylist(), hits["corpus_id"].to_pylist())) == sorted((r[0], r[2]) for r in rows(full))
