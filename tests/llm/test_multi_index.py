"""Neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrank.llm import multi_index
from sparkrank.llm.queries import QUERIES


def brute(rows, k=10):
    """Nearest rows of each asked id; rows are (id, vector)."""
    out = {}
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    for i, v in rows:
        if i % 100 == 0:
            d = np.sqrt(((x - np.array(v)) ** 2).sum(1))
            other = ids != i
            order = np.lexsort((ids[other], d[other]))[:k]
            out[i] = list(zip(ids[other][order].tolist(), d[other][order].tolist(), strict=True))
    return out


def test_recall(spark, sf_dir):
    for path in (sf_dir, "/root/testdata/sf0.01"):
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
        truth = brute(rows)
        got = QUERIES["op5_multi_index"](spark, path).collect()
        found = {q: {r.vec_id for r in got if r.query_id == q} for q in truth}
        hits = sum(len(found[q] & {i for i, _ in near}) for q, near in truth.items())
        assert hits / sum(map(len, truth.values())) >= 0.9
        assert {r.query_id for r in got} == set(truth)


def test_all_cells_give_exact_results(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 6)).round(1)
    x[50:150] = x[0]  # ties: one very common vector
    rows = [(int(i), [float(f) for f in v]) for i, v in enumerate(x, 1)]
    odd = [(500, None), (501, []), (502, [0.0] * 6), (503, [float("nan")] * 6), (504, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (505, [1.0] * 5), (None, [1.0] * 6), (600, [float("inf")] * 6), rows[0]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("cell", F.lit(1))
    got = multi_index.nearest(df, F.col("id") % 100 == 0, visit=1.0)
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == brute(rows)
    assert multi_index.nearest(df.filter("false"), F.col("id") % 100 == 0).count() == 0
    few = multi_index.nearest(df.filter("vec_id in (100, 1, 2)"), F.col("id") % 100 == 0).collect()
    assert sorted(r.rank for r in few) == [1, 2]


def test_pairs_come_in_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8))
    books = multi_index.Codebooks(x, 7)
    cells = books.cells(x)
    books.counts += np.bincount(cells, minlength=len(books.counts))
    near = [multi_index.squared(p, b)[0] for p, b in zip(books.halves(x[:1]), books.books, strict=True)]
    sums = (near[0][:, None] + near[1][None, :]).ravel()
    visited = books.visit(x[0], 10**9)
    assert sorted(visited) == sorted(set(cells.tolist()))
    assert np.all(np.diff(sums[visited]) >= 0)
    assert sum(books.counts[c] for c in books.visit(x[0], 100)) >= 100


@pytest.mark.parametrize("n", [3, 5, 11, 15])
def test_few_distinct_vectors_give_all_candidates(spark, n):
    rng = np.random.default_rng(n)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(n)], "vec_id long, embedding array<double>")
    counts = {r.query_id: r["count"] for r in multi_index.nearest(df, F.lit(True)).groupBy("query_id").count().collect()}
    assert counts == {i: min(10, n - 1) for i in range(n)}
