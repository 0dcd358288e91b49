import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrank.operators import knn


def data(spark, n=300, q=25, dim=8, seed=0):
    rng = np.random.default_rng(seed)
    vecs = rng.normal(size=(n, dim)).astype(np.float32)
    vecs[: n // 3] = vecs[0]  # a third are copies of one vector
    tags = ["hot" if i < n // 2 else f"t{i % 4}" for i in range(n)]
    rows = [(f"v{i:03}", tags[i], vecs[i].tolist()) for i in range(n)]
    wanted = [tags[int(i)] for i in rng.integers(0, n, q)]
    wanted[0], wanted[1] = None, "absent"
    asks = rng.normal(size=(q, dim)).astype(np.float32)
    asks[2], wanted[2] = vecs[0], "hot"
    queries = [(f"q{i}", wanted[i], asks[i].tolist()) for i in range(q)]
    schema = "ticker string, embedding array<float>"
    return (
        spark.createDataFrame(queries, "query_id string, " + schema).repartition(2),
        spark.createDataFrame(rows, "_id string, " + schema).repartition(4),
        queries,
        rows,
    )


def brute(queries, rows, k, metric):
    out = {}
    for qid, tag, q in queries:
        q = np.array(q, dtype=np.float32).astype(float)
        hits = []
        for vid, vtag, v in rows:
            if tag is None or tag == vtag:
                v = np.array(v, dtype=np.float32).astype(float)
                if metric == "l2":
                    d = ((q - v) ** 2).sum()
                else:
                    d = 1 - q @ v / np.linalg.norm(q) / np.linalg.norm(v)
                hits.append((round(float(d), 9), vid))
        for rank, (d, vid) in enumerate(sorted(hits)[:k], start=1):
            out[(qid, rank)] = (vid, d)
    return out


def found(df):
    return {(r.query_id, r["rank"]): (r.corpus_id, r.distance) for r in df.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for key in a:
        assert a[key][0] == b[key][0]
        assert a[key][1] == pytest.approx(b[key][1], abs=2e-9)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_both_forms_match_brute_force(spark, metric, monkeypatch):
    monkeypatch.setattr(knn, "QUERY_BLOCK", 7)
    monkeypatch.setattr(knn, "VECTOR_BLOCK", 13)
    queries, vectors, q, v = data(spark)
    expected = brute(q, v, 20, metric)
    same(found(knn.nearest(queries, vectors, 20, metric=metric)), expected)
    cells = knn.nearest(
        queries, vectors, 20, metric=metric, strategy="blocks", cell_vectors=30, cell_queries=4
    )
    same(found(cells), expected)


def test_large_query_side_takes_blocks(spark):
    queries, vectors, q, v = data(spark, n=60, q=12)
    same(found(knn.nearest(queries, vectors, 5, max_queries=3)), brute(q, v, 5, "l2"))
    with pytest.raises(ValueError):
        knn.nearest(queries, vectors, 5, strategy="broadcast", max_queries=3)


def test_smaller_k_is_a_prefix(spark):
    queries, vectors, *_ = data(spark, n=80, q=6)
    five, ten = (found(knn.nearest(queries, vectors, k)) for k in (5, 10))
    assert five == {key: hit for key, hit in ten.items() if key[1] <= 5}


def test_null_vectors_and_no_queries(spark):
    queries, vectors, *_ = data(spark, n=20, q=3)
    holes = vectors.withColumn("embedding", F.when(F.col("_id") != "v000", F.col("embedding")))
    assert "v000" not in {hit[0] for hit in found(knn.nearest(queries, holes, 30)).values()}
    assert knn.nearest(queries.limit(0), vectors, 5).count() == 0


def test_vectors_are_not_shuffled_when_queries_are_few(spark):
    queries, vectors, *_ = data(spark, n=20, q=3)
    stored = vectors.coalesce(1)
    plan = knn.nearest(queries, stored, 5)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow") :]
    assert "hashpartitioning" not in below and "Cartesian" not in plan


def test_broken_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(f"v{i:03}", "a", [float(i), 1.0]) for i in range(100)]
    bad = [("n1", "a", [nan, 1.0]), ("n2", "a", [1.0, inf]), ("n3", "a", None), ("n4", "a", [None, 1.0])]
    schema = "_id string, ticker string, embedding array<float>"
    vectors = spark.createDataFrame(good + bad, schema)
    asked = [("q1", "a", [3.2, 1.0]), ("q2", "a", None), ("q3", "a", [nan, 0.0]), ("q4", None, [96.9, 1.0])]
    queries = spark.createDataFrame(asked, schema.replace("_id", "query_id"))
    for metric in ("l2", "cosine"):
        for options in ({"strategy": "broadcast"}, {"strategy": "blocks", "cell_vectors": 9, "cell_queries": 2}):
            rows = knn.nearest(queries, vectors, 5, metric=metric, **options).collect()
            assert sorted((r.query_id, r["rank"]) for r in rows) == [(q, i) for q in ("q1", "q4") for i in range(1, 6)]
            if metric == "l2":
                assert {r.corpus_id for r in rows if r.query_id == "q1"} == {"v001", "v002", "v003", "v004", "v005"}


def test_hits_of_many_tasks_are_merged(spark):
    rows = [(f"v{i:04}", "a", [float(i % 97), float(i % 89)]) for i in range(2_000)]
    schema = "_id string, ticker string, embedding array<float>"
    vectors = spark.createDataFrame(rows, schema).repartition(40)
    queries = spark.createDataFrame([("q", "a", [0.0, 0.0])], schema.replace("_id", "query_id"))
    found = knn.nearest(queries, vectors, 7).orderBy("rank").collect()
    want = sorted((x * x + y * y, name) for name, _, (x, y) in rows)[:7]
    assert [(r.distance, r.corpus_id) for r in found] == want


def test_small_cells_do_not_copy_rows_for_each_other(spark, monkeypatch):
    queries, vectors, *_ = data(spark, n=200, q=100)
    seen, ranked = [], knn._ranked
    monkeypatch.setattr(knn, "_ranked", lambda hits, k, *keys: seen.append(hits.count()) or ranked(hits, k, *keys))
    got = found(knn.nearest(queries, vectors, 3, strategy="blocks", cell_vectors=2, cell_queries=2))
    assert 0 < seen[0] <= 100 * 3 * knn.CUTS * 4  # four tags for a query without one
    same(got, found(knn.nearest(queries, vectors, 3, strategy="broadcast")))
