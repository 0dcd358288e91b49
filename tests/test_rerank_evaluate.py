import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrank.operators import evaluate, rerank


def test_best_chunk_per_parent(spark):
    rows = [("q", "p", 0.2), ("q", "p", 0.9), ("q", "q", 0.5), ("q", "n", float("nan")), ("q", "z", None)]
    scored = spark.createDataFrame(rows, "query_id string, parent_id string, rerank_score double")
    out = rerank.best_parents(scored, 10).orderBy("rank").collect()
    assert [(r.corpus_id, r["rank"]) for r in out] == [("p", 1), ("q", 2), ("n", 3), ("z", 4)]
    assert [r.corpus_id for r in rerank.best_parents(scored, 2).orderBy("rank").collect()] == ["p", "q"]


def test_groups_by_text(spark):
    rows = [("q1", "same", "a", 0.5), ("q2", "same", "a", 0.5), ("q2", "same", "b", 0.7)]
    scored = spark.createDataFrame(rows, "query_id string, query_text string, parent_id string, rerank_score double")
    out = rerank.best_parents(scored, 10, group="query_text").orderBy("rank").collect()
    assert [(r.query_id, r.corpus_id) for r in out] == [("q2", "b"), ("q1", "a")]


def test_overlap_scores(spark):
    texts = ["apple revenue grew", "apple apple cost", "cost of goods", "other words"]
    coll = spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(texts)], "_id string, text string")
    queries = spark.createDataFrame(
        [("q1", "apple apple cost"), ("q2", "unknown"), ("q3", "of")], "query_id string, query_text string"
    )
    pairs = queries.crossJoin(coll.withColumnRenamed("_id", "corpus_id"))
    scored = rerank.overlap_scores(pairs.drop("query_text"), queries, rerank.word_weights(coll))
    out = {(r.query_id, r.corpus_id): r.rerank_score for r in scored.collect()}
    df = {w: sum(w in t.split() for t in texts) for w in ("apple", "cost", "of")}
    for query_id, text in (("q1", "apple cost"), ("q2", "unknown"), ("q3", "of")):
        for i, t in enumerate(texts):
            shared = set(text.split()) & set(t.split())
            expected = sum(np.log1p(len(texts) / df[w]) for w in shared)
            assert out[(query_id, f"c{i}")] == pytest.approx(expected, abs=1e-6)


def test_user_scorer(spark):
    pairs = spark.createDataFrame([("ab", "abc"), (None, "x")], "query_text string, text string")

    def load():
        return lambda queries, texts: [len(q) + len(t) for q, t in zip(queries, texts)]

    assert sorted(r.rerank_score for r in rerank.pair_scores(pairs, load).collect()) == [1.0, 5.0]


def metrics(spark, retrieved, judged, **options):
    r = spark.createDataFrame(retrieved, "query_id string, corpus_id string, rank long").repartition(3)
    j = spark.createDataFrame(judged, "query_id string, corpus_id string")
    out = evaluate.evaluate_retrieval(r, j, **options).collect()
    return {m.query_id: (m.precision, m.recall, m.map) for m in out}


GOLDEN = [("q", c, i) for i, c in enumerate("abcde", start=1)]
RELEVANT = [("q", c) for c in "adz"]


@pytest.mark.parametrize("options", [{"max_list": 10}, {"width": 2}, {}])
def test_golden_case(spark, options):
    out = metrics(spark, GOLDEN, RELEVANT + [("q", "a"), (None, "a")], **options)
    assert out == {"q": pytest.approx((2 / 5, 2 / 3, 0.5))}


def test_repeats_count_once_at_their_first_rank(spark):
    rows = [("q", "x", 1), ("q", "a", 2), ("q", "a", 3), ("q", "x", 4), ("q", "d", 5)]
    out = metrics(spark, rows, RELEVANT, width=2)
    assert out["q"] == pytest.approx((2 / 3, 2 / 3, (1 / 2 + 2 / 3) / 3))


def test_unretrieved_queries(spark):
    judged = RELEVANT + [("missing", "a")]
    assert set(metrics(spark, GOLDEN, judged)) == {"q"}
    assert metrics(spark, GOLDEN, judged, unretrieved="zero")["missing"] == (0.0, 0.0, 0.0)


def test_ranges(spark):
    rng = random.Random(4)
    retrieved = [(f"q{q}", f"d{d}", i) for q in range(8) for i, d in enumerate(rng.sample(range(30), 12), 1)]
    judged = list({(f"q{rng.randrange(8)}", f"d{rng.randrange(30)}") for _ in range(60)})
    bounded, ranged = (metrics(spark, retrieved, judged, **o) for o in ({"max_list": 12}, {"width": 5}))
    assert bounded.keys() == ranged.keys()
    for q in bounded:
        assert bounded[q] == pytest.approx(ranged[q])
        assert all(0 <= m <= 1 for m in bounded[q])


def test_perfect_ranking(spark):
    assert metrics(spark, GOLDEN, [("q", "a"), ("q", "b")])["q"][2] == pytest.approx(1.0)


def test_judged_only_and_means(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "query_id string")
    judged = spark.createDataFrame([("a", "x"), ("a", "y")], "query_id string, corpus_id string")
    assert [r.query_id for r in evaluate.judged_only(rows, judged).collect()] == ["a"]
    table = spark.createDataFrame([("a", 0.5, 1.0, 0.5), ("b", 0.0, 0.0, 0.0)], "query_id string, precision double, recall double, map double")
    assert tuple(evaluate.mean_metrics(table).first()) == (2, 0.25, 0.5, 0.25)


def test_candidates_with_an_empty_tag_find_their_text(spark, tmp_path):
    from sparkrank.sources import collection as store

    rows = [("1a", "p1", "t", "one", [1.0], ""), ("b1", "p2", "t", "two", [2.0], "b")]
    schema = "_id string, parent_id string, title string, text string, embedding array<float>, ticker string"
    store.write_collection(spark.createDataFrame(rows, schema), str(tmp_path / "c"))
    kept = store.read_collection(spark, str(tmp_path / "c"))
    hits = spark.createDataFrame(
        [("q", "1a", None), ("q", "b1", "b"), ("r", "1a", "")], "query_id string, corpus_id string, ticker string"
    )
    for limit in (10, 0):
        out = rerank.with_texts(hits, kept, limit).collect()
        assert sorted((r.query_id, r.corpus_id, r.text) for r in out) == [
            ("q", "1a", "one"), ("q", "b1", "two"), ("r", "1a", "one")
        ]


def test_text_groups_name_the_query_of_the_best_chunk(spark):
    rows = [("q1", "same", "p", 0.2), ("q2", "same", "p", 0.9), ("q0", "same", "p", float("nan")), ("q3", "same", "o", None)]
    scored = spark.createDataFrame(rows, "query_id string, query_text string, parent_id string, rerank_score double")
    out = rerank.best_parents(scored, 5, "query_text").orderBy("rank").collect()
    assert [(r.query_id, r.corpus_id, r.rerank_score) for r in out] == [("q2", "p", 0.9), ("q3", "o", None)]
