"""From queries and judgments to ranked documents and metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.functions.embedding import Embedder
from sparkrank.operators import cleaning, entities, evaluate, knn, rerank
from sparkrank.sources.collection import checkpointed

Scorer = Callable[[DataFrame, DataFrame], DataFrame]


def overlap_scorer(weights: DataFrame) -> Scorer:
    """The built-in scorer: weight of the query words found in the text."""
    return lambda pairs, queries: rerank.overlap_scores(pairs, queries, weights)


def pair_scorer(load: Callable) -> Scorer:
    """A scorer from a user-supplied function of query texts and texts."""
    return lambda pairs, queries: rerank.pair_scores(pairs.join(queries, "query_id"), load)


def route(
    queries: DataFrame, dictionary: DataFrame, on_unresolved: str = "carry", substring: bool = False
) -> DataFrame:
    """Raw queries (``_id, text, pos``) cleaned and given their ticker."""
    cleaned = cleaning.clean_queries(queries).select(
        F.col("_id").alias("query_id"), F.col("text").alias("query_text"), "pos"
    )
    return entities.route_queries(cleaned, dictionary, on_unresolved=on_unresolved, substring=substring)


def retrieve(
    routed: DataFrame,
    collection: DataFrame,
    embedder: Embedder,
    *,
    k: int = 100,
    metric: str = "l2",
    **search,
) -> DataFrame:
    """Candidates of routed queries with their texts."""
    vectors = routed.select("query_id", "ticker", embedder.vector("embed_text").alias("embedding"))
    found = knn.nearest(vectors, collection, k, metric=metric, **search)
    return rerank.with_texts(found, collection)


def retrieve_and_rerank(
    queries: DataFrame,
    judgments: DataFrame | None,
    dictionary: DataFrame,
    collection: DataFrame,
    embedder: Embedder,
    *,
    k: int = 100,
    top: int = 10,
    on_unresolved: str = "carry",
    substring: bool = False,
    group: str = "query_id",
    scorer: Scorer | None = None,
    **search,
) -> DataFrame:
    """Best parent documents of each judged query.

    Routing sees all queries, because an unresolved one may take the ticker of a
    query nobody judged; only judged queries are searched. ``scorer`` defaults
    to the built-in one with weights computed from the collection here.
    """
    routed = route(queries, dictionary, on_unresolved, substring)
    if judgments is not None:
        routed = evaluate.judged_only(routed, judgments)
    # read by the search, the pairing and the scoring
    routed = checkpointed(routed)
    scorer = scorer or overlap_scorer(rerank.word_weights(collection))
    candidates = retrieve(routed, collection, embedder, k=k, **search)
    texts = routed.select("query_id", "query_text")
    scored = scorer(candidates, texts)
    if group not in scored.columns:
        scored = scored.join(texts, "query_id")
    return rerank.best_parents(scored, top, group)


def retrieve_and_evaluate(
    queries: DataFrame,
    judgments: DataFrame,
    dictionary: DataFrame,
    collection: DataFrame,
    embedder: Embedder,
    *,
    top: int = 10,
    unretrieved: str = "drop",
    **options,
) -> DataFrame:
    """Precision, recall and average precision per judged query."""
    judged = cleaning.clean_judgments(judgments)
    ranked = retrieve_and_rerank(
        queries, judged, dictionary, collection, embedder, top=top, **options
    )
    return evaluate.evaluate_retrieval(ranked, judged, unretrieved=unretrieved, max_list=top)
