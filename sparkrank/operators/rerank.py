"""Scoring of (query, text) pairs and the best parent documents per query."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkrank.functions import text as T
from sparkrank.functions.columns import let
from sparkrank.operators.skew import broadcast_if_small, join_spread

SCORE_DIGITS = 6
# Candidates are broadcast up to this many rows (about 100 bytes each).
BROADCAST_CANDIDATES = 1_000_000


def with_texts(
    candidates: DataFrame, collection: DataFrame, broadcast_rows: int = BROADCAST_CANDIDATES
) -> DataFrame:
    """Candidates with the text and parent of their chunk.

    The candidates are written once and counted. When they are few the texts
    are scanned where they lie, and only those of the tags that occur; more
    candidates meet the texts in a shuffle. The tag is part of the key; an empty
    tag comes back from a partitioned table as null, and the two are one tag.
    """
    texts = collection.select(
        F.col("_id").alias("__id"), F.col("ticker").alias("__tag"), "parent_id", "text"
    )
    same_tag = F.coalesce("__tag", F.lit("")) == F.coalesce("ticker", F.lit(""))
    found = texts.join(
        broadcast_if_small(candidates, broadcast_rows), same_tag & (F.col("__id") == F.col("corpus_id"))
    )
    return found.drop("__id", "__tag")


def word_weights(collection: DataFrame) -> DataFrame:
    """Inverse document frequency of every word of the collection.

    ``ln(1 + n / df)``; counts are combined before the shuffle, so a word that
    stands in every text is one row per task.
    """
    found = collection.select(F.explode(F.array_distinct(T.words("text"))).alias("word"))
    df = found.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    total = collection.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.select("word", F.log1p(total / F.col("df")).alias("weight"))


def weighted_queries(queries: DataFrame, weights: DataFrame) -> DataFrame:
    """Each query with its distinct known words and their weights.

    Only weights of words that queries use take part in the join, and a word
    that stands in most queries is spread over several tasks.
    """
    named = queries.select(
        "query_id", F.explode(F.array_distinct(T.words("query_text"))).alias("word")
    )
    used = weights.join(named.select("word").distinct(), "word", "left_semi")
    return (
        join_spread(named, used, "word", by="query_id")
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(F.struct("word", "weight"))).alias("query_words"))
    )


def overlap_scores(pairs: DataFrame, queries: DataFrame, weights: DataFrame) -> DataFrame:
    """Score pairs by the weight of the query words their text contains.

    A query meets its own candidates only; the comparison is inside the row.
    """
    worded = weighted_queries(queries, weights)
    joined = pairs.join(worded, "query_id", "left")

    def score(found: Column) -> Column:
        shared = F.filter("query_words", lambda q: F.array_contains(found, q["word"]))
        return F.aggregate(shared, F.lit(0.0), lambda acc, q: acc + q["weight"])

    # the words of a text are bound once, not split again for every query word
    total = F.coalesce(let(T.words("text"), score), F.lit(0.0))
    return joined.withColumn("rerank_score", F.round(total, SCORE_DIGITS)).drop("query_words")


def pair_scores(
    pairs: DataFrame, load: Callable[[], Callable[[list[str], list[str]], np.ndarray]]
) -> DataFrame:
    """Score pairs with a user-supplied function of query texts and texts.

    ``load`` runs once per task. ``pairs`` needs ``query_text`` and ``text``.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = load()
        for query, text in batches:
            values = model(query.fillna("").tolist(), text.fillna("").tolist())
            yield pd.Series(np.asarray(values, dtype=np.float64), index=query.index)

    return pairs.withColumn("rerank_score", score("query_text", "text"))


def best_parents(scored: DataFrame, k: int = 10, group: str = "query_id") -> DataFrame:
    """Top ``k`` parent documents per query by the best score of their chunks.

    Scores that are not numbers come last; ties go to the smaller id. ``group``
    may be ``query_text`` to let queries with equal text share one list, whose
    rows name the query that gave the best chunk (the smaller id on ties).
    """
    score = F.nullif(F.col("rerank_score"), F.lit(float("nan")))
    parent = F.col("parent_id").alias("corpus_id")
    if group == "query_id":
        best = scored.groupBy("query_id", parent).agg(F.max(score).alias("rerank_score"))
    else:
        first = F.min(F.struct(score.isNull().alias("none"), (-score).alias("down"), "query_id"))
        best = scored.groupBy(group, parent).agg(
            F.max(score).alias("rerank_score"), first["query_id"].alias("query_id")
        )
    order = W.partitionBy(group).orderBy(F.col("rerank_score").desc_nulls_last(), "corpus_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "corpus_id", "rerank_score", "rank")
