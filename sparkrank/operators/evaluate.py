"""Precision, recall and average precision against relevance judgments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkrank.operators.ordered import WIDTH, running_sums


def judged_only(rows: DataFrame, judgments: DataFrame) -> DataFrame:
    """Rows whose query has at least one judgment."""
    return rows.join(judgments.select("query_id").distinct(), "query_id", "left_semi")


def hits(retrieved: DataFrame, judgments: DataFrame, max_list: int | None, width: int) -> DataFrame:
    """Distinct retrieved documents with their place in the list and hit mark."""
    first = retrieved.groupBy("query_id", "corpus_id").agg(F.min("rank").alias("rank"))
    relevant = judgments.select("query_id", "corpus_id").distinct().withColumn("__relevant", F.lit(1))
    marked = first.join(relevant, ["query_id", "corpus_id"], "left").select(
        "query_id", "corpus_id", "rank", F.coalesce("__relevant", F.lit(0)).alias("hit")
    )
    if max_list is None:
        return running_sums(
            marked, {"place": F.lit(1), "hits": F.col("hit")}, "rank", ["query_id"], width, dense=True
        )
    upto = W.partitionBy("query_id").orderBy("rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    return marked.withColumns({"place": F.count(F.lit(1)).over(upto), "hits": F.sum("hit").over(upto)})


def evaluate_retrieval(
    retrieved: DataFrame,
    judgments: DataFrame,
    *,
    unretrieved: str = "drop",
    max_list: int | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """``query_id, precision, recall, map`` per judged query.

    ``retrieved`` has ``query_id, corpus_id, rank``, and a rank is used once per
    query. Judged queries without a retrieved document leave (``drop``) or count
    as zero (``zero``). ``max_list`` states that no list is longer than that, as
    after a top-k; without it, long lists are cut into ranges.
    """
    if unretrieved not in ("drop", "zero"):
        raise ValueError(f"unknown unretrieved: {unretrieved}")
    judged = judgments.filter(F.col("query_id").isNotNull())
    relevant = (
        judged.select("query_id", "corpus_id")
        .distinct()
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("n_relevant"))
    )
    found = hits(retrieved, judged, max_list, width)
    sums = found.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_retrieved"),
        F.sum("hit").alias("n_hits"),
        F.sum(F.col("hit") * F.col("hits") / F.col("place")).alias("gain"),
    )
    how = "left" if unretrieved == "zero" else "inner"
    joined = relevant.join(sums, "query_id", how)
    zero = F.lit(0.0)
    return joined.select(
        "query_id",
        F.coalesce(F.col("n_hits") / F.col("n_retrieved"), zero).alias("precision"),
        F.coalesce(F.col("n_hits") / F.col("n_relevant"), zero).alias("recall"),
        F.coalesce(F.col("gain") / F.col("n_relevant"), zero).alias("map"),
    )


def mean_metrics(metrics: DataFrame) -> DataFrame:
    """One row: the mean of each metric and the number of scored queries."""
    return metrics.agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("map").alias("map"),
    )


def both_means(metrics: DataFrame, judgments: DataFrame) -> DataFrame:
    """One row: means over the scored queries, and over all judged ones with zero for those without a score."""
    names = ("precision", "recall", "map")
    judged = judgments.filter(F.col("query_id").isNotNull()).select("query_id").distinct()
    filled = judged.join(metrics, "query_id", "left")
    scored = F.count(F.when(F.greatest(*names).isNotNull(), 1))
    return filled.agg(
        scored.alias("n_queries"),
        F.count(F.lit(1)).alias("n_judged"),
        *[F.avg(c).alias(c) for c in names],
        *[F.avg(F.coalesce(c, F.lit(0.0))).alias(f"{c}_zero_filled") for c in names],
    )
