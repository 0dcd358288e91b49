"""Corpus, query and judgment cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.functions import text as T
from sparkrank.operators.entities import Dictionary, invert
from sparkrank.operators.skew import broadcast_if_small, join_spread


# Titles that name a ticker are broadcast up to this many (some 100 bytes each).
BROADCAST_TITLES = 500_000


def clean_titles(docs: DataFrame, dictionary: Dictionary | DataFrame, substring: bool = False) -> DataFrame:
    """Titles with their first known ticker replaced by the company name.

    Only a title that names a ticker also has its repeated words removed. A
    :class:`Dictionary` is looked up inside the row. A dictionary table may have
    any size: the words of the distinct titles are joined with it, and the titles that name a ticker
    back to the documents, so every row gets what its own title says. When such titles are few, which is counted,
    they are broadcast and no text is shuffled.
    """
    lowered = docs.withColumn("title", F.lower(F.coalesce("title", F.lit(""))))
    if isinstance(dictionary, Dictionary):
        known = F.filter(F.split("title", " "), dictionary.is_ticker)
        found = lowered.withColumn("__ticker", F.try_element_at(known, F.lit(1)))
        company = dictionary.company_of(F.col("__ticker"))
    else:
        words = lowered.select("title").distinct().select("title", F.posexplode(F.split("title", " ")).alias("at", "ticker"))
        hits = (
            join_spread(words, invert(dictionary), "ticker", by="title")
            .groupBy("title")
            .agg(F.min(F.struct("at", "ticker", "company")).alias("hit"))
        )
        named = hits.select("title", F.col("hit.ticker").alias("__ticker"), F.col("hit.company").alias("__company"))
        found = lowered.join(broadcast_if_small(named, BROADCAST_TITLES), "title", "left")
        company = F.col("__company")
    ticker = F.col("__ticker")
    replaced = T.distinct_words(T.replace_word(F.col("title"), ticker, company, substring))
    title = F.when(ticker.isNull(), F.col("title")).otherwise(replaced)
    return found.withColumn("title", title).drop("__ticker", "__company")


def clean_corpus(
    docs: DataFrame,
    dictionary: Dictionary | DataFrame,
    *,
    as_coded_ids: bool = False,
    substring: bool = False,
    newline_as_space: bool = False,
) -> DataFrame:
    """``_id, title, text`` normalised; other columns pass through.

    Ids lose punctuation so that they meet the judgments; ``as_coded_ids`` only
    lower-cases them. ``substring`` replaces tickers inside words as well.
    """
    doc_id = F.lower("_id") if as_coded_ids else T.normal_id("_id")
    titled = clean_titles(docs.withColumn("_id", doc_id), dictionary, substring)
    return titled.withColumn(
        "text", T.clean_corpus_text(F.col("title"), F.col("text"), newline_as_space)
    )


def clean_queries(queries: DataFrame) -> DataFrame:
    return queries.withColumn("text", T.clean_query_text("text"))


def clean_judgments(judgments: DataFrame) -> DataFrame:
    return judgments.withColumn("corpus_id", T.normal_id("corpus_id"))
