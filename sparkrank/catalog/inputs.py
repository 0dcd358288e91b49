"""The given tables in the shapes the engine works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrank.functions import text as T
from sparkrank.operators.tracking import run_name
from sparkrank.sources.collection import checkpointed
from sparkrank.sources.readers import read_parquet, spread

SHARED_SENTENCE_WORDS = 5  # a shared sentence this long makes a document relevant
NEIGHBOUR_REACH = 20  # vectors of one label this close in id are relevant
RUN_TS = "2025-01-02 03:04:05"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def letters(source: Column) -> Column:
    return F.translate(F.substring(source, 4, 2**31 - 1), "0123456789", "abcdefghij")


def ticker(source: Column) -> Column:
    return F.concat(F.lit("src"), letters(source))


def raw_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_id, title, text, pos``: the title is the ticker and the first line."""
    source = F.col("source")
    return spread(table(spark, sf_dir, "documents")).select(
        F.concat(F.lit("SRC."), F.upper(letters(source)), F.lit("2023"), "doc_id").alias("_id"),
        F.concat_ws(" ", ticker(source), F.substring_index("text", "\n", 1)).alias("title"),
        "text",
        F.col("doc_id").alias("pos"),
    )


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two company names per ticker, so that inversion has to choose."""
    sources = table(spark, sf_dir, "documents").select("source").distinct()
    names = F.explode(
        F.array(
            F.struct(F.lit(0).alias("n"), F.lit("corp").alias("stem")),
            F.struct(F.lit(1).alias("n"), F.lit("firm").alias("stem")),
        )
    ).alias("name")
    number = F.substring("source", 4, 2**31 - 1).cast("long")
    return sources.select("source", names).select(
        F.concat("name.stem", letters(F.col("source"))).alias("company"),
        ticker(F.col("source")).alias("ticker"),
        (number * 2 + F.col("name.n")).alias("pos"),
    )


def _sentences(df: DataFrame, *keys: str) -> DataFrame:
    cut = df.select(*keys, F.explode_outer(T.sentences("text")).alias("sentence"))
    return cut.filter(T.word_count("sentence") >= SHARED_SENTENCE_WORDS)


def item_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share a whole sentence with a benchmark item."""
    items = _sentences(table(spark, sf_dir, "benchmark"), "item_id").distinct()
    docs = _sentences(spread(table(spark, sf_dir, "documents")), "doc_id", "source")
    # queries and judgments are both made from these few rows: callers that need both hand them over
    return checkpointed(docs.join(items, "sentence").select("item_id", "doc_id", "source").distinct())


def judgments(spark: SparkSession, sf_dir: str, pairs: DataFrame | None = None) -> DataFrame:
    pairs = item_documents(spark, sf_dir) if pairs is None else pairs
    return pairs.select(
        F.concat(F.lit("q"), "item_id").alias("query_id"),
        F.concat(F.lit("SRC."), F.upper(letters(F.col("source"))), F.lit("2023"), "doc_id").alias("corpus_id"),
        F.lit(1).alias("score"),
    )


def raw_queries(spark: SparkSession, sf_dir: str, pairs: DataFrame | None = None) -> DataFrame:
    """``_id, title, text, pos``: the item, led by a name of its first document.

    Even items name the company, odd ones the ticker, items without a document
    name nothing, so all routes are taken.
    """
    pairs = item_documents(spark, sf_dir) if pairs is None else pairs
    first = pairs.groupBy("item_id").agg(
        F.min(F.struct("doc_id", "source")).alias("first")
    )
    source = F.col("first.source")
    name = F.when(F.col("item_id") % 2 == 0, F.concat(F.lit("corp"), letters(source))).otherwise(ticker(source))
    return (
        table(spark, sf_dir, "benchmark")
        .join(first, "item_id", "left")
        .select(
            F.concat(F.lit("q"), "item_id").alias("_id"),
            F.lit("").alias("title"),
            F.concat_ws(" ", name, "text").alias("text"),
            F.col("item_id").alias("pos"),
        )
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("v"), "vec_id").alias("_id"),
        F.concat(F.lit("label"), "label").alias("ticker"),
        "embedding",
        "vec_id",
    )


def vector_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of the same label whose ids are close; linear in the table."""
    own = vectors(spark, sf_dir).select("vec_id", "ticker")
    ahead = F.explode(F.sequence(F.lit(1), F.lit(NEIGHBOUR_REACH)))
    near = own.select(F.col("vec_id").alias("q"), "ticker", ahead.alias("step")).select(
        "q", "ticker", (F.col("q") + F.col("step")).alias("vec_id")
    )
    return near.join(own, ["vec_id", "ticker"]).select(
        F.concat(F.lit("v"), "q").alias("query_id"), F.concat(F.lit("v"), "vec_id").alias("corpus_id")
    )


def conversation_pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """User turns as queries, assistant turns as texts, and who answers whom."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", T.clean_corpus_text(F.lit(""), F.col("text")).alias("text")
    )
    name = F.concat_ws("x", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    asked = turns.filter("role = 'user'").select(
        F.concat(F.lit("u"), name).alias("query_id"), "conv_id", "turn", F.col("text").alias("query_text")
    )
    said = turns.filter("role = 'assistant'").select(
        F.concat(F.lit("a"), name).alias("_id"), "conv_id", "turn", "text"
    )
    answers = asked.select("query_id", "conv_id", (F.col("turn") + 1).alias("turn")).join(
        said.select(F.col("_id").alias("corpus_id"), "conv_id", "turn"), ["conv_id", "turn"]
    )
    return asked, said, answers.select("query_id", "corpus_id")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per source and language: ``en`` plays main, the metric is quality."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    marks = table(spark, sf_dir, "labels").select("doc_id", "quality")
    means = docs.join(marks, "doc_id").groupBy("source", "lang").agg(
        F.avg("quality").alias("value"), F.count(F.lit(1)).alias("n")
    )
    branch = F.when(F.col("lang") == "en", "main").otherwise(F.col("lang"))
    number = F.substring("source", 4, 2**31 - 1).cast("int")
    ts = F.lit(RUN_TS).cast("timestamp_ntz") + F.make_dt_interval(mins=number)
    return means.select("source", "value", "n", branch.alias("branch"), ts.alias("ts")).select(
        run_name(F.col("branch"), F.col("ts")).alias("run_name"),
        "branch",
        "ts",
        F.lit("recall").alias("metric"),
        "value",
        "n",
        "source",
    )


def settings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two-level settings per source: of all documents, and of labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    labelled = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")

    def nested(df: DataFrame) -> DataFrame:
        sums = df.groupBy(F.col("source").alias("run_name")).agg(
            F.count(F.lit(1)).alias("n"),
            F.max("n_chars").alias("longest"),
            F.min("n_chars").alias("shortest"),
            F.max("lang").alias("lang"),
        )

        def text(c: str) -> Column:
            return F.col(c).cast("string")

        corpus = F.create_map(F.lit("documents"), text("n"), F.lit("lang"), text("lang"))
        splitter = F.create_map(F.lit("max_chars"), text("longest"), F.lit("min_chars"), text("shortest"))
        return sums.select(
            "run_name",
            F.create_map(F.lit("corpus"), corpus, F.lit("splitter"), splitter).alias("settings"),
        )

    return nested(docs), nested(labelled)


def document_manifests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two manifests with one entry per document.

    The second lacks documents of low quality, has toxic ones redacted and the
    benchmark items added.
    """
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", "text")
    marks = table(spark, sf_dir, "labels")
    named = F.concat(F.lit("doc-"), "doc_id").alias("name")
    main = docs.select(named, F.md5("text").alias("md5"))
    kept = docs.join(marks, "doc_id", "left").filter(F.coalesce("quality", F.lit(1)) != 0)
    redacted = F.when(F.col("toxic") == 1, F.concat("text", F.lit(" [redacted]"))).otherwise(F.col("text"))
    added = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("item-"), "item_id").alias("name"), F.md5("text").alias("md5")
    )
    return main, kept.select(named, F.md5(redacted).alias("md5")).unionByName(added)


def shard_manifests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two manifests with one entry per source and language.

    The fingerprint of a shard adds up its rows, so no shard is read by one task.
    The second manifest is that of the labelled documents.
    """
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "text")
    labelled = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")

    def manifest(df: DataFrame) -> DataFrame:
        word = F.conv(F.substring(F.md5("text"), 1, 8), 16, 10).cast("long")
        sums = df.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.sum(word).alias("total"))
        return sums.select(
            F.concat_ws("/", "source", "lang").alias("name"),
            F.md5(F.concat_ws("/", F.col("n").cast("string"), F.col("total").cast("string"))).alias("md5"),
        )

    return manifest(docs), manifest(labelled)
