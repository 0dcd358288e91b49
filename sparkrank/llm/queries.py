"""Registered queries of this subpackage: one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrank.llm import chat, collocations, decontamination, jaccard, multi_index, packing, periodic, pii, quality, simhash, substrings, toxicity, warc
from sparkrank.llm.common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).selectExpr("-1", "id", "if(id = 0, 'user', 'assistant')", "'</s>[INST] ok [/INST]'")
    return chat.digests(chat.format_conversations(turns.union(added)))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents")).drop("key")


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, table(spark, sf_dir, "pages")).drop("url", "payload")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """One document in ten with its words from a place on repeated from a shorter stretch of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[ \\x09-\\x0D]+"), lambda w: w != "")
    chosen = F.when(h % 10 == 0, words)
    n, g = F.size("words").cast("long"), F.floor(h / 10)
    start = F.when(n > 0, g % n)
    period = 1 + F.floor((n - F.col("start")) / (3 + g % 8))
    cut = docs.select("doc_id", "text", chosen.alias("words")).withColumn("start", start).withColumn("period", period)
    place = lambda i: F.when(i < F.col("start"), i).otherwise(F.col("start") + (i - F.col("start")) % F.col("period"))
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("words", place(i).cast("int")))
    return cut.select("doc_id", F.when(F.col("start").isNotNull(), F.concat_ws(" ", repeated)).otherwise(F.col("text")).alias("text"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    # runs are ordered by start and period, so of equal ones the first stays
    higher = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", none, lambda best, r: F.when(higher(best, r), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_simhash": op2_simhash,
    "op3_chat": op3_chat,
    "op4_pii": op4_pii,
    "op5_multi_index": op5_multi_index,
    "op6_warc": op6_warc,
    "op7_substrings": op7_substrings,
    "op8_toxicity": op8_toxicity,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_jaccard": op12_jaccard,
    "op13_periodic": op13_periodic,
}
