"""One query per operator, each over its whole tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrank import schemas
from sparkrank.catalog import inputs
from sparkrank.functions import text as T
from sparkrank.functions.embedding import Embedder, HashedBow, LengthBatches
from sparkrank.operators import (
    chunking,
    cleaning,
    entities,
    evaluate,
    knn,
    rerank,
    tracking,
)
from sparkrank.plans import index, retrieve, track, upkeep
from sparkrank.sources import collection as store
from sparkrank.sources import readers, writers

DIM = 64
MAIN_VERSION = "v1.0"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def embedder() -> Embedder:
    return HashedBow(DIM)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = entities.Dictionary.fitting(inputs.dictionary(spark, sf_dir))
    return cleaning.clean_corpus(inputs.raw_corpus(spark, sf_dir), known)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = chunking.mark_long(corpus(spark, sf_dir))
    return chunking.semantic_segments(marked, embedder(), only="is_long")


def collection(spark: SparkSession, sf_dir: str) -> index.StoredCollection:
    """The collection as stored in the shared folder, written on first use."""
    known = entities.Dictionary.fitting(inputs.dictionary(spark, sf_dir))
    return index.StoredCollection(inputs.raw_corpus(spark, sf_dir), known, embedder())


def asked_and_judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw queries and judgments, from one join of documents and items."""
    pairs = inputs.item_documents(spark, sf_dir)
    return inputs.raw_queries(spark, sf_dir, pairs), inputs.judgments(spark, sf_dir, pairs)


# cleaning and identifiers


@query
def clean_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("_id", "title", "text")


@query
def clean_corpus_as_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The literal forms: ids only in lower case, tickers also inside words, line breaks as spaces."""
    known = entities.Dictionary.fitting(inputs.dictionary(spark, sf_dir))
    docs = inputs.raw_corpus(spark, sf_dir)
    cleaned = cleaning.clean_corpus(docs, known, as_coded_ids=True, substring=True, newline_as_space=True)
    return cleaned.select("_id", "title", "text")


@query
def clean_corpus_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cleaning with the dictionary as a table, as for many entries."""
    return cleaning.clean_corpus(inputs.raw_corpus(spark, sf_dir), inputs.dictionary(spark, sf_dir)).select("_id", "title", "text")


@query
def clean_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_queries(inputs.raw_queries(spark, sf_dir)).select("_id", "text")


@query
def normalize_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_judgments(inputs.judgments(spark, sf_dir))


@query
def derive_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.raw_corpus(spark, sf_dir).select(T.normal_id("_id").alias("doc"), "pos")
    named = docs.select(F.concat_ws("_", "doc", F.col("pos").cast("string")).alias("_id"))
    return named.select("_id", T.tag_of("_id").alias("ticker"), T.parent_of("_id").alias("parent_id"))


# files: rows written in the formats the engine reads and logs, and read back


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{store.shared_folder(spark)}/sparkrank-files/{name}-{uuid.uuid4()}"


@query
def scan_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "corpus")
    inputs.raw_corpus(spark, sf_dir).select("_id", "title", "text").write.json(path)
    docs = readers.read_documents(spark, path)
    return docs.select("_id", "title", F.md5("text").alias("md5"), F.length("text").alias("n_chars"))


@query
def scan_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "judgments")
    inputs.judgments(spark, sf_dir).write.csv(path, sep="\t", header=True)
    return readers.read_judgments(spark, path)


@query
def scan_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which those of Spanish documents are cut off: what is read, and what is put aside."""
    path, aside = _fresh(spark, "broken"), _fresh(spark, "quarantine")
    docs = inputs.raw_corpus(spark, sf_dir).join(inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), "lang"), "pos")
    line = F.to_json(F.struct("_id", "title", "text"))
    docs.select(_cut_off(line, F.col("lang") == "es")).write.text(path)
    kept = readers.read_with_quarantine(spark, path, "documents", aside, tolerated=0.5).select("_id", F.lit("kept").alias("status"), F.md5("text").alias("md5"))
    bad = spark.read.parquet(aside).select(F.regexp_extract("line", '"_id":"([^"]*)"', 1).alias("_id"), F.lit("aside").alias("status"))
    return kept.unionByName(bad.withColumn("md5", F.lit(None).cast("string")))


def _cut_off(line: Column, broken: Column) -> Column:
    """Lines without their last character where they are to be broken."""
    return F.when(broken, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line).alias("value")


@query
def metrics_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "metrics")
    writers.write_metrics(knn_eval_metrics(spark, sf_dir), path)
    return readers.read_metrics(spark, path)


@query
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs appended to a log in two goes, main runs first."""
    path = _fresh(spark, "runs")
    rows = inputs.runs(spark, sf_dir).select("run_name", "branch", "metric", F.round("value", 6).alias("value"))
    compared = tracking.is_compared(F.col("branch"))
    writers.append_log(rows.filter(~compared), path)
    writers.append_log(rows.filter(compared), path)
    return spark.read.json(path, schema=rows.schema)


# entities


@query
def invert_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.invert(inputs.dictionary(spark, sf_dir))


@query
def route_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = inputs.dictionary(spark, sf_dir)
    found = retrieve.route(inputs.raw_queries(spark, sf_dir), known)
    return found.select("query_id", "query_text", "embed_text", "ticker", "route")


def _routed(spark: SparkSession, sf_dir: str, on_unresolved: str) -> DataFrame:
    asked, names = inputs.raw_queries(spark, sf_dir), inputs.dictionary(spark, sf_dir)
    found = retrieve.route(asked, names, on_unresolved)
    return found.select("query_id", "query_text", "embed_text", "ticker", "route")


@query
def route_entities_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir, "all")


@query
def route_entities_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir, "drop")


# long documents and chunks


@query
def route_long_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.mark_long(corpus(spark, sf_dir)).select("_id", "n_tokens", "is_long")


@query
def route_long_docs_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = chunking.mark_long(corpus(spark, sf_dir)).select("_id", "pos", "n_tokens", "is_long")
    return chunking.skip_after_removal(marked).select("_id", "n_tokens", "is_long")


@query
def split_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.split_sentences(corpus(spark, sf_dir))


@query
def semantic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).select("_id", "segment_no", "segment")


@query
def pack_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = chunking.size_pieces(segments(spark, sf_dir))
    piece_no = F.coalesce("piece_no", F.lit(-1)).alias("piece_no")
    return pieces.select("_id", "segment_no", piece_no, "text")


@query
def assign_chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = chunking.chunk_ids(chunking.size_pieces(segments(spark, sf_dir)))
    return pieces.select("_id", "parent_id", F.length("text").alias("n_chars"))


@query
def assign_chunk_ids_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written once, as cutting costs more than reading; counted, numbered and cut further where they lie
    cut = store.checkpointed(segments(spark, sf_dir))
    numbered = chunking.with_counters(cut, chunking.segment_counters(cut))
    named = chunking.counter_chunk_ids(chunking.size_pieces(numbered))
    return named.select("_id", "parent_id", F.length("text").alias("n_chars"))


@query
def dedupe_ids_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of a source carries the same id here."""
    docs = inputs.raw_corpus(spark, sf_dir).select(
        F.concat(T.tag_of(T.normal_id("_id")), F.lit("2023")).alias("_id"), "title", "text", "pos"
    )
    marked = chunking.mark_long(docs)
    short = chunking.number_repeats(marked.filter(~F.col("is_long")))
    long = marked.filter("is_long").withColumn("parent_id", F.col("_id"))
    named = long.withColumn("_id", F.concat_ws("_", "_id", F.lit("long"), F.col("pos").cast("string")))
    both = chunking.combine(short, named)
    return both.select("_id", "parent_id", "ticker", F.length("text").alias("n_chars"))


# embedding and the stored collection


@query
def embed_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = corpus(spark, sf_dir).select("_id", embedder().vector("text").alias("embedding"))
    cells = vectors.select("_id", F.posexplode_outer("embedding").alias("bucket", "weight"))
    return cells.filter("weight > 0").select(
        "_id", "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight")
    )


@query
def build_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the collection, or find it written, and count it by tag."""
    return collection(spark, sf_dir).table.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.countDistinct("parent_id").alias("n_documents"),
        F.sum(F.length("text")).alias("n_chars"),
    )


@query
def collection_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = collection(spark, sf_dir).table
    return stored.select("_id", "parent_id", "ticker", F.md5("text").alias("md5"))


@query
def collection_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = collection(spark, sf_dir).table
    cells = stored.select("_id", F.posexplode("embedding").alias("bucket", "weight"))
    return cells.filter("weight > 0").select(
        "_id", "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight")
    )


@query
def collection_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of the stored collection, counted."""
    return upkeep.audit_collection(collection(spark, sf_dir).table)


def edited_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus without documents of low quality, toxic ones redacted."""
    marks = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("pos"), "quality", "toxic")
    docs = inputs.raw_corpus(spark, sf_dir).join(marks, "pos", "left").filter(F.coalesce("quality", F.lit(1)) != 0)
    note = F.when(F.col("toxic") == 1, " [redacted]").otherwise("")
    one_line = ~F.contains("text", F.lit("\n"))  # its title is the whole text
    title = F.when(one_line, F.concat("title", note)).otherwise(F.col("title"))
    return docs.select("_id", title.alias("title"), F.concat("text", note).alias("text"), "pos")


@query
def collection_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of a collection that was built on the corpus and brought to the edited one."""
    known = entities.Dictionary.fitting(inputs.dictionary(spark, sf_dir))
    kept = upkeep.MaintainedCollection(spark, _fresh(spark, "maintained"), known, embedder())
    kept.update(inputs.raw_corpus(spark, sf_dir))
    kept.update(edited_corpus(spark, sf_dir))
    return kept.table().select("_id", "parent_id", "ticker", F.md5("text").alias("md5"))


@query
def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by source and language: how often each one repeats."""
    docs = inputs.table(spark, sf_dir, "documents")
    named = docs.select(F.concat_ws("-", "source", "lang").alias("_id"))
    return chunking.repeated_ids(named)


# search and evaluation on the given vectors


def _vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.vectors(spark, sf_dir).withColumnRenamed("_id", "query_id")


def _hits(df: DataFrame) -> DataFrame:
    return df.select("query_id", "corpus_id", "distance", "rank")


@query
def knn_filtered_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(knn.nearest(_vector_queries(spark, sf_dir), inputs.vectors(spark, sf_dir), 10))


@query
def knn_unfiltered_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    everywhere = _vector_queries(spark, sf_dir).withColumn("ticker", F.lit(None).cast("string"))
    return _hits(knn.nearest(everywhere, inputs.vectors(spark, sf_dir), 10))


@query
def knn_cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = knn.nearest(
        _vector_queries(spark, sf_dir), inputs.vectors(spark, sf_dir), 10, metric="cosine"
    )
    return _hits(found)


@query
def knn_blocks_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form for query sets that are too large to travel with the code."""
    found = knn.nearest(
        _vector_queries(spark, sf_dir),
        inputs.vectors(spark, sf_dir),
        10,
        strategy="blocks",
        cell_vectors=16,  # small, so that every label is cut into several cells
        cell_queries=8,
    )
    return _hits(found)


@query
def knn_pruned_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance bounds instead of all pairs."""
    return _hits(knn.nearest(_vector_queries(spark, sf_dir), inputs.vectors(spark, sf_dir), 10, strategy="pruned"))


@query
def knn_eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = inputs.vector_judgments(spark, sf_dir)
    asked = evaluate.judged_only(_vector_queries(spark, sf_dir), judged)
    found = knn.nearest(asked, inputs.vectors(spark, sf_dir), 10)
    return _metrics(evaluate.evaluate_retrieval(found, judged, max_list=10))


def _metrics(df: DataFrame) -> DataFrame:
    return df.select("query_id", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "map")])


# retrieval over the documents


@query
def judged_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, judged = asked_and_judged(spark, sf_dir)
    kept = evaluate.judged_only(retrieve.route(asked, inputs.dictionary(spark, sf_dir)), judged)
    return kept.select("query_text").distinct()


@query
def rerank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reranked(spark, sf_dir, "query_id")


@query
def rerank_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries of equal text share one list."""
    return _reranked(spark, sf_dir, "query_text")


def _reranked(spark: SparkSession, sf_dir: str, group: str) -> DataFrame:
    stored = collection(spark, sf_dir)
    asked, judged = asked_and_judged(spark, sf_dir)
    ranked = retrieve.retrieve_and_rerank(
        asked,
        cleaning.clean_judgments(judged),
        inputs.dictionary(spark, sf_dir),
        stored.table,
        embedder(),
        group=group,
        scorer=retrieve.overlap_scorer(stored.weights),
    )
    return ranked.select("query_id", "corpus_id", "rerank_score", "rank")


@query
def evaluate_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(_retrieval_metrics(spark, sf_dir)[0]).orderBy("query_id")


def _retrieval_metrics(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Metrics of each query, and the judgments."""
    stored = collection(spark, sf_dir)
    asked, judged = asked_and_judged(spark, sf_dir)
    metrics = retrieve.retrieve_and_evaluate(
        asked,
        judged,
        inputs.dictionary(spark, sf_dir),
        stored.table,
        embedder(),
        scorer=retrieve.overlap_scorer(stored.weights),
    )
    return metrics, judged


@query
def mean_retrieval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = evaluate.mean_metrics(_retrieval_metrics(spark, sf_dir)[0])
    return means.select(
        "n_queries", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "map")]
    )


@query
def both_mean_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means over scored and over all judged queries."""
    means = evaluate.both_means(*_retrieval_metrics(spark, sf_dir))
    return means.select("n_queries", "n_judged", *[F.round(c, 6).alias(c) for c in means.columns[2:]])


@query
def conversation_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers found for user turns, without a tag; lists of any length allowed."""
    asked, said, answers = inputs.conversation_pairs(spark, sf_dir)
    wanted = asked.select(
        "query_id", F.lit(None).cast("string").alias("ticker"), embedder().vector("query_text").alias("embedding")
    )
    texts = said.select("_id", F.lit("chat").alias("ticker"), embedder().vector("text").alias("embedding"))
    found = knn.nearest(wanted, texts, 10)
    return _metrics(evaluate.evaluate_retrieval(found, answers, unretrieved="zero", width=4))


# runs and promotion


@query
def best_run_per_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = tracking.best_run_per_branch(inputs.runs(spark, sf_dir))
    return best.select("branch", "run_name", F.round("value", 6).alias("value"))


@query
def best_main_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = tracking.best_run(inputs.runs(spark, sf_dir))
    return best.select("run_name", "branch", F.round("value", 6).alias("value"))


@query
def promotion_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = inputs.runs(spark, sf_dir)
    return _decision(tracking.promotion_decisions(runs, runs))


def _decision(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.round(c, 6) for c in ("main_score", "new_score")}
    )


@query
def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    main, current = inputs.document_manifests(spark, sf_dir)
    diff = tracking.compare_manifests(main, current)
    return tracking.with_new_versions(diff, F.lit(MAIN_VERSION))


@query
def manifest_diff_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of buckets first, rows only where they differ."""
    return tracking.compare_large_manifests(*inputs.document_manifests(spark, sf_dir), buckets=256)


def _written(df: DataFrame, folder: str) -> DataFrame:
    """``name, path`` of files, one for each row of ``name, content``, written by the tasks."""

    def write(batches):
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            paths = [f"{folder}/{name}" for name in batch.column(0).to_pylist()]
            for path, content in zip(paths, batch.column(1).to_pylist(), strict=True):
                with open(path, "wb") as out:
                    out.write(content or b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string())], names=["name", "path"])

    return df.select("name", F.col("content").cast("binary").alias("content")).mapInArrow(write, "name string, path string")


@query
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of one file for each document, and of files that are not there, one for each benchmark item."""
    folder = _fresh(spark, "files").removeprefix("file://")
    docs = inputs.table(spark, sf_dir, "documents").select(F.concat(F.lit("doc-"), "doc_id").alias("name"), F.col("text").alias("content"))
    files = store.checkpointed(_written(docs, folder))
    item = F.concat(F.lit("item-"), "item_id")
    missing = inputs.table(spark, sf_dir, "benchmark").select(item.alias("name"), F.concat(F.lit(f"{folder}/"), item).alias("path"))
    return readers.file_manifest(spark, files.unionByName(missing)).select("name", "md5")


@query
def manifest_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.integrity(tracking.compare_manifests(*inputs.document_manifests(spark, sf_dir)))


@query
def version_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One data-version record per source; lists as text."""
    diff = tracking.compare_manifests(*inputs.shard_manifests(spark, sf_dir))
    by_source = diff.withColumn("source", F.substring_index("name", "/", 1))
    entries = tracking.version_entries(by_source, F.lit(MAIN_VERSION), by=["source"])
    lists = ("changed_files", "new_files", "missing_files", "changed_versions")
    return entries.withColumns({c: F.array_join(c, ",") for c in lists})


@query
def config_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    main, current = (tracking.flatten_settings(s) for s in inputs.settings(spark, sf_dir))
    return tracking.compare_settings(main, current, on=("run_name", "key"))


@query
def track_and_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of all runs with the state of the data they were made on."""
    runs = inputs.runs(spark, sf_dir)
    main, current = inputs.shard_manifests(spark, sf_dir)
    return _decision(track.decide(runs, runs, main, current, F.lit(MAIN_VERSION)))


@query
def run_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings and data digests of all runs, logged and read back."""
    path = _fresh(spark, "run_params")
    settings = tracking.flatten_settings(inputs.settings(spark, sf_dir)[0])
    manifest = inputs.shard_manifests(spark, sf_dir)[0]
    manifest = manifest.select(F.substring_index("name", "/", 1).alias("run_name"), "name", "md5")
    writers.append_table(tracking.parameter_rows(settings, manifest), path)
    return spark.read.schema(schemas.RUN_PARAMS).parquet(path)


@query
def decision_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions written and read back."""
    path = _fresh(spark, "decision")
    runs = inputs.runs(spark, sf_dir)
    writers.write_decision(tracking.promotion_decisions(runs, runs), path)
    return _decision(spark.read.schema(schemas.PROMOTION).json(path))


@query
def track_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data-version records of all compared runs, logged with time, branch and commit and read back."""
    path = _fresh(spark, "version_log")
    runs = inputs.runs(spark, sf_dir).filter(tracking.is_compared(F.col("branch")))
    diff = tracking.compare_manifests(*inputs.shard_manifests(spark, sf_dir))
    by_source = diff.withColumn("source", F.substring_index("name", "/", 1))
    entries = tracking.version_entries(by_source, F.lit(MAIN_VERSION), by=["source"])
    writers.append_log(tracking.stamped(entries, runs, on=["source"], commit=F.sha1("run_name")), path)
    kinds = "run_name string, timestamp string, branch string, commit string, base_main_version string, changed_files array<string>, missing_files array<string>"
    logged = spark.read.schema(kinds).json(path)
    return logged.withColumns({c: F.array_join(c, ",") for c in ("changed_files", "missing_files")})


@query
def model_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings of all runs against main by section, with what is their kind."""
    main, current = (tracking.flatten_settings(s) for s in inputs.settings(spark, sf_dir))
    kinds = current.select("run_name").distinct().withColumns({"key": F.lit("corpus.type"), "value": F.col("run_name")})
    found = tracking.model_entries(main, current.unionByName(kinds), on=["run_name"])
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return found.select("run_name", "section", text("current").alias("current"), text("main").alias("main"), "differs", "type", "storage")


# user-supplied functions


def _length_encoder():
    def encode(texts: list[str]) -> np.ndarray:
        return np.array([[len(t), t.count("e"), t.count(" ")] for t in texts], dtype=np.float32)

    return encode


@query
def udf_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = corpus(spark, sf_dir).select(
        "_id", Embedder(_length_encoder, 3).vector("text").alias("v")
    )
    return made.select("_id", *[F.col("v")[i].cast("long").alias(n) for i, n in enumerate(("n_chars", "n_e", "n_spaces"))])


@query
def udf_embed_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same encoder, given texts of like lengths."""
    by_length = Embedder(_length_encoder, 3, batches=LengthBatches(rows=500, padded=1 << 16))
    made = corpus(spark, sf_dir).select("_id", by_length.vector("text").alias("v"))
    return made.select("_id", *[F.col("v")[i].cast("long").alias(n) for i, n in enumerate(("n_chars", "n_e", "n_spaces"))])


def _ratio_scorer():
    def score(queries: list[str], texts: list[str]) -> np.ndarray:
        return np.array([len(q) / (len(t) + 1) for q, t in zip(queries, texts)])

    return score


@query
def udf_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, said, answers = inputs.conversation_pairs(spark, sf_dir)
    pairs = answers.join(asked.select("query_id", "query_text"), "query_id").join(
        said.select(F.col("_id").alias("corpus_id"), "text"), "corpus_id"
    )
    scored = rerank.pair_scores(pairs, _ratio_scorer)
    return scored.select("query_id", "corpus_id", F.round("rerank_score", 6).alias("rerank_score"))


@query
def udf_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A splitter of the user's own: one sentence per line."""
    lines = chunking.split_sentences(
        inputs.raw_corpus(spark, sf_dir), split=lambda c: F.filter(F.split(c, "\n"), lambda s: s != "")
    )
    return lines.select("_id", "sentence_no", "sentence")


def _every_300(segment: Column) -> Column:
    starts = F.sequence(F.lit(1), F.length(segment), F.lit(300))
    return F.transform(starts, lambda i: F.substring(segment, i, F.lit(300)))


@query
def udf_size_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A size splitter of the user's own: every 300 characters, without an overlap."""
    pieces = chunking.size_pieces(segments(spark, sf_dir), split=_every_300)
    piece_no = F.coalesce("piece_no", F.lit(-1)).alias("piece_no")
    return pieces.select("_id", "segment_no", piece_no, "text")


@query
def udf_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A token counter of the user's own: one token per four characters."""
    marked = chunking.mark_long(corpus(spark, sf_dir), count=lambda c: F.ceil(F.length(c) / 4).cast("int"))
    return marked.select("_id", "n_tokens", "is_long")
