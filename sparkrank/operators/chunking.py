"""Routing of long documents, cutting them, and naming the pieces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrank.functions import splitting
from sparkrank.functions import text as T
from sparkrank.functions.embedding import Embedder
from sparkrank.operators.ordered import WIDTH, occurrence_number, place_in_run, running_sums
from sparkrank.operators.skew import broadcast_if_small
from sparkrank.sources.collection import checkpointed

LONG_WORDS = 300
SIMILARITY = 0.55
PIECE_SIZE = 300
PIECE_OVERLAP = 30


def mark_long(
    docs: DataFrame,
    *,
    limit: int = LONG_WORDS,
    count: Callable[[str], Column] = T.word_count,
) -> DataFrame:
    """Add ``n_tokens`` and ``is_long``; ``count`` may be any token counter."""
    counted = docs.withColumn("n_tokens", count("text"))
    return counted.withColumn("is_long", F.col("n_tokens") > limit)


def skip_after_removal(marked: DataFrame, pos: str = "pos", width: int = WIDTH) -> DataFrame:
    """The routing of a loop that removes items from the list it walks.

    The document after a removed one is never looked at, so of every run of long
    documents only the 1st, 3rd, 5th and so on count as long.
    """
    placed = place_in_run(marked, "is_long", pos, "__place", width)
    return placed.withColumn("is_long", F.col("__place") % 2 == 1).drop("__place")


def split_sentences(docs: DataFrame, split: Callable[[str], Column] = T.sentences) -> DataFrame:
    """One row per sentence: ``_id, pos_in_doc, sentence``."""
    cut = docs.select("_id", F.posexplode_outer(split("text")).alias("sentence_no", "sentence"))
    return cut.filter(F.col("sentence_no").isNotNull())


def semantic_segments(
    docs: DataFrame,
    embedder: Embedder,
    *,
    threshold: float = SIMILARITY,
    split: Callable[[str], Column] = T.sentences,
    only: str | None = None,
    whole: bool = False,
) -> DataFrame:
    """Documents cut where neighbouring sentences stop being similar.

    The sentences of a document stay in its row, so nothing is shuffled. Adds
    ``segment_no`` and ``segment``; a document without a sentence has no row.
    ``only`` names a flag column: documents without the flag have no row, or
    stay one segment with ``whole``. A flag is looked at inside the expressions,
    because Spark would move a filter on it, and with it a second evaluation of
    all the cleaning behind the flag, down to the scan.
    """
    flag = F.col(only) if only else F.lit(True)
    joined = embedder.segments(F.when(flag, split("text")), threshold)
    rest = F.array("text") if whole else F.lit(None)
    segments = docs.withColumn("__segments", F.when(flag, joined).otherwise(rest)).drop("text")
    return _explode(segments, "__segments", "segment_no", "segment")


def size_pieces(
    segments: DataFrame,
    *,
    size: int = PIECE_SIZE,
    overlap: int = PIECE_OVERLAP,
    split: Callable[[Column], Column] | None = None,
    only: str | None = None,
) -> DataFrame:
    """Segments over ``size`` characters cut into overlapping pieces.

    Adds ``piece_no`` (null for a segment that stays whole) and ``text``.
    Segments without the flag ``only`` stay whole.
    """
    segment = F.when(F.col(only), F.col("segment")) if only else F.col("segment")
    pieces = split(segment) if split else splitting.size_pieces(segment, size, overlap)
    whole = F.length("segment") <= size
    if only:
        whole = whole | ~F.col(only)
        pieces = F.when(F.col(only), pieces).otherwise(F.array("segment"))
    cut = segments.withColumns({"__pieces": pieces, "__whole": whole}).drop("segment")
    rows = _explode(cut, "__pieces", "piece_no", "text")
    return rows.withColumn("piece_no", F.when(~F.col("__whole"), F.col("piece_no"))).drop("__whole")


def _explode(df: DataFrame, array: str, number: str, value: str) -> DataFrame:
    # The outer form with a filter behind it: for the inner form Spark repeats
    # the whole array expression in a filter below.
    kept = [c for c in df.columns if c != array]
    rows = df.select(*kept, F.posexplode_outer(array).alias(number, value))
    return rows.filter(F.col(number).isNotNull())


def chunk_ids(pieces: DataFrame, suffix: str | None = None) -> DataFrame:
    """Chunk id from parent id, segment and piece number; keeps ``parent_id``.

    ``suffix`` names a column that tells documents with the same id apart.
    """
    parts = [F.col(c).cast("string") for c in (suffix, "segment_no", "piece_no") if c]
    return pieces.withColumn("parent_id", F.col("_id")).withColumn("_id", F.concat_ws("_", "_id", *parts))


# Counters and repeat numbers are broadcast up to this many rows (about 100 bytes each).
BROADCAST_REPEATS = 1_000_000


def segment_counters(segments: DataFrame, pos: str = "pos", width: int = WIDTH) -> DataFrame:
    """``pos, __first, __doc_no``: segments and documents before each document that gave segments.

    Of the segments only ``pos`` is shuffled.
    """
    # written: positions are looked at before the sums are made
    per_doc = checkpointed(segments.groupBy(pos).agg(F.count(F.lit(1)).alias("__n")))
    run = running_sums(per_doc, {"__segments": F.col("__n"), "__docs": F.lit(1)}, pos, width=width)
    return run.select(
        pos, (F.col("__segments") - F.col("__n")).alias("__first"), (F.col("__docs") - 1).alias("__doc_no")
    )


def with_counters(
    rows: DataFrame, counters: DataFrame, pos: str = "pos", broadcast_rows: int = BROADCAST_REPEATS
) -> DataFrame:
    """Documents with their counters, joined before they are cut.

    A counted and small table of counters is broadcast, so texts stay where they lie; beyond
    that documents are shuffled once, and not their overlapping pieces. Rows without a position share
    one counter.
    """
    known = broadcast_if_small(counters.withColumnRenamed(pos, "__pos"), broadcast_rows)
    return rows.join(known, F.col(pos).eqNullSafe(F.col("__pos")), "left").drop("__pos")


def counter_chunk_ids(
    pieces: DataFrame, segments: DataFrame | None = None, pos: str = "pos", width: int = WIDTH
) -> DataFrame:
    """Chunk ids whose digits run together: counter, document, segment, piece.

    The counter runs over the segments of all documents in order, the document
    number over the documents that gave segments. Pieces of documents that went
    through :func:`with_counters` need nothing else; others need ``segments``, the
    rows before size splitting.
    """
    if segments is not None:
        pieces = with_counters(pieces, segment_counters(segments, pos, width), pos)
    digits = F.concat(
        (F.col("__first") + F.col("segment_no")).cast("string"),
        F.col("__doc_no").cast("string"),
        F.col("segment_no").cast("string"),
        F.coalesce(F.col("piece_no").cast("string"), F.lit("")),
    )
    named = pieces.withColumn("parent_id", F.col("_id"))
    return named.withColumn("_id", F.concat_ws("_", "_id", digits)).drop("__first", "__doc_no")


def repeat_numbers(docs: DataFrame, pos: str = "pos", width: int = WIDTH) -> DataFrame:
    """``_id, pos, repeat`` of the second and later documents with an id.

    Only documents whose id repeats are looked at any further.
    """
    repeated = docs.groupBy("_id").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    # a repeated id may be that of most documents: they meet the ids where they lie, as long as those are few
    ids = broadcast_if_small(repeated.select("_id"), BROADCAST_REPEATS)
    affected = checkpointed(docs.select("_id", pos).join(ids, "_id", "left_semi"))
    return occurrence_number(affected, "_id", pos, "repeat", width).filter("repeat > 0")


def number_repeats(
    docs: DataFrame, pos: str = "pos", width: int = WIDTH, broadcast_rows: int = BROADCAST_REPEATS
) -> DataFrame:
    """Give the n-th repeat of an id the suffix ``_n``; keeps ``parent_id``.

    Texts are shuffled only when more than ``broadcast_rows`` documents repeat an id.
    """
    numbers = broadcast_if_small(repeat_numbers(docs, pos, width), broadcast_rows)
    joined = docs.join(numbers, ["_id", pos], "left")
    suffixed = F.concat_ws("_", "_id", F.col("repeat").cast("string"))
    return (
        joined.withColumn("parent_id", F.col("_id")).withColumn("_id", suffixed).drop("repeat")
    )


def chunk_documents(
    docs: DataFrame,
    embedder: Embedder,
    *,
    pos: str = "pos",
    threshold: float = SIMILARITY,
    size: int = PIECE_SIZE,
    overlap: int = PIECE_OVERLAP,
    split: Callable[[str], Column] = T.sentences,
    split_segment: Callable[[Column], Column] | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """Marked documents as chunks, ids numbered: one pass without a shuffle.

    Long documents are segmented and packed, short ones stay whole; both kinds
    leave the same scan. Documents with a repeated id are looked up first, on
    the narrow id columns: short ones get their repeat number, long ones their
    position in the chunk ids, so chunk ids are unique. When such documents are
    few, which the lookup counts, their suffixes are broadcast; otherwise chunks
    and suffixes are joined by id and position, which no two documents share.
    """
    segments = semantic_segments(
        docs, embedder, threshold=threshold, split=split, only="is_long", whole=True
    )
    pieces = size_pieces(segments, size=size, overlap=overlap, split=split_segment, only="is_long")
    number = F.when(F.col("is_long"), F.col("segment_no"))
    pieces = pieces.withColumn("segment_no", number)

    repeated = docs.groupBy("_id").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    affected = repeated.agg(F.sum("__n")).first()[0] or 0
    if affected == 0:
        return chunk_ids(pieces)
    marks = docs.select("_id", pos, "is_long")
    if affected <= BROADCAST_REPEATS:
        # only documents with such an id are read and cleaned again
        marks = marks.join(F.broadcast(repeated.select("_id")), "_id", "left_semi")
        suffixes = F.broadcast(_suffixes(marks, pos, width))
    else:
        # written first, so that the flags and not the texts are shuffled
        marks = checkpointed(marks).join(repeated.select("_id"), "_id", "left_semi")
        suffixes = _suffixes(marks, pos, width)
    return chunk_ids(pieces.join(suffixes, ["_id", pos], "left"), "__suffix").drop("__suffix")


def _suffixes(marks: DataFrame, pos: str, width: int) -> DataFrame:
    """``_id, pos, __suffix`` of documents that share their id with others."""
    short = F.when(F.col("is_long"), 0).otherwise(1)
    counted = running_sums(marks, {"__n": short}, pos, ["_id"], width)
    suffix = F.when(F.col("is_long"), F.concat(F.lit("p"), F.col(pos).cast("string"))).when(
        F.col("__n") > 1, (F.col("__n") - 1).cast("string")
    )
    return counted.select("_id", pos, suffix.alias("__suffix"))


def combine(short_docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """Short documents and chunks in one collection, tagged by entity.

    For parts that come from different places; :func:`chunk_documents` gives
    both kinds in one pass.
    """
    columns = ["_id", "parent_id", "title", "text"]
    return tagged(short_docs.select(*columns).unionByName(chunks.select(*columns)))


def tagged(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("ticker", T.tag_of("parent_id"))


def repeated_ids(collection: DataFrame) -> DataFrame:
    """Ids that occur more than once, with their count; empty when unique."""
    return collection.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
