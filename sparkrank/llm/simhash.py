"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits is cut into segments. Two fingerprints that differ in at
most ``distance`` bits differ in at most ``distance // segments`` bits of one segment
at least, so each one looks up, for every segment, the keys of a small Hamming ball in
a table of all fingerprints by segment. What meets under a key is verified on
the complete fingerprints.

Equal fingerprints are one entry from the start. Under one key only a spanning
forest of the links is kept, never all pairs; a key with many entries is dealt
over cells of bounded size that together compare every pair of its entries.

Defined cases: a null text counts as empty, and empty texts have fingerprint zero,
linked like any other; repeated rows and repeated ids get equal rows; a null
``doc_id`` is never the smallest of a component, a component without ids has null; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.common import record, release, sorted_groups, space_blocks, stored, utf8
from sparkrank.llm.components import components

SHINGLE_WORDS = 3
DISTANCE = 3
SEGMENTS = 2
SEED = 42
CELL = 4096  # entries of one key in a cell


def fingerprint(data: bytes, words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a text: bits set in over half the hashes of its shingles."""
    total, bits = 0, np.zeros(64, np.int64)
    held: list[bytes] = []
    hashed = xxhash.xxh64_intdigest
    for block in space_blocks(data):
        new = block.lower().split()
        if not new:
            continue
        part = held + new
        if len(part) >= words:
            line = b" ".join(part)
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
            starts = [0, *(ends[:-1] + 1).tolist()]
            found = [hashed(line[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=False)]
            rows = np.array(found, "<u8").view(np.uint8).reshape(-1, 8)
            bits += np.unpackbits(rows, axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += len(found)
        held = part[-(words - 1) :] if words > 1 else []
    if not total:
        if not held:
            return 0
        total = 1
        bits = np.unpackbits(np.array([hashed(b" ".join(held), SEED)], "<u8").view(np.uint8), bitorder="little")
    return int(np.packbits(bits * 2 > total, bitorder="little").view("<u8")[0])


PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("key", pa.int64())])


def _fingerprints(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            found = np.fromiter((fingerprint(x, words) for x in utf8(batch.column(1))), np.uint64, batch.num_rows)
            columns = [batch.column(0).cast(pa.int64()), pa.array(found.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(PRINTS)[: len(columns)]))

    return run


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, key: str | None = None) -> DataFrame:
    """``doc_id, fp`` and, if a ``key`` column is named, ``key`` for every row; ``fp`` holds the 64 bits as a signed number."""
    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    texts = docs.select(*cols, *([F.col(key).alias("key")] if key else []))
    return texts.mapInArrow(_fingerprints(words), "doc_id long, fp long" + (", key long" if key else ""))


def _entries(prints: DataFrame, distance: int, segments: int) -> DataFrame:
    """``segment, key, fp, own``: the tables and, with ``own`` 0, the looked-up keys.

    Of two fingerprints whose segments differ, only the one that has the lowest
    differing bit set looks the other up.
    """
    width, radius = 64 // segments, distance // segments
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]
    parts = F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), F.shiftrightunsigned("fp", s * width).bitwiseAND(F.lit((1 << width) - 1)).alias("part")) for s in range(segments)]))
    ball = F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m & -m).cast("long").alias("low")) for m in masks]))
    rows = prints.select("fp", parts.alias("s")).select("fp", "s.segment", "s.part", ball.alias("m"))
    rows = rows.filter((F.col("m.mask") == 0) | (F.col("part").bitwiseAND(F.col("m.low")) != 0))
    return rows.select("segment", F.col("part").bitwiseXOR(F.col("m.mask")).alias("key"), "fp", (F.col("m.mask") == 0).cast("int").alias("own"))


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _forest(distance: int):
    """A spanning forest of the links in each cell, found by growing one tree after another."""

    def links(prints: np.ndarray) -> Iterator[tuple[int, int]]:
        rest = np.unique(prints)
        while len(rest) > 1:
            tree, rest, root = [rest[0]], rest[1:], rest[0]
            while tree and len(rest):
                near = np.bitwise_count(rest ^ tree.pop()) <= distance
                if near.any():
                    reached = rest[near]
                    rest = rest[~near]
                    tree.extend(reached)
                    for x in reached.tolist():
                        yield int(root), x

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in sorted_groups(batches, ["segment", "key", "ci", "cj"]):
            found.extend(links(group["fp"]))
            if len(found) >= 50_000:
                yield record(LINKS, *zip(*found, strict=True))
                found = []
        if found:
            yield record(LINKS, *zip(*found, strict=True))

    return run


def links(prints: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, cell: int = CELL) -> DataFrame:
    """``a, b``: links of a table of distinct ``fp`` that join the same components as all links do."""
    rows = _entries(prints, distance, segments)
    kept = rows.groupBy("segment", "key").agg(F.count("*").alias("n"), F.sum("own").alias("tabled")).filter("n > 1 and tabled > 0")
    # written first: only then can Spark split the other side where a key is frequent
    met = rows.join(stored(kept.drop("tabled"), "kept"), ["segment", "key"])
    blocks = F.ceil(F.col("n") / cell).cast("int")
    met = met.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = met.select("segment", "key", F.least("block", "other").alias("ci"), F.greatest("block", "other").alias("cj"), "fp")
    keys = ["segment", "key", "ci", "cj"]
    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_forest(distance), "a long, b long")


def _labels(prints: DataFrame, distance: int, segments: int) -> DataFrame:
    """``fp, component_id, root`` for every fingerprint; ``root`` tells components apart also where ids repeat."""
    # the entry of a fingerprint: its smallest document
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), distance, segments))
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp").select("fp", "root", "least")
    linked = stored(linked, "linked")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(smallest, "root").select("fp", "component_id", "root")
    labels = distinct.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("root", "fp").alias("root"))
    return stored(labels, "labels")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    prints = stored(fingerprints(docs, words), "prints")
    labels = _labels(prints, distance, segments)
    return prints.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest ``doc_id``, with all its columns.

    Of several rows of that id in a group the one with the smallest hash of its contents
    stays; an id in several groups stays once in each. Rows without an id are
    grouped among themselves in the same way.
    """
    # the hash passes over nulls, so they are told apart by flags
    key = F.xxhash64(*(x for c in docs.columns for x in (F.col(c), F.col(c).isNull())))
    keyed = docs.withColumn("__key", key)
    prints = stored(fingerprints(keyed, key="__key"), "prints")
    row = F.min(F.struct("doc_id", "key")).alias("row")
    # the candidate of each fingerprint first, so that large groups are few rows
    least = prints.groupBy("fp", F.col("doc_id").isNull().alias("unnamed")).agg(row)
    roots = _labels(prints, DISTANCE, SEGMENTS).select("fp", "root")
    kept = least.join(roots, "fp").groupBy("root", "unnamed").agg(F.min("row").alias("row")).select(F.col("row.key").alias("__key")).distinct()
    return keyed.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
