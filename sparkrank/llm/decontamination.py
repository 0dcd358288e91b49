"""Benchmark decontamination by Wu-Manber search.

The test strings are the windows of ten consecutive words of every benchmark item.
All of them are searched at once in the normalised text of a document: a table of
shifts by block of characters skips positions where no string can end. Where it
allows no shift, the hash of the block that ends there selects a bucket: the strings
whose first ``m`` bytes (the length of the shortest string) end with this block. Within
the bucket the first block leaves few of them, and a direct comparison confirms them.

The strings travel to the tasks in groups of bounded size; documents are read
once for each group, and one group holds about half a million windows. A group is a share of the
pairs of window and item, so a window of a million items is dealt over groups, too.

Defined cases: null and empty texts have no words; an item without an id takes no part; items that share
an id are one; repeated documents get equal rows, a null ``doc_id`` is kept; an empty
benchmark hits nothing; an empty document table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.common import stored, utf8

WINDOW = 10
GROUP_BYTES = 64 << 20
LONG_TEXT = 4 << 20
SHORT = 16  # strings below so many bytes are searched apart, for they allow small shifts only

#: Word characters are 0-9, a-z (A-Z lowered) and all bytes of non-ASCII characters.
WORDS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
SPACES = re.compile(b" +")


def normalised(data: bytes) -> bytes:
    """The words of a text, each with one space before and after it; empty without words."""
    line = data.translate(WORDS)
    if len(line) < LONG_TEXT:
        words = line.split()
        return b" " + b" ".join(words) + b" " if words else b""
    line = SPACES.sub(b" ", b" " + line + b" ")
    return line if len(line) > 1 else b""


class WuManber:
    """Search for many byte strings, none empty."""

    def __init__(self, patterns: Iterable[bytes]):
        patterns = set(patterns)
        self.m = m = min(map(len, patterns))
        self.block = block = max(1, min(12, m // 2))
        self.default = m - block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[bytes]]] = defaultdict(lambda: defaultdict(list))
        for p in patterns:
            for end in range(block, m + 1):
                key = p[end - block : end]
                self.shift[key] = min(self.shift.get(key, self.default), m - end)
            self.buckets[p[m - block : m]][p[:block]].append(p)

    def search(self, line: bytes) -> Iterator[tuple[int, bytes]]:
        """Start and string of every occurrence."""
        m, block, default, n = self.m, self.block, self.default, len(line)
        shift, buckets = self.shift.get, self.buckets
        end = m
        while end <= n:
            last = line[end - block : end]
            step = shift(last, default)
            if step:
                end += step
                continue
            start = end - m
            for p in buckets[last].get(line[start : start + block], ()):
                if line.startswith(p, start):
                    yield start, p
            end += 1


class Searcher:
    """Words of a text inside occurrences of windows, and the items of these windows."""

    def __init__(self, windows: list[tuple[bytes, str]]):
        self.items: dict[bytes, set[str]] = defaultdict(set)
        for window, item in windows:
            self.items[window].add(item)
        short = [w for w in self.items if len(w) < SHORT]
        long = [w for w in self.items if len(w) >= SHORT]
        self.machines = [WuManber(x) for x in (short, long) if x]

    def find(self, data: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, ranges of hit words (end exclusive), items."""
        line = normalised(data)
        n_words = line.count(b" ") - 1 if line else 0
        found = [x for machine in self.machines for x in machine.search(line)]
        if not found:
            return n_words, [], []
        spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        ranges: list[tuple[int, int]] = []
        for first, last in sorted((int(np.searchsorted(spaces, at)), int(np.searchsorted(spaces, at + len(p) - 1))) for at, p in found):
            if ranges and first <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(last, ranges[-1][1]))
            else:
                ranges.append((first, last))
        return n_words, ranges, sorted(set().union(*(self.items[p] for _, p in found)))


WINDOWS = pa.schema([("item_id", pa.string()), ("window", pa.binary())])


def _windows(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, windows = [], []
            for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                own = normalised(text).split()
                if own:
                    found = {b" " + b" ".join(own[i : i + words]) + b" " for i in range(max(1, len(own) - words + 1))}
                    windows.extend(found)
                    ids.extend([item] * len(found))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(windows, pa.binary())], schema=WINDOWS)

    return run


def window_groups(benchmark: DataFrame, words: int = WINDOW, group_bytes: int = GROUP_BYTES, items: bool = True) -> Iterator[list[tuple[bytes, str]]]:
    """All (window, item) pairs in lists of about ``group_bytes`` at most, one at a time.

    Pairs are dealt by window and item, so a window of many items is in several lists. Without ``items``
    every window comes once, with an empty item.
    """
    texts = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    pairs = texts.filter("item_id is not null").mapInArrow(_windows(words), "item_id string, window binary")
    pairs = (pairs if items else pairs.select(F.lit("").alias("item_id"), "window")).distinct()
    pairs = stored(pairs, "windows")
    total = pairs.agg(F.sum(F.octet_length("window") + F.octet_length("item_id") + 100)).first()[0] or 0
    groups = -(-total // group_bytes)
    for g in range(groups):
        own = pairs.filter(F.pmod(F.xxhash64("window", "item_id"), F.lit(groups)) == g) if groups > 1 else pairs
        yield [(bytes(r.window), r.item_id) for r in own.select("window", "item_id").toLocalIterator()]


HITS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("row_hash", pa.int64()),
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)
HITS_DDL = "doc_id long, row_hash long, n_words long, hits array<struct<first:long,end:long>>, items array<string>"


def _search(windows):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(windows.value)
        for batch in batches:
            found = [searcher.find(x) for x in utf8(batch.column(2))]
            hits = [[{"first": a, "end": b} for a, b in f[1]] for f in found]
            columns = [batch.column(0).cast(pa.int64()), batch.column(1), pa.array([f[0] for f in found], pa.int64()), pa.array(hits, HITS.field(3).type), pa.array([f[2] for f in found], HITS.field(4).type)]
            yield pa.RecordBatch.from_arrays(columns, schema=HITS)

    return run


def _merged(ranges):
    """Sorted ranges of which no two touch."""
    last = lambda acc: F.element_at(acc, -1)

    def add(acc, r):
        joined = F.struct(last(acc)["first"].alias("first"), F.greatest(last(acc)["end"], r["end"]).alias("end"))
        touches = (F.size(acc) > 0) & (r["first"] <= F.try_element_at(acc, F.lit(-1))["end"])
        return F.when(touches, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(r)))

    return F.aggregate(F.array_sort(ranges), F.expr("cast(array() as array<struct<first:bigint,end:bigint>>)"), add)


def search(docs: DataFrame, benchmark: DataFrame, words: int = WINDOW, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``doc_id, n_words, hits, items`` for every row of ``docs``.

    ``hits`` are ranges of word numbers, end exclusive, that occurrences cover;
    ``items`` the ids, as strings, of the items with an occurring window.
    """
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_hash"), F.col("text").cast("string").alias("text"))
    parts = [texts.mapInArrow(_search(context.broadcast(g)), HITS_DDL) for g in window_groups(benchmark, words, group_bytes)]
    if len(parts) < 2:
        found = parts[0] if parts else texts.mapInArrow(_search(context.broadcast([])), HITS_DDL)
        return found.select("doc_id", "n_words", "hits", "items")
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.union(p.filter("size(hits) > 0"))
    # the first group has a row for every document, also for those that are repeated
    extra = rows.groupBy("doc_id", "row_hash").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_set("hits")).alias("hits"), F.flatten(F.collect_set("items")).alias("items"))
    merged = extra.select("doc_id", "row_hash", "n_words", _merged("hits").alias("hits"), F.array_sort(F.array_distinct("items")).alias("items"))
    keys = texts.select("doc_id", "row_hash")
    same = keys["doc_id"].eqNullSafe(merged["doc_id"]) & keys["row_hash"].eqNullSafe(merged["row_hash"])
    return keys.join(merged, same).select(keys["doc_id"], "n_words", "hits", "items")


def _clean(windows, text_at: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(windows.value)
        for batch in batches:
            yield batch.filter(pa.array([not searcher.find(x)[1] for x in utf8(batch.column(text_at))], pa.bool_()))

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, words: int = WINDOW, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, with all their columns; nothing is shuffled."""
    context, at = docs.sparkSession.sparkContext, docs.columns.index("text")
    for group in window_groups(benchmark, words, group_bytes, items=False):
        docs = docs.mapInArrow(_clean(context.broadcast(group), at), docs.schema)
    return docs
