"""Duplicate passages by relative Lempel-Ziv parsing.

A document is parsed against all documents with smaller ids as its reference.
The reference is indexed by blocks: a block runs from one anchor, a short run of
words with the least hash among its neighbours, to the end of the next. Equal passages
have equal anchors, wherever they stand. Every block is looked up in the index. Blocks in
other documents are told apart by the blocks that follow them: each run of blocks just long enough for
a window is an entry of its own, with the smallest document that has it. The greedy
parse goes on with a factor as long as some smaller document has the next run, so it is as long as any
reference allows and does not hang on one of them. A factor of at least ``window``
words is a duplicate span. Beyond the first and last anchor of a factor, the windows whose anchors and
blocks all occur elsewhere but that lie in no factor are checked one by one in an index of such windows.

The index is a table: looking up is a join, and the smallest document of a key is found
by an aggregation that combines before the shuffle, so a passage in most documents is
never gathered. Documents with the same words as a smaller one are settled by the hash of all
their words. Of the others, only those with windows to check have their text shuffled; a
bitmap of fixed size tells most of the rest apart before (a false hit only costs time).

Words are hashed by XXH64, runs of words by the values of two polynomials modulo 2**61 - 1 at two random
places, 122 bits together.

Defined cases: null and empty texts have no words; a null ``doc_id`` is no source and loses nothing;
repeated rows and ids are no sources for each other; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.common import drop_stored, space_blocks, stored, utf8

WINDOW = 50
ANCHOR = 9  # words of an anchor
FAR = 1 << 40  # beyond every word
BITS = 26  # the bitmap has 2**BITS bits, 8 MB
PRIME = (1 << 61) - 1
BASES = (0x0F3A9C5B71E24D87, 0x15C6E1D80B93F2A5)  # two random numbers below the prime


def mixed(x: np.ndarray) -> np.ndarray:
    """Another well-mixed number for each number."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def reduced(x: np.ndarray) -> np.ndarray:
    """Numbers below 2**63, modulo the prime."""
    x = (x >> np.uint64(61)) + (x & np.uint64(PRIME))
    return np.where(x >= np.uint64(PRIME), x - np.uint64(PRIME), x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it, from halves of 31 bits."""
    low, half, under = np.uint64((1 << 31) - 1), np.uint64(31), np.uint64((1 << 30) - 1)
    ah, al, bh, bl = a >> half, a & low, b >> half, b & low
    middle, last = ah * bl + al * bh, al * bl
    # 2**61 counts as 1, so the upper product counts twice and the middle one is cut at 30 bits
    total = np.uint64(2) * (ah * bh) + (middle >> np.uint64(30)) + ((middle & under) << half)
    return reduced(total + (last >> np.uint64(61)) + (last & np.uint64(PRIME)))


def powers(base: int, size: int) -> np.ndarray:
    """1, base, base**2 and so on, modulo the prime."""
    out = np.ones(1, np.uint64)
    while len(out) < size:
        out = np.concatenate([out, times(out, np.full(len(out), pow(base, len(out), PRIME), np.uint64))])
    return out[:size]


class Runs:
    """Hashes of all runs of a sequence: values of two polynomials modulo a prime.

    ``numbers`` are two sequences of equal length, below the prime.
    """

    powers: list = [np.ones(1, np.uint64)] * 2
    inverses: list = [np.ones(1, np.uint64)] * 2

    def __init__(self, *numbers: np.ndarray):
        self.n = n = len(numbers[0])
        if len(Runs.powers[0]) <= n:
            size = 2 * n + 1
            Runs.powers = [powers(b, size) for b in BASES]
            Runs.inverses = [powers(pow(b, -1, PRIME), size) for b in BASES]
        self.sums = [self._sums(times(x, p[:n])) for x, p in zip(numbers, Runs.powers, strict=True)]

    def _sums(self, terms: np.ndarray) -> np.ndarray:
        low, high = (np.cumsum(x, dtype=np.uint64) for x in (terms & np.uint64(0xFFFFFFFF), terms >> np.uint64(32)))
        out = np.zeros(self.n + 1, np.uint64)
        out[1:] = reduced(times(reduced(high), np.full(self.n, 1 << 32, np.uint64)) + reduced(low))
        return out

    def runs(self, starts, ends, which: int) -> np.ndarray:
        """Hash of what lies from each start to each end."""
        s = self.sums[which]
        return times(reduced(s[ends] + np.uint64(PRIME) - s[starts]), Runs.inverses[which][starts])


class Words(Runs):
    """Hashes of all runs of the words of a text."""

    def __init__(self, data: bytes):
        hashed = xxhash.xxh64_intdigest
        parts = [np.fromiter(map(hashed, words), np.uint64, len(words)) for words in (b.split() for b in space_blocks(data))]
        numbers = reduced((np.concatenate(parts) if parts else np.zeros(0, np.uint64)) >> np.uint64(1))
        super().__init__(numbers, numbers)

    def anchors(self, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the anchors, and the place from which on each is the least.

        Each half window has the leftmost least of its runs of ``anchor`` words as its anchor; its
        place is that of the first half window with it.
        """
        if self.n < window:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        starts = np.arange(self.n - anchor + 1)
        keys = mixed(self.runs(starts, starts + anchor, 0))
        width = window // 2 - anchor + 1
        least = []
        for at in range(0, len(keys) - width + 1, 1 << 16):
            views = np.lib.stride_tricks.sliding_window_view(keys[at : at + (1 << 16) + width - 1], width)
            least.append(views.argmin(axis=1) + np.arange(at, at + len(views)))
        least = np.concatenate(least)
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        return least[first], first


#: ``first`` is the first place whose half window has the anchor at ``at``, ``last`` the last one whose half window has the next anchor.
BLOCK = pa.struct([("b1", pa.int64()), ("b2", pa.int64()), *((c, pa.int32()) for c in ("at", "size", "first", "last"))])
INDEXED = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("sha", pa.string()), ("blocks", pa.list_(BLOCK))]
)
INDEXED_DDL = "doc_id long, key long, n_words long, w1 long, w2 long, sha string, blocks array<struct<b1:long,b2:long,at:int,size:int,first:int,last:int>>"


def _kept(data: bytes, removed: np.ndarray | None = None) -> str:
    """Digest of the words that are not removed, joined by spaces."""
    if removed is None:
        return hashlib.sha256(b" ".join(data.split())).hexdigest()
    return hashlib.sha256(b" ".join(w for w, gone in zip(data.split(), removed.tolist(), strict=True) if not gone)).hexdigest()


def _index(window: int, anchor: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, offsets, columns = [], [0], [[] for _ in BLOCK]
            for data in utf8(batch.column(2)):
                words = Words(data)
                n, (at, first) = words.n, words.anchors(window, anchor)
                last = np.append(first[2:], n - window // 2 + 1) - 1
                at, ends, first = at[:-1], at[1:] + anchor, first[:-1]
                last = last[: len(at)]
                w = [int(words.runs(np.zeros(1, int), np.array([n]), i)[0].view(np.int64)) for i in (0, 1)]
                base.append((n, *w, _kept(data)))
                for c, x in zip(columns, (words.runs(at, ends, 0), words.runs(at, ends, 1), at, ends - at, first, last), strict=True):
                    c.append(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int32))
                offsets.append(offsets[-1] + len(at))
            fields = [pa.array(np.concatenate(c), f.type) for c, f in zip(columns, BLOCK, strict=True)]
            blocks = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(BLOCK)))
            n, w1, w2, sha = zip(*base, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(n, pa.int64()), pa.array(w1, pa.int64()), pa.array(w2, pa.int64()), pa.array(sha), blocks],
                schema=INDEXED,
            )

    return run


class Blocks:
    """The looked-up blocks of a document, in order; neighbouring ones are a chain."""

    def __init__(self, parts: pa.StructArray, anchor: int):
        column = {f.name: parts.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(parts.type)}
        order = np.argsort(column["at"])
        self.column = {c: x[order] for c, x in column.items()}
        self.at = self.column["at"].astype(np.int64)
        self.ends = self.at + self.column["size"]
        self.chain = np.cumsum(np.append(True, self.at[1:] != self.ends[:-1] - anchor))

    def runs(self, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last block of each run that holds a window and would not without one of the two."""
        least = np.searchsorted(self.ends, self.at + window)
        # the longest has the last window that starts before the next block
        most = np.searchsorted(self.ends, self.ends - anchor - 1 + window)
        size = np.maximum(most - least + 1, 0)
        first = np.repeat(np.arange(len(size)), size)
        last = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(least, size)
        inside = last < len(size)
        first, last = first[inside], last[inside]
        same = self.chain[first] == self.chain[last]
        return first[same], last[same]

    def asked(self, window: int) -> list[tuple[int, int]]:
        """Ranges of places whose windows have no anchor and no block outside a chain."""
        edge = np.flatnonzero(np.diff(self.chain))
        starts = self.column["first"][np.append(0, edge + 1)]
        ends = self.column["last"][np.append(edge, len(self.at) - 1)] - (window - window // 2) + 1
        return [(a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if a < b]


HASHED = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32()), ("end", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64())])
HASHED_DDL = "key long, doc_id long, at int, end int, w1 long, w2 long"


def _together(rows: Iterable[tuple], most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Batches of the schema ``HASHED`` from key, doc_id and arrays of the other columns."""
    out, size = [[] for _ in HASHED], 0
    for key, doc_id, *columns in rows:
        n = len(columns[0])
        for o, c in zip(out, (np.full(n, key), np.full(n, doc_id), *columns), strict=True):
            o.append(c)
        size += n
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o), f.type) for o, f in zip(out, HASHED, strict=True)], schema=HASHED)
            out, size = [[] for _ in HASHED], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o), f.type) for o, f in zip(out, HASHED, strict=True)], schema=HASHED)


def _runs(window: int, anchor: int):
    """The entries of a document: its runs of looked-up blocks, each just long enough for a window."""

    def rows(batches):
        for batch in batches:
            for key, doc_id, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                blocks = Blocks(parts.values, anchor)
                hashes = Runs(*(blocks.column[c].view(np.uint64) for c in ("b1", "b2")))
                first, last = blocks.runs(window, anchor)
                yield key, doc_id, blocks.at[first], blocks.ends[last], *(hashes.runs(first, last + 1, i).view(np.int64) for i in (0, 1))

    return lambda batches: _together(rows(batches))


def factors(found: list[tuple[int, int]], window: int) -> list[tuple[int, int]]:
    """Greedy parse: a factor goes on while the next run found leaves no window out between them."""
    spans: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if spans and start <= spans[-1][1] - window + 1:
            spans[-1] = spans[-1][0], max(end, spans[-1][1])
        else:
            spans.append((start, end))
    return spans


SPAN = pa.list_(pa.struct([("at", pa.int32()), ("end", pa.int32())]))
PARSED = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("factors", SPAN), ("asked", SPAN)])
PARSED_DDL = "key long, doc_id long, factors array<struct<at:int,end:int>>, asked array<struct<at:int,end:int>>"


def _parse(window: int, anchor: int):
    """Factors of a document, and the ranges of places at their borders whose windows are to be checked."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, ranges = [], []
            for parts, found in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                own = factors([(f["at"], f["end"]) for f in found or ()], window)
                left = []
                inner = iter([*((a, b - window + 1) for a, b in own), (FAR, FAR)])
                start, end = next(inner)
                for a, b in Blocks(parts.values, anchor).asked(window):
                    while a < b:
                        if end <= a:
                            start, end = next(inner)
                        elif start > a:
                            left.append((a, min(b, start)))
                            a = min(b, start)
                        else:
                            a = min(b, end)
                spans.append([{"at": a, "end": b} for a, b in own])
                ranges.append([{"at": a, "end": b} for a, b in left])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, SPAN), pa.array(ranges, SPAN)], schema=PARSED)

    return run


def _windows(window: int):
    """The windows of the given ranges of places, with their hashes."""

    def rows(batches):
        for batch in batches:
            for key, doc_id, data, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                words = Words(data)
                at = np.concatenate([np.arange(r["at"], r["end"]) for r in asked])
                yield key, doc_id, at, at + window, *(words.runs(at, at + window, i).view(np.int64) for i in (0, 1))

    return lambda batches: _together(rows(batches))


REMOVED = pa.schema([("key", pa.int64()), ("n_removed", pa.int64()), ("sha", pa.string())])


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, data, spans in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            gone = np.zeros(sum(len(b.split()) for b in space_blocks(data)), bool)
            for s in spans:
                gone[s["at"] : s["end"]] = True
            rows.append((key, int(gone.sum()), _kept(data, gone)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), REMOVED, strict=True)], schema=REMOVED)


def _bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """One bit set for each ``key``; made and sent as at most ``2**bits / 64`` numbers."""
    place = F.shiftrightunsigned("key", 64 - bits)
    words = keys.groupBy(F.shiftrightunsigned(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - bits}) & 63 as int))")).alias("set")).toPandas()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["set"].to_numpy(np.int64).view(np.uint64)
    return out


def _where(bitmap, bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bitmap.value
        for batch in batches:
            place = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            here = known[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)
            yield batch.filter(pa.array(here == 1))

    return run


def _texts_of(texts: DataFrame, keys: DataFrame, bits: int) -> DataFrame:
    """``key, text`` of the rows whose key is among ``keys``, and of a few others; one row for each key."""
    known = texts.sparkSession.sparkContext.broadcast(_bitmap(keys, bits))
    return texts.select("key", "text").mapInArrow(_where(known, bits), "key long, text string")


def duplicates(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, bits: int = BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the parse finds, as three tables.

    The rows: ``doc_id, key, n_words, sha, copied`` for every row of ``docs``, where ``key``
    stands for its id and text and ``copied`` tells that all its words are those of a
    smaller document. The spans: ``key, spans`` with ``at`` and ``end`` in words, for the others. And the texts: ``key, text``.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.select("doc_id", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("key"), "text")
    indexed = stored(texts.mapInArrow(_index(window, anchor), INDEXED_DDL), "blocks")
    whole = indexed.filter(F.col("n_words") >= window).groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    # what is looked up is written first: only then can Spark split the other side where a key is frequent
    whole = stored(whole.filter("n > 1").select("w1", "w2", "least"), "whole")
    rows = indexed.join(whole, ["w1", "w2"], "left").withColumn("copied", F.coalesce(F.col("least") < F.col("doc_id"), F.lit(False)))
    rows = stored(rows.select("doc_id", "key", "n_words", "sha", "copied", F.when(~F.col("copied") & F.col("doc_id").isNotNull(), F.col("blocks")).alias("blocks")), "rows")
    drop_stored(indexed)

    blocks = rows.select("doc_id", "key", F.explode("blocks").alias("b")).select("doc_id", "key", "b.*")
    shared = stored(_in_two(blocks, "b1", "b2").select("b1", "b2"), "shared")
    looked = blocks.join(shared, ["b1", "b2"]).groupBy("key", "doc_id")
    parts = stored(looked.agg(F.collect_set(F.struct("at", "size", "first", "last", "b1", "b2")).alias("parts")), "parts")
    drop_stored(shared)

    runs = stored(parts.mapInArrow(_runs(window, anchor), HASHED_DDL), "runs")
    found = _repeated(runs).groupBy("key").agg(F.collect_set(F.struct("at", "end")).alias("found"))
    narrow = parts.select("key", "doc_id", F.transform("parts", lambda p: F.struct(*(p[c].alias(c) for c in ("at", "size", "first", "last")))).alias("parts"))
    parsed = stored(narrow.join(stored(found, "found"), "key", "left").mapInArrow(_parse(window, anchor), PARSED_DDL), "parsed")
    drop_stored(parts)
    drop_stored(runs)

    asked = parsed.filter(F.size("asked") > 0).select("key", "doc_id", "asked")
    joined = _texts_of(texts, asked, bits).join(asked, "key").dropDuplicates(["key"]).select("key", "doc_id", "text", "asked")
    checked = stored(joined.mapInArrow(_windows(window), HASHED_DDL), "windows")
    factored = parsed.select("key", F.explode("factors").alias("f")).select("key", "f.at", "f.end")
    marked = stored(_repeated(checked).unionByName(factored), "marked")
    drop_stored(checked)
    return rows.drop("blocks"), stored(marked.groupBy("key").agg(F.collect_list(F.struct("at", "end")).alias("spans")), "spans"), texts


def _in_two(hashed: DataFrame, *by: str) -> DataFrame:
    """Hashes that at least two documents have, with the smallest of them as ``lo``."""
    return hashed.groupBy(*by).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").drop("hi")


def _repeated(hashed: DataFrame) -> DataFrame:
    """``key, at, end`` of the rows whose hash a smaller document has."""
    least = stored(_in_two(hashed, "w1", "w2"), "least")
    return hashed.join(least, ["w1", "w2"]).filter("doc_id > lo").select("key", "at", "end")


def removed(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, bits: int = BITS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row of ``docs``."""
    rows, spans, texts = duplicates(docs, window, anchor, bits)
    joined = _texts_of(texts, spans, bits).join(spans, "key").dropDuplicates(["key"]).select("key", "text", "spans")
    changed = joined.mapInArrow(_remove, "key long, n_removed long, sha string").withColumnRenamed("sha", "new")
    return rows.join(changed, "key", "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("copied"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(F.col("copied"), F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("new", "sha")).alias("kept_sha256"),
    )
