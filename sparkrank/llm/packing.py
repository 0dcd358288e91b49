"""Packing by concatenate and cut.

All documents, each closed by an end id, form one long run of token ids, and
sequences are fixed windows of it. Two passes find the place of every document:
the first encodes the rows of each partition and notes running offsets inside the
partition; the totals of the partitions, summed up, then give each partition its
place in the whole. A document that crosses a window border becomes two or more
boundary records.

Defined cases: a null or empty text has the end id alone; repeated rows are packed
each; a null ``doc_id`` is kept; an empty table gives no rows; other columns are
not read, whatever their names. Only the last sequence needs padding.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrank.llm.common import per_process, stored, utf8

SIZE = 4096
END_ID = 2
FLUSH_BYTES = 8 << 20
CHUNKS, CORES = 150_000, 400_000  # entries kept by a task's caches

#: A chunk of Latin letters between marks: no apostrophe, so each part is one unit of the tokenizer.
SIMPLE = re.compile(r"([!-&(-/:-@\[-`{-~]*)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class ChunkEncoder:
    """Token ids of texts, chunk by chunk, for a tokenizer whose units never contain white space.

    Chunks between white space are encoded once and kept, as little-endian
    unsigned 32-bit ids. Words of Latin letters go straight to the tokenizer's model,
    everything else through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        # the tokenizer takes these out of a text before anything else
        special = [re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or "(?!)")
        self.model = self.whole.model
        self.chunks: dict[bytes, bytes] = {}
        self.cores: dict[str, bytes] = {}
        # byte-level alphabets show printable Latin-1 bytes as themselves, the others from U+0100 on
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = iter(range(256, 512))
        self.shown = {b: chr(b if b in shown else next(rest)) for b in range(256)}

    def _core(self, word: str) -> bytes:
        ids = self.cores.get(word)
        if ids is None:
            text = word if word.isascii() else "".join(self.shown[b] for b in word.encode())
            ids = np.array([t.id for t in self.model.tokenize(text)], "<u4").tobytes()
            if len(self.cores) >= CORES:
                self.cores.clear()
            self.cores[word] = ids
        return ids

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        simple = SIMPLE.fullmatch(text) if len(text) <= 100 else None
        if simple and not self.special.search(text):
            head, word, tail = simple.groups()
            ids = self._core(word.lower())
            if head or tail:
                ids = (self._core(head) if head else b"") + ids + (self._core(tail) if tail else b"")
        else:
            found = self.whole.encode(text, add_special_tokens=False).ids
            ids = np.array(found, "<u4").tobytes()
        if len(chunk) <= 64:
            if len(self.chunks) >= CHUNKS:
                self.chunks.clear()
            self.chunks[chunk] = ids
        return ids

    def encode(self, data: bytes) -> bytes:
        words = data.split()
        found = list(map(self.chunks.get, words))
        if None in found:
            found = [self._chunk(w) if ids is None else ids for w, ids in zip(words, found, strict=True)]
        return b"".join(found)


ENCODED = pa.schema(
    [("part", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
)
ENCODED_DDL = "part int, doc_id long, first long, doc_tokens long, ids binary"


def _encode(path: str, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        encode, end = per_process(f"tokens {path}", lambda: ChunkEncoder(path)).encode, np.array([end_id], "<u4").tobytes()

        def rows(held):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), ENCODED, strict=True)], schema=ENCODED)

        for batch in batches:
            held, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                ids = encode(text) + end
                held.append((part, doc_id, at, len(ids) // 4, ids))
                at += len(ids) // 4
                size += len(ids)
                if size >= FLUSH_BYTES:
                    yield rows(held)
                    held, size = [], 0
            if held:
                yield rows(held)

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents in sequences of ``size`` ids.

    Gives ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``; ``ids``
    are little-endian unsigned 32-bit numbers, ``start`` counts the document's ids
    before the piece, ``offset`` those of the sequence before it. ``tokenizer`` is
    a file that every executor finds. What is broadcast is one number for each
    input partition.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    encoded = stored(texts.mapInArrow(_encode(tokenizer, end_id), ENCODED_DDL), "tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = encoded.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    bases = bases.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = encoded.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("first"))
    end, width = F.col("at") + F.col("doc_tokens"), F.lit(size).cast("long")

    def piece(s):
        lo, hi = F.greatest("at", s * width), F.least(end, (s + 1) * width)
        cut = F.substring("ids", ((lo - F.col("at")) * 4 + 1).cast("int"), ((hi - lo) * 4).cast("int"))
        return F.struct(
            (lo - F.col("at")).alias("start"), (hi - lo).alias("length"), s.alias("sequence_id"), (lo - s * width).alias("offset"), cut.alias("ids")
        )

    windows = F.sequence(F.expr(f"at div {size}"), F.expr(f"(at + doc_tokens - 1) div {size}"))
    pieces = placed.select("doc_id", "doc_tokens", F.explode(F.transform(windows, piece)).alias("p"))
    return pieces.select("doc_id", "p.start", "p.length", "doc_tokens", "p.sequence_id", "p.offset", "p.ids")


def sequences(pieces: DataFrame, size: int = SIZE, pad_id: int = END_ID) -> DataFrame:
    """``sequence_id, ids, length``: whole sequences, padded with ``pad_id`` to ``size`` ids.

    A sequence has at most ``size`` ids, so no group is large.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = pieces.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("length"))
    pad = F.lit(np.full(size, pad_id, "<u4").tobytes())
    joined = F.aggregate(F.transform("parts", lambda p: p.ids), F.lit(b""), lambda a, b: F.concat(a, b))
    return rows.select("sequence_id", F.substring(F.concat(joined, pad), F.lit(1), F.lit(size * 4)).alias("ids"), "length")
