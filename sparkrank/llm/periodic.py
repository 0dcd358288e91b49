"""Periodic runs by a dictionary of basic factors.

A run is a stretch of words with smallest period ``q`` that cannot be made longer to
either side. For each power of two ``m`` the dictionary names every stretch of ``m`` words,
so that equal stretches have equal names; the names for ``2 * m`` come from pairs of names
for ``m``. A stretch and its successor, the next one of that name, at a distance
``m / 2 < q <= m`` lie within twice its length and propose the period ``q``. Neighbouring
places with the same distance are one progression, and a progression is a whole run: each of
its stretches holds a full period, whose only occurrences inside the run are ``q`` apart. So its
first place is the start of the run, and its last one reaches to the end. A period belongs to one
power of two, and what is proposed again is dropped.

Stretches that occur once are forgotten before the next power, as nothing longer that holds
them occurs twice. Of plain prose, little is left after three steps.

Every document is parsed by itself, so nothing is shuffled and a lost task is one scan of its split. Memory
grows with the longest document, some 100 bytes a word, beside a bounded group of short ones.

Defined cases: a null text counts as empty and has no runs; repeated rows and ids get equal
rows; a null ``doc_id`` is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.common import release, utf8

MIN_LENGTH = 24
MIN_REPEATS = 3
GROUP_BYTES = 1 << 20  # texts that are parsed together

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
FOUND_DDL = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _sorted(code: np.ndarray, pos: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and places, ordered by code, then by place."""
    if len(code) and int(code.max()) < (1 << 62) // size:
        both = np.sort(code * size + pos)  # one sort of numbers is far faster than one of their order
        return both // size, both % size
    order = np.argsort(code, kind="stable")
    return code[order], pos[order]


def runs(words: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> np.ndarray:
    """``document, start, length, period`` of all runs, sorted.

    ``words`` are the word numbers of documents one after another, ``first`` the places
    where they begin, and the end of the last one.
    """
    size = len(words)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    code, pos = doc * (int(words.max(initial=0)) + 1) + words, np.arange(size)
    longest = int(np.diff(first).max(initial=0)) // min_repeats
    found, m = [], 1
    while len(pos) and m // 2 < longest:
        code, pos = _sorted(code, pos, size)
        same = code[1:] == code[:-1]
        gap = pos[1:] - pos[:-1]
        proposed = same & (gap <= m) & (gap > m // 2)
        at, period = pos[:-1][proposed], gap[proposed]
        order = np.argsort(at)
        at, period = at[order], period[order]
        cut = np.flatnonzero((at[1:] != at[:-1] + 1) | (period[1:] != period[:-1]))
        starts, ends = np.append(0, cut + 1)[: len(at)], np.append(cut, len(at) - 1)[: len(at)]
        length = at[ends] - at[starts] + m + period[starts]
        long = length >= np.maximum(min_length, min_repeats * period[starts])
        start = at[starts][long]
        found.append(np.stack([doc[start], start - first[doc[start]], length[long], period[starts][long]], axis=1))
        # names of stretches that occur again, and from them those of twice the length
        again = np.append(same, False) | np.append(False, same)
        number = np.cumsum(np.append(True, ~same))
        names = np.full(size, -1, np.int64)
        names[pos[again]] = number[again]
        pos = np.sort(pos[again])
        pos = pos[pos + m < size]
        pos = pos[(names[pos + m] >= 0) & (doc[pos + m] == doc[pos])]
        code = names[pos] * (len(number) + 1) + names[pos + m]
        m *= 2
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 4), np.int64)


def _group(texts: list[bytes], min_length: int, min_repeats: int):
    """``n_words, runs, collapsed`` of each text."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    split = [t.split() for t in texts]
    first = np.cumsum([0, *map(len, split)])
    words = np.fromiter((n for part in split for n in map(numbers.__getitem__, part)), np.int64, first[-1])
    found = runs(words, first, min_length, min_repeats)
    bounds = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
    for part, lo, hi in zip(split, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = found[lo:hi, 1:]
        kept = part
        if len(own):
            change = np.zeros(len(part) + 1, np.int64)
            np.add.at(change, own[:, 0] + own[:, 2], 1)
            np.add.at(change, own[:, 0] + own[:, 1], -1)
            kept = [w for w, inside in zip(part, np.cumsum(change)[:-1].tolist(), strict=True) if not inside]
        yield len(part), own, b" ".join(kept)


def _grouped(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _parse(min_length: int, min_repeats: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            texts, ids = utf8(batch.column(1)), batch.column(0).cast(pa.int64())
            for lo, hi in _grouped(texts, GROUP_BYTES):
                n, own, kept = zip(*_group(texts[lo:hi], min_length, min_repeats), strict=True)
                every = np.concatenate(own)
                fields = [pa.array(every[:, i]) for i in range(3)]
                offsets = pa.array(np.cumsum([0, *map(len, own)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=list(RUN)))
                columns = [ids.slice(lo, hi - lo), pa.array(n, pa.int64()), lists, pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema=FOUND)

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    ``runs`` holds ``start, length, period`` in words, by start and period, of all runs with at
    least ``min_length`` words and ``min_repeats`` (3 or more) periods. ``collapsed`` is the text, its words joined
    by one space, with the first period of each run only: a word goes if any run holds it after its first period.
    """
    if min_repeats < 3:
        raise ValueError("between a period and the rest of its run must be a power of two: 3 repeats at least")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_parse(min_length, min_repeats), FOUND_DDL)
