"""Cutting one text into segments and pieces, row by row, without a shuffle."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkrank.functions.columns import as_column, let, slices
from sparkrank.functions.vectors import dot, norm

# Similarities are compared after rounding, so that the last bit of a sum does
# not decide where a segment ends.
SIMILARITY_DIGITS = 9

PACK_ROWS = 4_096  # texts, and bytes of them, that are Python objects at once; one text over it goes alone
PACK_BYTES = 1 << 20
WORD = re.compile(r"[^ \t\n\x0b\f\r]+")  # what white space of ASCII separates


def similarity_to_previous(vectors: Column) -> Column:
    """Cosine similarity of every vector to the one before it; null for the first."""

    def pairs(vecs: Column, norms: Column) -> Column:
        def one(i: Column) -> Column:
            product = dot(F.element_at(vecs, i), F.element_at(vecs, i - 1))
            return F.try_divide(product, F.element_at(norms, i) * F.element_at(norms, i - 1))

        first = F.array(F.lit(None).cast("double"))
        later = F.when(
            F.size(vecs) >= 2, F.transform(F.sequence(F.lit(2), F.size(vecs)), one)
        ).otherwise(F.array().cast("array<double>"))
        return F.when(F.size(vecs) > 0, F.concat(first, later)).otherwise(F.array().cast("array<double>"))

    return let(vectors, lambda vecs: let(F.transform(vecs, norm), lambda norms: pairs(vecs, norms)))


def join_segments(sentences: Column, similarity: Column, threshold: float) -> Column:
    """Sentences joined into segments.

    A sentence opens a segment when its similarity to the previous one is below
    the threshold. An undefined similarity (zero vector) opens none. No sentence
    gives no segment.
    """

    def opening(sims: Column) -> Column:
        # a null marks no opening; positions are 1-based
        marks = F.transform(
            sims,
            lambda sim, i: F.when(
                (i == 0) | (F.round(sim, SIMILARITY_DIGITS) < threshold), i + 1
            ),
        )
        return F.array_compact(marks)

    def cut(parts: Column, starts: Column) -> Column:
        ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(parts) + 1))
        return F.zip_with(starts, ends, lambda a, b: F.array_join(F.slice(parts, a, b - a), " "))

    joined = let(sentences, lambda parts: let(opening(similarity), lambda starts: cut(parts, starts)))
    return F.when(F.size(sentences) > 0, joined).otherwise(F.array().cast("array<string>"))


def is_below(similarity: np.ndarray, threshold: float) -> np.ndarray:
    """Whether similarities are below the threshold after rounding; half a digit goes away from zero, as in Spark."""
    unit = Decimal(1).scaleb(-SIMILARITY_DIGITS)
    below = similarity < threshold
    for i in np.flatnonzero(np.abs(similarity - threshold) < 2 * float(unit)):
        below[i] = float(Decimal(repr(float(similarity[i]))).quantize(unit, ROUND_HALF_UP)) < threshold
    return below


def pack_words(words: Iterable[str], size: int, overlap: int) -> list[str]:
    """Words in order as pieces of at most ``size`` characters; the steps are pieces, not words."""
    words = list(words)
    if not words:
        return []
    if max(map(len, words)) > size:
        words = [word[i : i + size] for word in words for i in range(0, len(word), size)]
    text, start = " ".join(words), 0
    pieces: list[str] = []
    while len(text) - start > size:
        end = text.rfind(" ", start, start + size + 1)  # no word is longer than a piece
        pieces.append(text[start:end])
        after = text.find(" ", end + 1)
        room = size - 1 - ((after if after >= 0 else len(text)) - end - 1)
        # the first word never stays, of the others those at the end that fit
        again = text.find(" ", max(start, end - 1 - min(overlap, room)), end)
        start = (again if again >= 0 else end) + 1
    return [*pieces, text[start:]]


def size_pieces(text: Column | str, size: int = 300, overlap: int = 30) -> Column:
    """Pieces of at most ``size`` characters made of whole words.

    A piece that is full is emitted, and the next one starts with its last
    words as long as they measure at most ``overlap`` characters and leave room
    for the next word. Words longer than ``size`` are cut. Text within the
    limit stays one piece.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    text = as_column(text)

    @F.arrow_udf("array<string>")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.string())
        for batch in batches:
            made = [pa.array([], kind)]
            sizes = pc.binary_length(batch).fill_null(0).to_numpy(zero_copy_only=False)
            for start, end in slices(sizes, PACK_ROWS, PACK_BYTES):
                some = batch[start:end].to_pylist()
                made.append(pa.array([None if t is None else pack_words(WORD.findall(t), size, overlap) for t in some], kind))
            yield pa.concat_arrays(made)

    # only texts over the limit go to Python
    cut = packed(F.when(F.length(text) > size, text))
    return F.when(F.length(text) <= size, F.filter(F.array(text), lambda t: F.trim(t) != "")).otherwise(cut)
