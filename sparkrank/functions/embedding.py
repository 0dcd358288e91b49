"""Text to vector functions: the built-in one and user-supplied ones."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkrank.functions import splitting, vectors
from sparkrank.functions.columns import as_column

Encode = Callable[[list[str]], np.ndarray]
CALL = 4096  # texts an encoder is given at once, whatever a batch holds
CALL_BYTES = 4 << 20  # of these texts; one text over it goes alone


def _calls(texts: pa.Array) -> Iterator[tuple[int, int]]:
    return splitting.slices(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), CALL, CALL_BYTES)


def _given(arrow: bool) -> Callable[[pa.Array], pa.Array | list[str]]:
    return (lambda texts: texts) if arrow else (lambda texts: texts.to_pylist())


@dataclass(frozen=True)
class LengthBatches:
    """How texts are given to an encoder that pads those of one call to the longest.

    Texts of like lengths go together, at most ``rows`` in a call and at most ``padded`` units
    when all are as long as the longest; one text over this budget goes alone. ``length``
    counts the units, such as the tokens of a model.
    """

    rows: int = 500
    padded: int = 1 << 18
    length: Callable[[str], int] = len

    def cut(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Places of the texts of each call."""
        sizes = np.array([self.length(t) for t in texts], np.int64)
        order = np.argsort(sizes, kind="stable")
        first = 0
        for at, place in enumerate(order):
            n = at - first + 1  # sizes rise, so this one is the longest so far
            if n > 1 and (n > self.rows or n * sizes[place] > self.padded):
                yield order[first:at]
                first = at
        if len(order):
            yield order[first:]

    def encode(self, model: Encode, texts: list[str]) -> np.ndarray:
        """What ``model`` gives for the texts, in their order."""
        parts = [(own, np.asarray(model([texts[i] for i in own]), np.float32)) for own in self.cut(texts)]
        if not parts:
            return np.asarray(model(texts), np.float32)
        out = np.empty((len(texts), *parts[0][1].shape[1:]), np.float32)
        for own, rows in parts:
            out[own] = rows
        return out


class Embedder:
    """A text to vector function that runs inside tasks on Arrow batches.

    ``load`` is called once per task and returns the encoder, a function from a
    list of texts to one matrix row per text. Spark spreads the rows over tasks;
    the encoder sees whole batches, or those that ``batches`` makes of them by length.
    """

    def __init__(
        self, load: Callable[[], Encode], dim: int, name: str | None = None, batches: LengthBatches | None = None
    ):
        if batches:
            self.load = lambda: partial(batches.encode, load())
        else:
            self.load = load
        self.dim = dim
        #: names model and version in the key of a stored collection, which needs it
        self.name = name

    #: whether the encoder takes Arrow arrays as well, so that texts need not become Python objects
    takes_arrow = False

    def __repr__(self) -> str:
        return f"{type(self).__name__}({self.name!r}, {self.dim})"

    def vector(self, text: Column | str) -> Column:
        """``array<float>`` per text."""
        load, given = self.load, _given(self.takes_arrow)

        @F.arrow_udf("array<float>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = load()
            for batch in batches:
                texts = pc.fill_null(batch, "")  # stay Arrow but for those of a call
                made = [pa.array([], pa.list_(pa.float32()))]
                for start, end in _calls(texts):
                    rows = np.asarray(model(given(texts[start:end])), dtype=np.float32)
                    at = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
                    made.append(pa.ListArray.from_arrays(at, pa.array(rows.ravel())))
                yield pa.concat_arrays(made)

        return encode(as_column(text))

    def similarity_to_previous(self, sentences: Column | str) -> Column:
        """Cosine similarity of every sentence to the one before, as an array.

        The sentences of a batch go through the encoder some thousand at a time and only the
        similarities come back, so no vector crosses into the JVM.
        """
        similarities = self._similarities()

        @F.arrow_udf("array<double>")
        def compare(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for _, starts, sims, _ in similarities(batches):
                yield pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(sims, mask=np.isnan(sims)))

        return compare(as_column(sentences))

    def segments(self, sentences: Column | str, threshold: float) -> Column:
        """:func:`splitting.join_segments` by :meth:`similarity_to_previous`; null where the sentences are null.

        Sentences are joined in the batch they were compared in: an expression that reads both them and the
        similarities would have them split a second time.
        """
        similarities = self._similarities()

        @F.arrow_udf("array<string>")
        def join(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for flat, starts, sims, null in similarities(batches):
                opens = splitting.is_below(sims, threshold)
                opens[starts[:-1][starts[:-1] < starts[1:]]] = True
                # nulls are joined by nothing
                before = np.append(0, np.cumsum(flat.is_valid().to_numpy(zero_copy_only=False)))
                cut = pa.array(before[np.append(np.flatnonzero(opens), len(flat))], pa.int32())
                joined = pc.binary_join(pa.ListArray.from_arrays(cut, flat.drop_null()), " ")
                ends = np.concatenate([[0], np.cumsum(opens)])[starts]
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), joined.cast(pa.string()), mask=pa.array(null))

        return join(as_column(sentences))

    def _similarities(self) -> Callable[[Iterator[pa.Array]], Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]]:
        """Of each batch its sentences, where the rows start among them, the similarities (NaN for none), and which rows are null."""
        load, given = self.load, _given(self.takes_arrow)

        def similarities(batches):
            model = load()
            for batch in batches:
                ends = np.cumsum(pc.list_value_length(batch).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                starts = np.concatenate([[0], ends]).astype(np.int64)
                flat = batch.flatten()
                texts = pc.fill_null(flat, "")  # stay Arrow but for those of a call
                sims = np.full(len(flat), np.nan)
                for at, end in _calls(texts[1:]):
                    # with the text before, so that parts of a batch meet
                    rows = np.asarray(model(given(texts[at : end + 1])), dtype=np.float32).astype(np.float64)
                    lengths = np.sqrt(np.einsum("ij,ij->i", rows, rows))
                    scale = lengths[1:] * lengths[:-1]
                    product = np.einsum("ij,ij->i", rows[1:], rows[:-1])
                    np.divide(product, scale, out=sims[at + 1 : end + 1], where=scale > 0)
                sims[starts[:-1][starts[:-1] < ends]] = np.nan  # the first of a document has none before it
                yield flat, starts, sims, batch.is_null().to_numpy(zero_copy_only=False)

        return similarities


class HashedBow(Embedder):
    """Hashed bag of words: word counts in ``dim`` buckets, length one.

    Needs no model. ``native=True`` states it with built-in functions only; the
    Arrow form gives the same floats and is several times faster, because array
    lambdas are interpreted per element. Words stay Arrow: only the distinct ones of a call are hashed.
    """

    takes_arrow = True

    def __init__(self, dim: int = 64, native: bool = False):
        self.native = native

        def load() -> Encode:
            digits = vectors.hash_digits(dim)

            class Known(dict):
                """The buckets of words met so far."""

                def __missing__(self, word: bytes) -> int:
                    if len(self) > 1 << 18:  # bounds the memory of a task
                        self.clear()
                    found = self[word] = int(hashlib.md5(word).hexdigest()[:digits], 16) % dim
                    return found

            known = Known()

            def encode(texts: pa.Array | list[str]) -> np.ndarray:
                if not isinstance(texts, pa.Array):
                    texts = pa.array([t.encode("utf-8", "replace") for t in texts], pa.binary()).cast(pa.string())
                # split at ASCII white space, as the built-in form does; an empty word stands before and behind it
                split = pc.ascii_split_whitespace(texts)
                words = split.flatten().cast(pa.binary()).dictionary_encode()
                row = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
                # no word holds a space: joined and split again, as bytes objects are made faster so than one by one
                distinct = pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary)
                distinct = pc.binary_join(distinct, b" ")[0].as_py().split(b" ") if len(words) else []
                buckets = np.fromiter((known[w] if w else -1 for w in distinct), np.int64, len(distinct))
                of_words = buckets[words.indices.to_numpy(zero_copy_only=False)]
                cells = (row * dim + of_words)[of_words >= 0]
                counts = np.bincount(cells, minlength=len(texts) * dim)
                counts = counts.reshape(len(texts), dim)
                length = np.sqrt((counts * counts).sum(axis=1).astype(np.float64))
                scaled = counts / np.where(length > 0, length, 1.0)[:, None]
                return scaled.astype(np.float32)

            return encode

        super().__init__(load, dim, "hashed words")

    def vector(self, text: Column | str) -> Column:
        if self.native:
            return vectors.hashed_bow(text, self.dim)
        return super().vector(text)

    def similarity_to_previous(self, sentences: Column | str) -> Column:
        if self.native:
            dim = self.dim
            vecs = F.transform(as_column(sentences), lambda s: vectors.hashed_bow(s, dim))
            return splitting.similarity_to_previous(vecs)
        return super().similarity_to_previous(sentences)

    def segments(self, sentences: Column | str, threshold: float) -> Column:
        if self.native:
            return splitting.join_segments(as_column(sentences), self.similarity_to_previous(sentences), threshold)
        return super().segments(sentences, threshold)
