"""From raw documents to an embedded, tagged collection."""

from __future__ import annotations

import hashlib
import importlib
import inspect
import pkgutil
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrank.functions import text as T
from sparkrank.functions.embedding import Embedder
from sparkrank.operators import chunking, cleaning, rerank
from sparkrank.operators.entities import Dictionary
from sparkrank.sources import collection as store
from sparkrank.sources.readers import input_fingerprint, table_fingerprint


def rules() -> str:
    """Digest of the package's sources: after a change of a rule no chunks of the old one are read.

    All modules count but those of the subpackages that no collection is made with.
    """
    package = importlib.import_module("sparkrank")
    found = hashlib.md5()
    for part in sorted(pkgutil.iter_modules(package.__path__), key=lambda m: m.name):
        name = f"sparkrank.{part.name}"
        if part.name in ("llm", "catalog"):
            continue
        inside = pkgutil.iter_modules(importlib.import_module(name).__path__) if part.ispkg else ()
        for module in [name, *(f"{name}.{m}" for m in sorted(m.name for m in inside))]:
            found.update(inspect.getsource(importlib.import_module(module)).encode())
    return found.hexdigest()


def chunk_corpus(
    docs: DataFrame,
    embedder: Embedder,
    *,
    long_words: int = chunking.LONG_WORDS,
    threshold: float = chunking.SIMILARITY,
    size: int = chunking.PIECE_SIZE,
    overlap: int = chunking.PIECE_OVERLAP,
    count: Callable[[str], Column] = T.word_count,
    split: Callable[[str], Column] = T.sentences,
    split_segment: Callable[[Column], Column] | None = None,
    skip_as_coded: bool = False,
) -> DataFrame:
    """Clean documents (``_id, title, text, pos``) as one table of tagged chunks."""
    marked = chunking.mark_long(docs, limit=long_words, count=count)
    if skip_as_coded:
        marked = chunking.skip_after_removal(marked)
    chunks = chunking.chunk_documents(
        marked, embedder, threshold=threshold, size=size, overlap=overlap, split=split, split_segment=split_segment
    )
    return chunking.tagged(chunks).select("_id", "parent_id", "title", "text", "ticker")


def embed_collection(chunks: DataFrame, embedder: Embedder) -> DataFrame:
    return chunks.withColumn("embedding", embedder.vector("text"))


def build_collection(
    docs: DataFrame,
    dictionary: Dictionary | DataFrame,
    embedder: Embedder,
    *,
    clean: Mapping[str, bool] | None = None,
    **options,
) -> DataFrame:
    """Raw documents (``_id, title, text, pos``) as an embedded collection.

    ``clean`` holds options of :func:`cleaning.clean_corpus`, the others are those
    of :func:`chunk_corpus`.
    """
    cleaned = cleaning.clean_corpus(docs, dictionary, **(clean or {}))
    return embed_collection(chunk_corpus(cleaned, embedder, **options), embedder)


class StoredCollection:
    """A collection in the shared folder with the statistics made from it.

    ``table`` holds the chunks and their vectors, ``weights`` the word weights
    that scoring needs. Each is built on first use and read after that. The path
    is a key of the input files and the plan on them, the dictionary, the options,
    the name of the embedder and the source of the rules; give ``version`` where
    the plan calls functions of your own. ``embedder`` needs a name.
    """

    def __init__(
        self,
        docs: DataFrame,
        dictionary: Dictionary | DataFrame,
        embedder: Embedder,
        *,
        version: str = "",
        name: str = "sparkrank-collection",
        folder: str | None = None,
        **options,
    ):
        if embedder.name is None:
            raise ValueError("a stored collection needs an embedder with a name")
        self.spark = docs.sparkSession
        self.build = lambda: build_collection(docs, dictionary, embedder, **options)
        if isinstance(dictionary, Dictionary):
            entries = repr(list(dictionary.companies.items()))
        else:
            entries = table_fingerprint(dictionary).first()["md5"]
        made_with = repr((version, repr(embedder), sorted(options.items()), entries, rules()))
        settings = hashlib.md5(made_with.encode()).hexdigest()
        folder = folder or store.shared_folder(self.spark)
        self.path = f"{folder}/{name}/{input_fingerprint(docs)}-{settings}"

    @property
    def table(self) -> DataFrame:
        return store.get_or_create(
            self.spark,
            f"{self.path}/chunks",
            self.build,
            store.write_collection,
            store.read_collection,
        )

    @property
    def weights(self) -> DataFrame:
        return store.get_or_create(
            self.spark,
            f"{self.path}/weights",
            lambda: rerank.word_weights(self.table),
            store.write_table,
            store.read_table,
        )
