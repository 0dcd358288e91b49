"""Duplicate passages against all windows of all documents."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from sparkrank.llm import substrings
from sparkrank.llm.queries import QUERIES


def plain(docs, window=50):
    least, rows = {}, []
    for doc_id, text in docs:
        words = (text or "").encode().split()
        rows.append((doc_id, words))
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if doc_id is not None:
                least[key] = min(least.get(key, doc_id), doc_id)
    out = []
    for doc_id, words in rows:
        gone = set()
        for i in range(len(words) - window + 1):
            if doc_id is not None and least[tuple(words[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op7_substrings"](spark, sf_dir).collect()), key=str) == plain(docs)


def test_odd_rows(odd_docs, no_docs):
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in substrings.removed(odd_docs).collect()), key=str) == plain(docs)
    assert substrings.removed(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_cut_and_joined_passages(spark, seed):
    """Documents made of parts of each other, with repeats, few different words, and edits."""
    rng = random.Random(seed)
    source = [f"w{rng.randrange(2000)}" for _ in range(600)] + ["a", "b"] * 60
    docs = []
    for doc_id in range(60):
        words = []
        for _ in range(rng.randrange(1, 6)):
            at, n = rng.randrange(len(source)), rng.choice([5, 30, 49, 50, 51, 120])
            words += source[at : at + n]
        if rng.random() < 0.3:
            words.insert(rng.randrange(len(words) + 1), "edit")
        docs.append((doc_id // 2 if rng.random() < 0.1 else doc_id, " ".join(words)))
    docs += [(None, docs[0][1]), docs[5]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((tuple(r) for r in substrings.removed(df, bits=10).collect()), key=str) == plain(docs)


def test_a_sequence_and_its_complement(spark):
    """Two words in Thue-Morse order cancel in any sum modulo a power of two; no window is common here."""
    order = [bin(i).count("1") % 2 for i in range(128)]
    texts = [" ".join(w for o in order for w in [f"{('alpha', 'beta')[o ^ flip]}", *(f"f{i}" for i in range(31))]) for flip in (0, 1)]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((tuple(r) for r in substrings.removed(df).collect()), key=str) == plain(docs)
    a, b = (substrings.Words(t.encode()) for t in texts)
    ends = [w.runs(np.zeros(1, int), np.array([w.n]), i)[0] for i in (0, 1) for w in (a, b)]
    assert ends[0] != ends[1] and ends[2] != ends[3]


def test_products_modulo_the_prime():
    rng = random.Random(1)
    a, b = ([*(rng.randrange(substrings.PRIME) for _ in range(500)), 0, substrings.PRIME - 1] for _ in range(2))
    got = substrings.times(np.array(a, np.uint64), np.array(b, np.uint64)).tolist()
    assert got == [x * y % substrings.PRIME for x, y in zip(a, b, strict=True)]
    assert substrings.powers(7, 40).tolist() == [pow(7, i, substrings.PRIME) for i in range(40)]


def test_windows_of_two_texts_lie_in_runs_or_are_asked():
    """Each common window of two texts is in a run of common blocks or among the places asked for; runs hold common words only."""
    rng = random.Random(3)
    for _ in range(30):
        passage = [f"p{rng.randrange(500)}" for _ in range(rng.choice([50, 60, 90, 200]))]
        texts = [[f"{i}{rng.randrange(500)}" for _ in range(rng.randrange(80))] + passage + [f"{i}{rng.randrange(500)}" for _ in range(rng.randrange(80))] for i in "ab"]
        batch = pa.RecordBatch.from_pydict({"doc_id": [0, 1], "key": [0, 1], "text": [" ".join(t) for t in texts]})
        (indexed,) = substrings._index(50, 9)([batch])
        one, two = indexed.to_pylist()
        known = {(b["b1"], b["b2"]) for b in one["blocks"]}
        parts = [b for b in two["blocks"] if (b["b1"], b["b2"]) in known]
        windows = {tuple(texts[0][i : i + 50]) for i in range(len(texts[0]) - 49)}
        common = {i for i in range(len(texts[1]) - 49) if tuple(texts[1][i : i + 50]) in windows}
        blocks = substrings.Blocks(pa.array(parts, substrings.BLOCK), 9)
        asked = {i for a, b in blocks.asked(50) for i in range(a, b)}
        first, last = blocks.runs(50, 9)
        held = {i for a, b in zip(blocks.at[first], blocks.ends[last], strict=True) for i in range(a, b - 49)}
        assert common <= asked and held <= common


def test_greedy_factors():
    assert substrings.factors([(60, 130), (0, 60), (11, 70), (200, 250)], 50) == [(0, 70), (60, 130), (200, 250)]
