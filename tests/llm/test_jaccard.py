"""The Jaccard join against all pairs of sets."""

import random

import numpy as np
import pytest

from sparkrank.llm import jaccard


def shingles(text, k=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    return frozenset(tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))) if words else frozenset()


def plain(docs, percent=85, k=4):
    sets = [shingles(t, k) for _, t in docs]
    distinct = [s for s in dict.fromkeys(sets) if s]
    root = {s: s for s in distinct}

    def top(s):
        while root[s] is not s:
            s = root[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(a & b) >= percent * len(a | b):
                root[top(a)] = top(b)
    least = {}
    for (doc_id, _), s in zip(docs, sets, strict=True):
        if s:
            known = [x for x in (least.get(top(s)), doc_id) if x is not None]
            least[top(s)] = min(known, default=None)
    return sorted(((d, len(s), least[top(s)] if s else d) for (d, _), s in zip(docs, sets, strict=True)), key=str)


def corpus(seed, bases=6, size=150):
    """Copies of a few texts with zero to many edits, chains of edits, and passages in many documents."""
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('aBcé')}{rng.randrange(300)}"
    base = [[word() for _ in range(rng.choice([5, 30, 80, 200]))] for _ in range(bases)]
    line = [word() for _ in range(12)]
    docs = []
    for i in range(size):
        words = list(rng.choice(base)) if rng.random() < 0.8 or not docs else docs[rng.randrange(len(docs))][1].split()
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
            at = rng.randrange(len(words) + 1)
            words[at : at + rng.randrange(2)] = [word()] * rng.randrange(2)
        if rng.random() < 0.3:
            words += line
        docs.append((i if rng.random() < 0.95 else i // 2, " ".join(words)))
    return docs + [(500, None), (501, ""), (502, "one two"), (503, "ONE\ttwo"), (None, docs[0][1]), (None, None), docs[1]]


@pytest.mark.parametrize(("seed", "options"), [(0, {}), (1, {"many": 2, "cell": 8}), (2, {"many": 5, "cell": 40, "percent": 70}), (3, {"words": 2, "percent": 60})])
def test_small_corpora(spark, monkeypatch, seed, options):
    monkeypatch.setattr(jaccard, "SHORT", 64 if seed % 2 else 4)
    docs = corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = [tuple(r) for r in jaccard.similar_documents(frame, **options).collect()]
    assert sorted(got, key=str) == plain(docs, options.get("percent", 85), options.get("words", 4))


def test_odd_rows(odd_docs, no_docs):
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in jaccard.similar_documents(odd_docs).collect()), key=str) == plain(docs)
    assert jaccard.similar_documents(no_docs).count() == 0


def test_sets_of_texts_together():
    texts = [t.encode() for t in ("a b c d e", "", " A  b\tC d\n", "a b", "a b c", "x " * 50)]
    sets = jaccard.shingle_sets(texts)
    assert [len(s) for s in sets] == [2, 0, 1, 1, 1, 1]
    assert sets[2][0] in sets[0] and all((np.diff(s.astype(object)) > 0).all() for s in sets)


def test_prefixes_and_blocks_lose_no_pair():
    """Linked sets share an element of their prefixes, and the block of the first one is not skipped."""
    rng = np.random.default_rng(0)
    for percent in (60, 85, 90):
        for _ in range(300):
            common = rng.integers(1, 60)
            a = np.sort(rng.choice(4000, common + rng.integers(0, 12), replace=False))
            b = np.union1d(rng.choice(a, common, replace=False), rng.integers(0, 4000, rng.integers(0, 12)))
            a, b = sorted((a, b), key=len)
            if 100 * len(np.intersect1d(a, b)) < percent * len(np.union1d(a, b)):
                continue
            first = np.intersect1d(a, b)[0]
            i, j = np.searchsorted(a, first), np.searchsorted(b, first)
            assert i < jaccard.prefix_size(len(a), percent) and j < jaccard.prefix_size(len(b), percent)
            met = dict((i, m.tolist()) for i, m in jaccard.blocks_met(np.array([len(a), len(b)]), np.array([i, j]), percent))
            assert 1 in met[0]


def test_overlap_from_differences():
    rng = np.random.default_rng(0)
    for _ in range(50):
        pivot, a, b = (np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(3))
        less, more = [[np.setdiff1d(*pair).tobytes() for pair in pairs] for pairs in (((pivot, a), (pivot, b)), ((a, pivot), (b, pivot)))]
        assert jaccard.overlap(len(pivot), less, more) == (len(np.intersect1d(a, b)), len(np.union1d(a, b)))
