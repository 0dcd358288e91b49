"""Periodic runs against a search over all periods and places."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from sparkrank.llm import periodic
from sparkrank.llm.queries import QUERIES


def plain(words, least=24, repeats=3):
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, repeats * q):
                found.setdefault((i, j - i + q), q)  # a stretch has its smallest period first
            i = max(j, i + 1)
    return sorted((i, length, q) for (i, length), q in found.items())


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize(("least", "repeats"), [(24, 3), (6, 3), (1, 4)])
def test_runs_of_documents_together(least, repeats):
    for seed in range(150):
        rng = random.Random(seed)
        docs = []
        for _ in range(rng.randrange(1, 5)):
            words = []
            for _ in range(rng.randrange(0, 6)):
                part = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 14))]
                words += (part * rng.randrange(1, 9))[: rng.randrange(1, 100)]
            docs.append(words)
        got = periodic.runs(np.array(sum(docs, []), np.int64), np.cumsum([0, *map(len, docs)]), least, repeats)
        assert [tuple(r) for r in got.tolist()] == [(d, *r) for d, words in enumerate(docs) for r in plain(words, least, repeats)]


def test_huge_numbers_of_words_keep_their_order():
    words = np.arange(100)[np.arange(3000) % 100] + (1 << 61)
    assert periodic.runs(words, np.array([0, 3000])).tolist() == [[0, 0, 3000, 100]]


def test_odd_rows(odd_docs, no_docs):
    got = {r.doc_id: r for r in periodic.periodic_runs(odd_docs).collect() if r.doc_id is not None}
    for doc_id, text in [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]:
        if doc_id is None or doc_id in (6, 7):
            continue
        words = [w.decode() for w in (text or "").encode().split()]
        runs = plain(words)
        assert (got[doc_id].n_words, [tuple(r) for r in got[doc_id].runs], got[doc_id].collapsed) == (len(words), runs, collapsed(words, runs))
    assert [tuple(r) for r in got[6].runs] == [tuple(r) for r in got[7].runs] == [(0, 16_000, 4)]
    assert (got[6].collapsed, got[7].collapsed) == ("ab cde fgh, IJK", "ab cde fgh, IJK x")
    assert periodic.periodic_runs(odd_docs).count() == odd_docs.count()
    assert periodic.periodic_runs(no_docs).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(odd_docs, min_repeats=2)


def test_query_on_planted_and_odd_rows(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(5)}" for _ in range(rng.randrange(0, 200)))) for i in range(120)]
    rows += [(200, None), (None, "a " * 40), (201, ""), (5, "b c " * 30), (5, "b c " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc_id, text in rows:
        words = (text or "").split()
        n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = plain(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs))]
        expected.append((doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digests))
    got = [tuple(r) for r in QUERIES["op13_periodic"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert sum(r[1] > 0 for r in got) >= 5
