"""Collocations against counts of all phrases, scored and dropped one by one."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparkrank.llm import collocations


def plain(docs, least=30, longest=4, top=2000, share=80):
    counts = defaultdict(Counter)
    for lang, text in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for k in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {q for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if (q := p[i:j]) != p and 100 * a >= share * f[q]}
        rows = []
        for p, a in candidates.items():
            if p not in dropped:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        n = sum(a for p, a in f.items() if len(p) == 1)
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    fixed = [" ".join(f"{rng.choice('aAbé')}{rng.randrange(40)}" for _ in range(rng.randrange(2, 8))) for _ in range(12)]
    docs = []
    for _ in range(200):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else f"w{rng.randrange(12)}{rng.choice(['', '', '.', ' !', '\t', chr(11), chr(160)])}" for _ in range(rng.randrange(60))]
        docs.append((rng.choice(["en", "en", "fr", None]), " ".join(parts)))
    return docs + [("en", None), ("xx", ""), ("en", docs[0][1]), ("en", docs[0][1])]


@pytest.mark.parametrize(("seed", "options"), [(0, {"least": 3, "top": 20, "begin": 10}), (1, {"least": 2, "top": 50, "longest": 3, "share": 60}), (2, {"least": 4, "longest": 5, "top": 15, "begin": 4})])
def test_small_corpora(spark, seed, options):
    docs = corpus(seed)
    frame = spark.createDataFrame(docs, "lang string, text string")
    got = collocations.collocations(frame, bits=10 if seed else 20, **options)
    expected = plain(docs, **{k: v for k, v in options.items() if k != "begin"})
    assert sorted(tuple(r) for r in got.collect()) == expected and len(expected) > 30


def test_odd_rows(odd_docs, no_docs):
    got = collocations.collocations(odd_docs)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain([tuple(r) for r in odd_docs.select("lang", "text").collect()])
    assert collocations.collocations(no_docs).count() == 0


def test_packed_phrases_of_many_words():
    rng = np.random.default_rng(1)
    for numbers, size in [(rng.integers(1, 4, 4000) + more, size) for more in (0, 1 << 20, 1 << 30) for size in range(1, 8)]:
        at = np.arange(len(numbers) - size + 1)
        columns, counts = collocations.packed(numbers, at, size)
        expected = Counter(tuple(numbers[i : i + size].tolist()) for i in at)
        assert dict(zip(zip(*(c.tolist() for c in columns)), counts.tolist(), strict=True)) == expected


def test_counts_beyond_64_bits(spark):
    rows = spark.createDataFrame([(2**62, 2**62, 2**62 + 5), (2**62, 2**62 + 1, 2**62)], "a long, l long, r long")
    got = rows.select("a", "l", "r", collocations._ratio(rows.a, rows.l, rows.r, 1_000_000).alias("s")).collect()
    assert [r.s for r in got] == [2_000_000 * r.a // (r.l + r.r) for r in got]


def test_long_texts_are_cut_between_pieces():
    text = b"a b. c d, e f " * 50
    parts = list(collocations._cut(text, 20))
    assert len(parts) > 10 and re.split(rb"[.,]", text) == [p for part in parts for p in re.split(rb"[.,]", part)]
    assert list(collocations._cut(b"a " * 100, 20)) == [b"a " * 100]
