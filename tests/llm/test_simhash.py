"""Near-duplicates against fingerprints of whole shingles and a union of all close pairs."""

import numpy as np
import pytest
import xxhash

from sparkrank.llm import simhash
from sparkrank.llm.common import space_blocks
from sparkrank.llm.queries import QUERIES


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, distance=3):
    """Smallest id of each component, by comparing all pairs."""
    values = sorted({fp for _, fp in prints})
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    array = np.array(values, np.uint64)
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(array[:i] ^ array[i]) <= distance):
            root[top(v)] = top(values[j])
    least = {}
    for doc_id, fp in prints:
        known = [x for x in (least.get(top(fp)), doc_id) if x is not None]
        least[top(fp)] = min(known, default=None)
    return [(doc_id, f"{fp:016x}", least[top(fp)]) for doc_id, fp in prints]


def same(got, docs):
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(classes([(d, plain(t)) for d, t in docs]), key=key)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    same(QUERIES["op2_simhash"](spark, sf_dir).collect(), docs)


def test_odd_rows(odd_docs):
    same(simhash.near_duplicates(odd_docs).collect(), [tuple(r) for r in odd_docs.select("doc_id", "text").collect()])


def test_no_rows(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.deduplicated(no_docs).columns == no_docs.columns


def test_blocks_of_a_long_text():
    text = b"aa bb\tcc  dd e" * 9000
    assert b"".join(space_blocks(text, 1000)) == text
    assert simhash.fingerprint(text) == plain(text.decode())


@pytest.mark.parametrize(("distance", "segments", "cell"), [(3, 2, 4096), (3, 2, 8), (3, 4, 8), (5, 2, 4096)])
def test_links_of_dense_and_far_values(spark, distance, segments, cell):
    """A dense ball of values around one, chains, and values far from all others."""
    rng = np.random.default_rng(1)
    values = {int(x) for x in rng.integers(-(2**63), 2**63, 40)}
    centre = int(rng.integers(-(2**63), 2**63))
    values |= {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (120, 2))}
    chain = int(rng.integers(0, 2**62))
    for bit in range(0, 60, 3):
        chain ^= 7 << bit
        values.add(chain)
    prints = [(i, v % 2**64) for i, v in enumerate(sorted(values))]
    expected = {fp: least for (i, fp), (_, _, least) in zip(prints, classes(prints, distance), strict=True)}
    df = spark.createDataFrame([(np.uint64(v).astype(np.int64).item(),) for _, v in prints], "fp long")
    edges = simhash.links(df, distance, segments, cell)
    assert edges.count() <= 64 * len(prints)
    from sparkrank.llm.components import components

    roots = {r.node % 2**64: r.root for r in components(edges).collect()}
    groups, wanted = {}, {}
    for i, v in prints:
        groups.setdefault(roots.get(v, ("alone", i)), set()).add(v)
        wanted.setdefault(expected[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_one_of_each_group_stays(odd_docs):
    kept = simhash.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    found = classes([(r.doc_id, plain(r.text)) for r in odd_docs.select("doc_id", "text").collect()])
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted({d for d, _, least in found if d == least})
    assert kept.filter("doc_id is null").count() == 1


def test_repeated_and_null_ids_lose_no_clean_document(spark):
    a, b, c = "the first text is about one thing only", "an unrelated page of words on another matter", "third something else entirely written here today"
    rows = [(1, a, "x"), (1, b, "x"), (2, b, "x"), (3, c, "x"), (3, c, None), (None, c, "x"), (None, c, "x"), (None, a + " again and so on for a while", None)]
    kept = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, a), (1, b), (3, c), (0, c), (0, rows[-1][1])])
