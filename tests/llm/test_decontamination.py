"""Search against plain comparison of words."""

import random
import re

import pytest

from sparkrank.llm import decontamination as D

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def plain(docs, items):
    windows = {}
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - 9)) if own and item is not None else ():
            windows.setdefault(tuple(own[i : i + 10]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        own = words(text)
        hit, found = set(), set()
        for w, ids in windows.items():
            for i in range(len(own) - len(w) + 1):
                if tuple(own[i : i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found |= ids
        out.append((doc_id, len(own), len(hit), sorted(found)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, sum(h.end - h.first for h in r.hits), list(r.items)) for r in df.collect()), key=str)


@pytest.mark.parametrize("group_bytes", [1 << 20, 2000])
def test_small_alphabet(spark, group_bytes):
    rng = random.Random(7)
    make = lambda n: " ".join(rng.choice(["a", "bb", "a-c", "É", "d3", "A"]) for _ in range(n))
    items = [(i, make(n)) for i, n in enumerate([1, 2, 9, 10, 11, 14, 14, 0])] + [(None, "bb"), (3, "a é"), (9, None)]
    docs = [(i, make(n)) for i, n in enumerate([0, 1, 5, 40, 200, 200])] + [(2, items[4][1]), (2, items[4][1]), (None, items[5][1]), (8, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as hits", "2 as items")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(D.search(df, bench, group_bytes=group_bytes)) == plain(docs, items)
    clean = D.decontaminated(df, bench, group_bytes=group_bytes)
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _, n, _ in plain(docs, items) if not n)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(1, "three four"), (2, "IJK ab CDE fgh ijk ab cde fgh ijk ab x"), (3, "漢字")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(D.search(odd_docs, bench)) == plain(docs, items)
    assert got(D.search(odd_docs, bench.filter("false"))) == plain(docs, [])
    assert D.search(no_docs, bench).count() == 0


def test_long_lines_are_normalised_alike(monkeypatch):
    text = b" A-b\t" * 50 + "é1".encode()
    short = D.normalised(text)
    monkeypatch.setattr(D, "LONG_TEXT", 10)
    assert D.normalised(text) == short and D.normalised(b" -- ") == b""


def test_buckets_by_last_block():
    """Strings that share first and last block, or one of both, are told apart by comparison."""
    rng = random.Random(3)
    strings = {bytes(rng.choice(b"ab ") for _ in range(rng.randint(8, 11))) for _ in range(300)}
    strings |= {b"aaaaXbbbb" + x for x in (b"", b"1", b"2")} | {b"aaaaYbbbb", b"ccccXbbbb"}
    line = bytes(rng.choice(b"ab ") for _ in range(30_000)) + b"aaaaXbbbb2 aaaaYbbbb ccccXbbbb aaaaXbbb"
    machine = D.WuManber(strings)
    assert all(len(last) == machine.block for last in machine.buckets)
    plain = {(i, p) for p in strings for i in range(len(line)) if line.startswith(p, i)}
    assert len(plain) > 100 and set(machine.search(line)) == plain


def test_window_of_many_items_is_dealt_over_groups(spark):
    many = 100_000
    bench = spark.range(many).selectExpr("id as item_id", "'one window in every item' as text")
    sizes = [sum(len(w) + len(i) + 100 for w, i in g) for g in D.window_groups(bench, group_bytes=2 << 20)]
    assert len(sizes) > 5 and max(sizes) < 1.1 * (2 << 20)
    assert [len(g) for g in D.window_groups(bench, items=False)] == [1]
    docs = spark.createDataFrame([(1, "so: One window in every ITEM!"), (2, "one window")], "doc_id long, text string")
    found = {r.doc_id: r for r in D.search(docs, bench, group_bytes=2 << 20).collect()}
    assert found[1].n_words == 6 and [(h.first, h.end) for h in found[1].hits] == [(1, 6)]
    assert found[1]["items"] == sorted(map(str, range(many))) and found[2]["items"] == []
    assert [r.doc_id for r in D.decontaminated(docs, bench, group_bytes=2 << 20).collect()] == [2]
