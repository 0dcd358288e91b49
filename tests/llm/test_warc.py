"""Archives: records, index, range reads."""

import gzip
import hashlib

from sparkrank.llm import warc
from sparkrank.llm.common import new_folder

PAGE = "<html>" + "same " * 300


def pages(spark):
    rows = [
        (1, "http://a.example.com/x?y=1", PAGE), (2, "https://b.example.com", PAGE), (3, "http://a.example.com/x?y=1", PAGE + "é"), (4, None, None), (5, "", ""),
        (6, "not a url\t\n", "short"), (7, "http://[bad", "short"), (None, "http://c.org/", PAGE), (8, "http://c.org:80/a b", "long " * 100_000), (8, "http://c.org:80/a b", "long " * 100_000),
        (9, "http://c.org/", "long " * 100_000), (-3, "http://c.org/", "x" * 999), (-4, "http://c.org/", "x" * 999),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' as digest", "0 as bytes", "1 as key", "2 as last")


def test_odd_rows(spark):
    df = pages(spark)
    rows = [(r.page_id, r.html or "") for r in df.collect()]
    got = warc.archived(spark, df).collect()
    want = []
    for page_id, html in rows:
        twins = [p for p, h in rows if h == html and p is not None]
        last = max(twins) if len(html.encode()) >= 1000 else page_id
        kind = "response" if last == page_id else "revisit"
        want.append((page_id, len(html.encode()), hashlib.sha1(html.encode()).hexdigest(), kind, None if kind == "response" else last))
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert all(bytes(r.payload) == dict(rows)[r.page_id].encode() for r in got if r.record_type == "response")
    assert warc.archived(spark, df.filter("false")).count() == 0


def test_index_and_files(spark):
    folder = new_folder(spark, "test")
    system, root = warc.file_system(folder)
    system.create_dir(root, recursive=True)
    entries = warc.write_archives(pages(spark), folder)
    shards = warc.write_index(entries, folder, block_lines=2)
    assert shards == sorted(shards)
    known = {}
    for r in entries.collect():
        known.setdefault(r.key, []).append((r.file, r.offset, r.length))
    index = warc.Index(folder, shards)
    for key in [*known, *reversed(known), "", "zzz", "com,example,a)/"]:
        assert sorted(index.find(key)) == sorted(known.get(key, []))
    for file in {f for places in known.values() for f, _, _ in places}:
        with system.open_input_stream(f"{root}/{file}", compression=None) as stream:
            whole = gzip.decompress(stream.read())
        assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n")


def test_keys_sort_by_reversed_host():
    assert warc.url_key("http://M.Example.com:8080/p?q#f", 7).startswith("com,example,m:8080)/p?q ")
    assert warc.url_key("http://e.com/", -1) < warc.url_key("http://e.com/", 0) < warc.url_key("http://e.com/", 10)
