"""Rules against plain expressions, and discovery on a small corpus."""

import hashlib
import re

from sparkrank.llm import pii
from sparkrank.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(s[::-1])]
        return sum(doubled) % 10 == 0

    tests = [
        (EMAIL, lambda m: True),
        (IP, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        (CARD, lambda m: 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
        (PHONE, lambda m: 10 <= len(digits(m[0])) <= 15),
    ]
    return sorted((m.start(), k, m.end()) for k, (rule, test) in enumerate(tests) for m in rule.finditer(text) if test(m))


TEXTS = [
    "a@b.c@d.e f.g@@h.i x@y z@y.z. @a.b a@-.- ..@a.b.. é.a@b.cé",
    "1.2.3.4.5.6 999.1.1.1 1.2.3 0001.02.3.4 1.2.3.256 1.2.3.4567.1.1.1.1 ..1.1.1.1",
    "4111 1111-1111 1111 4111111111111112 41111111111111111111 4111  1111 1111 1111 - 378282246310005",
    "+1 (017) 555-7713 +1(((( +123456789 +1234567890- ++49 30 1234567 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "😀 +1 (017) 555-7713 a@b.co 10.0.0.1",
]


def test_rules():
    for text in TEXTS:
        assert pii.base_spans(text) == plain(text), text


def test_query_keeps_the_rules(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op4_pii"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        spans = plain(docs[r.doc_id])
        line = pii.shown(spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_unseen_identifiers_are_discovered(spark):
    seeds = [(i, f"some words call tel: +1 (555) 010-{i:04d} or so") for i in range(10)]
    hidden = [(100, "again call tel: 555 020-7788 now"), (101, "we have call tel: 555-030-9911."), (102, "order number 555-030-1111 here")]
    docs = spark.createDataFrame(seeds + hidden + hidden[:1], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    texts = dict(hidden)
    for doc_id, number in ((100, "555 020-7788"), (101, "555-030-9911")):
        start = texts[doc_id].index(number)
        assert spans[doc_id] == f"phone:{start}:{start + len(number)}"
    assert spans[102] == ""
    assert all(spans[i] == f"phone:21:{21 + 17}" for i in range(10))
    masked = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert masked[101] == "we have call tel: [PHONE]." and masked[3] == "some words call tel: [PHONE] or so"
    assert pii.masked(docs).count() == docs.count()


def test_odd_rows(odd_docs, no_docs):
    assert pii.personal_data(odd_docs).count() == odd_docs.count()
    masked = pii.masked(odd_docs)
    assert masked.columns == odd_docs.columns and masked.count() == odd_docs.count()
    assert pii.personal_data(no_docs).count() == 0 and pii.masked(no_docs).count() == 0


def test_one_word_before_is_a_pattern(spark):
    seeds = [(i, f"some words call tel: +1 (555) 010-{i:04d} or so") for i in range(10)]
    docs = spark.createDataFrame([*seeds, (100, "Tel: 555 020-7788")], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert spans[100] == "phone:5:17"
