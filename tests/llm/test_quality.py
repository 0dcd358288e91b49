"""Co-training: held-out accuracy and odd rows."""

import numpy as np

from sparkrank.llm import quality
from sparkrank.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op10_quality"](spark, path).collect()}
    assert len(rows) == spark.read.parquet(f"{path}/documents.parquet").count()
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{path}/labels.parquet").collect() if r.doc_id in rows]
    held = [(rows[d].predicted, q) for d, q in labels if rows[d].held_out]
    assert len(held) > 30 and np.mean([p == q for p, q in held]) >= 0.95


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (6, None), (None, 1), (9, 0), (8, 1)], "doc_id long, quality int").selectExpr("*", "1 as row")
    scored = quality.scored(odd_docs, labels)
    assert scored.count() == odd_docs.count() and scored.filter("score is null or isnan(score)").count() == 0
    assert quality.scored(odd_docs, labels.filter("false")).select("score").distinct().count() == 1
    assert quality.scored(no_docs, labels).count() == 0


def test_blocks_of_a_text_add_up(monkeypatch):
    text = b"Some words! 12\nand more Words\n" * 50
    whole = quality.text_features(text)
    monkeypatch.setattr(quality, "space_blocks", lambda data: [data[:600], data[600:]] if data[600:601].isspace() else [data])
    assert np.allclose(quality.text_features(text), whole)


def test_repeated_ids_are_one_labelled_row(spark, monkeypatch):
    """One document in many different rows does not dominate the fit, nor is it collected whole."""
    docs = spark.createDataFrame([(1, f"text {i}", "s", "en") for i in range(50)] + [(i, f"other {i}", "s", "en") for i in range(2, 30)], "doc_id long, text string, source string, lang string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality").distinct()
    sizes, fit = [], quality.fit_logistic
    monkeypatch.setattr(quality, "fit_logistic", lambda x, y, **k: (sizes.append(len(y)), fit(x, y, **k))[1])
    quality.train(quality.views(docs), labels, rounds=0)
    assert sizes and max(sizes) <= 29


def test_copies_are_handed_over_once(spark, monkeypatch):
    """Copies of the surest text under many ids do not fill the exchange."""
    good, bad = "Plain words of a calm page, with commas. ", "$$ 99 !! XX 77 ## "
    known = [(i, (good if i % 2 else bad) * (3 + i % 5), "ab"[i % 2], "en") for i in range(40)]
    free = [(i, good * 9, "b", "en") for i in range(100, 160)] + [(i, good * (4 + i % 7), "b", "en") for i in range(200, 207)]
    docs = spark.createDataFrame(known + free, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    monkeypatch.setattr(quality, "SURE", 0.5)
    handed, arrays = [], quality._arrays

    def seen(rows, label=None):
        if label is not None:
            handed.append([tuple(r.text_view) for r in rows])
        return arrays(rows, label)

    monkeypatch.setattr(quality, "_arrays", seen)
    quality.train(quality.views(docs), labels, rounds=1, handed=5)
    assert handed and all(len(set(h)) == len(h) for h in handed) and max(map(len, handed)) == 5
