"""The automaton against plain distances, and held-out accuracy."""

import random

import numpy as np

from sparkrank.llm import toxicity
from sparkrank.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton():
    rng = random.Random(3)
    terms = {"".join(rng.choice("abc") for _ in range(n)): (False, 1.0) for n in (3, 4, 5, 6, 7, 8, 9, 10)}
    lexicon = toxicity.Lexicon(terms)
    for _ in range(3000):
        base = rng.choice(list(terms))
        word = list(base)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "d"])
        word = "".join(word)
        near = [(distance(word, t), t) for t in terms if distance(word, t) <= toxicity.errors_allowed(t)]
        got = lexicon.match(word)
        assert got == ((min(near)[1], min(near)[0]) if near else None), word


def test_stems_and_context():
    terms = {"lowei": (True, 3.0), "idiot": (False, 4.0)}
    scorer = toxicity.Scorer(terms)
    assert scorer.hit("Loweischaft,") == ("lowei", 0) and scorer.hit("Lowe") is None
    assert scorer.hit("id1ot!") == ("idiot", 1) and scorer.hit("idea") is None
    abuse, quoted = scorer.features("you are an idiot and more"), scorer.features('he wrote: "such an idiot" once')
    names = toxicity.FEATURES
    assert abuse[names.index("exact")] > 0 == abuse[names.index("quoted")] and abuse[names.index("addressed")] > 0
    assert quoted[names.index("exact")] == 0 < quoted[names.index("quoted")]


def test_misspelled_learned_terms(spark):
    toxic = ["you are a clown and worthless", "such a clown, worthless", "worthless clown ahead", "clown worthless pig pigs"] * 2
    sample = spark.createDataFrame([(t, 1) for t in toxic] + [("a pleasant town with a closed road", 0)] * 40, "text string, toxic int")
    terms = toxicity.learn_terms(sample)
    lexicon = toxicity.Lexicon(terms)
    assert terms["clow"][0] and not terms["clown"][0]
    for word, term in (("cl0wn", "clown"), ("clwn", "clown"), ("vvorthless", "worthless"), ("w0rthles", "worthless")):
        assert lexicon.match(word) == (term, distance(word, term))
    # stems only add: a word itself is exact, what else a stem begins is found at no distance
    assert lexicon.match("clown") == ("clown", 0) and lexicon.match("clownish") == ("clow", 0)
    scorer, names = toxicity.Scorer(terms), toxicity.FEATURES
    assert scorer.features("a clown")[names.index("exact")] > 0 and scorer.features("a cl0wn")[names.index("misspelled")] > 0
    assert lexicon.match("town") is None


def test_stem_that_is_also_a_word():
    lexicon = toxicity.Lexicon({"clown": (True, 3.0, "word"), "moron": (True, 3.0)})
    assert lexicon.match("clownish") == ("clown", 0) and lexicon.match("cl0wn") == ("clown", 1)
    assert lexicon.match("moronic") == ("moron", 0) and lexicon.match("m0ron") is None


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, path).collect()}
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert len(rows) == docs.count()
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{path}/labels.parquet").collect() if r.doc_id in rows]
    held = [(rows[d].predicted, t) for d, t in labels if rows[d].held_out]
    assert len(held) > 30 and np.mean([p == t for p, t in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (6, None), (None, 1), (9, 0), (8, 1)], "doc_id long, toxic int").selectExpr("*", "1 as text")
    scored = toxicity.scored(odd_docs, labels)
    assert scored.count() == odd_docs.count() and scored.filter("score is null or isnan(score)").count() == 0
    assert scored.filter("doc_id is null and not held_out").count() == 1
    assert toxicity.scored(odd_docs, labels.filter("false")).filter("predicted = 0").count() == odd_docs.count()
    assert toxicity.scored(no_docs, labels).count() == 0
    assert toxicity.civil(odd_docs, labels.filter("toxic = 0")).columns == odd_docs.columns


def test_repeated_ids_are_one_row_of_the_sample(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(i, "other") for i in range(2, 30)] + [(2, None)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic").distinct()
    held = {r.doc_id for r in docs.filter(toxicity.held_out()).select("doc_id").collect()}
    assert 1 not in held
    sample = toxicity.labelled_sample(docs, labels).collect()
    assert len(sample) == 29 - len(held) and sum((r.text or "").startswith("text") for r in sample) == 1
