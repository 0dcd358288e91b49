import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrank.functions import vectors
from sparkrank.functions.embedding import Embedder, HashedBow, LengthBatches

TEXTS = ["a b b c", "", "   ", "revenue of the company was -12.5 percent", "b"]


def test_native_and_arrow_forms_agree(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    arrow, native = HashedBow(16), HashedBow(16, native=True)
    rows = df.select(arrow.vector("t").alias("a"), native.vector("t").alias("b"), F.col("t")).collect()
    for row in rows:
        assert row.a == row.b
        length = np.linalg.norm(row.a)
        assert length == pytest.approx(1.0 if row.t.strip() else 0.0, abs=1e-6)
    lists = spark.createDataFrame([(0, TEXTS), (1, []), (2, None), (3, ["x"])], "i int, s array<string>")
    both = lists.orderBy("i").select(
        arrow.similarity_to_previous("s").alias("a"), native.similarity_to_previous("s").alias("b")
    )
    for row in both.collect():
        assert len(row.a) == len(row.b or [])
        for x, y in zip(row.a, row.b or []):
            assert (x is None and y is None) or x == pytest.approx(y, abs=1e-12)


def test_vector_arithmetic(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    a, b, z = F.col("a"), F.col("b"), F.col("z")
    row = df.select(
        vectors.dot(a, b), vectors.squared_l2(a, b), vectors.cosine(a, b), vectors.cosine(a, z)
    ).first()
    assert row[0] == 1.0 and row[1] == 1.0 and row[2] == pytest.approx(2**-0.5) and row[3] is None


def test_user_embedder_loads_once_per_task_and_sees_batches(spark):
    def load():
        calls = []

        def encode(texts):
            calls.append(len(texts))
            return np.array([[len(t), len(calls)] for t in texts])

        return encode

    df = spark.createDataFrame([("ab",), (None,), ("abc",)], "t string").coalesce(1)
    out = [r.v for r in df.select("t", Embedder(load, 2).vector("t").alias("v")).collect()]
    assert out == [[2.0, 1.0], [0.0, 1.0], [3.0, 1.0]]


def test_forms_split_words_alike(spark):
    texts = ["a\u00a0b c", "a\u2003b\tc\x0bd", "a\x1cb \x85 c", "\u00e9\u00e8 x", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").filter("text is not null")
    for dim in (16, 70_000):
        out = df.select(HashedBow(dim).vector("text").alias("a"), HashedBow(dim, native=True).vector("text").alias("b"))
        if dim > 16:
            out = df.filter("i < 2").select(HashedBow(dim).vector("text").alias("a"), HashedBow(dim, native=True).vector("text").alias("b"))
        assert all(r.a == r.b for r in out.collect())


def test_texts_of_like_lengths_go_together(spark):
    rng = np.random.default_rng(4)
    texts = ["x" * int(n) for n in rng.pareto(1.2, 3000) * 20] + ["", "y" * 90_000, ""]
    batches = LengthBatches(rows=100, padded=5000)
    cut = list(batches.cut(texts))
    assert sorted(np.concatenate(cut).tolist()) == list(range(len(texts)))
    sizes = [[len(texts[i]) for i in own] for own in cut]
    assert all(len(s) == 1 or len(s) <= 100 and len(s) * max(s) <= 5000 for s in sizes)
    padded = sum(len(s) * max(s) for s in sizes)
    as_they_come = sum(len(texts[at : at + 100]) * max(map(len, texts[at : at + 100])) for at in range(0, len(texts), 100))
    assert padded < 1.2 * sum(map(len, texts)) < 0.2 * as_they_come
    seen = []
    encode = lambda own: (seen.append(len(own)), np.array([[len(t)] for t in own], np.float32))[1]
    assert batches.encode(encode, texts)[:, 0].tolist() == list(map(len, texts)) and len(seen) == len(cut)
    assert batches.encode(lambda own: np.zeros((len(own), 2)), []).shape == (0, 2)

    made = Embedder(lambda: lambda own: np.array([[len(t), len(own)] for t in own]), 2, batches=LengthBatches(rows=3))
    df = spark.createDataFrame([(i, None if i == 4 else "z" * (37 * i % 11)) for i in range(40)], "i long, text string")
    rows = df.coalesce(1).select("i", "text", made.vector("text").alias("v"), made.similarity_to_previous(F.array("text", "text")).alias("s")).collect()
    assert all(r.v[0] == len(r.text or "") and r.v[1] <= 3 and len(r.s) == 2 for r in rows)


def test_parts_of_a_batch_meet(spark):
    """More sentences than one call takes: similarities across the border are those of the built-in form."""
    sentences = [f"w{i % 5} w{i % 3} w{i % 7}" for i in range(9000)]
    df = spark.createDataFrame([(0, sentences[:5000]), (1, []), (2, sentences[5000:]), (3, ["w1"])], "i int, s array<string>").coalesce(1)
    arrow, native = HashedBow(16), HashedBow(16, native=True)
    for r in df.select(arrow.similarity_to_previous("s").alias("a"), native.similarity_to_previous("s").alias("b")).collect():
        assert len(r.a) == len(r.b) and np.allclose(np.array(r.a[1:], float), np.array(r.b[1:], float))
    texts = spark.createDataFrame([(t,) for t in sentences], "t string").coalesce(1)
    assert texts.select(arrow.vector("t").alias("a"), native.vector("t").alias("b")).filter("a != b").count() == 0


def test_long_texts_go_to_an_encoder_in_parts(spark):
    """A call of an encoder was bounded in texts only, so that its memory grew with their length."""
    def load():
        return lambda texts: np.array([[sum(map(len, texts)), len(texts), t.count("a")] for t in texts], np.float32).reshape(len(texts), 3)

    texts = spark.range(0, 30, 1, 1).select("id", F.expr("repeat('ab ', 170000 + int(id))").alias("text"))
    made = texts.select("id", Embedder(load, 3).vector("text").alias("v")).collect()
    assert all(r.v[0] <= 4 << 20 and r.v[2] == 170_000 + r.id for r in made)
    joined = texts.agg(F.sort_array(F.collect_list("text")).alias("all"))
    sims = joined.select(HashedBow(8).similarity_to_previous("all").alias("s")).first().s
    assert len(sims) == 30 and sims[0] is None and all(abs(s - 1) < 1e-6 for s in sims[1:])


def test_slices():
    from sparkrank.functions.splitting import slices

    assert list(slices(np.array([1, 1, 9, 0, 2, 2]), 3, 4)) == [(0, 2), (2, 3), (3, 6)]
    assert list(slices(np.array([], int), 3, 4)) == []


def test_segments_are_joined_where_sentences_are_compared(spark):
    rng = np.random.default_rng(5)
    words = lambda: " ".join(rng.choice(list("abcdef"), rng.integers(0, 5)))
    rows = [(i, None if i % 9 == 0 else [None if rng.random() < 0.1 else words() for _ in range(i % 8)]) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, s array<string>")
    arrow, native = HashedBow(8), HashedBow(8, native=True)
    for threshold in (0.55, 0.5, 0.707106781, 1.0):
        both = df.select(arrow.segments("s", threshold).alias("a"), native.segments("s", threshold).alias("b"), "s")
        assert both.filter("s is not null and not (a <=> b)").count() == 0


def test_words_of_arrow_texts():
    import pyarrow as pa

    texts = [*TEXTS, " a\tb\x0bc\x0cd\re\n", "a\x1cb\x85c d", "é x "]
    encode = HashedBow(16).load()
    assert (encode(pa.array(["x", *texts])[1:]) == encode(texts)).all() and encode([]).shape == (0, 16)
