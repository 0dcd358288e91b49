import random
import time

from pyspark.sql import functions as F

from sparkrank.functions import splitting
from sparkrank.functions.embedding import HashedBow
from sparkrank.operators import chunking
from sparkrank.plans.index import chunk_corpus


def pieces(spark, texts, size, overlap):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.orderBy("i").select(splitting.size_pieces("t", size, overlap).alias("p")).collect()
    return [r.p for r in out]


def test_packing_golden(spark):
    text = "the quick brown fox jumps over the lazy dog again and again"
    assert pieces(spark, [text], 20, 0) == [["the quick brown fox", "jumps over the lazy", "dog again and again"]]


def plain_pack(text, size, overlap):
    parts = []
    for w in text.split():
        parts += [w[i : i + size] for i in range(0, len(w), size)]
    done, cur = [], []
    for w in parts:
        if cur and len(" ".join(cur + [w])) > size:
            done.append(" ".join(cur))
            tails = [cur[i:] for i in range(1, len(cur))] + [[]]
            cur = next(t for t in tails if len(" ".join(t)) <= overlap and len(" ".join(t + [w])) <= size)
        cur = cur + [w]
    return done + ([" ".join(cur)] if cur else [])


def test_packing_matches_loop(spark):
    rng = random.Random(5)
    texts = [
        " ".join("x" * rng.choice([1, 2, 3, 5, 9, 30]) + str(i) for i in range(rng.randint(1, 60)))
        for _ in range(40)
    ]
    for size, overlap in ((20, 6), (25, 0), (40, 39)):
        for text, got in zip(texts, pieces(spark, texts, size, overlap)):
            expected = [text] if len(text) <= size else plain_pack(text, size, overlap)
            assert got == expected
            assert all(len(p) <= size for p in got)


def test_packing_takes_one_pass():
    words = ["word"] * 2_000_000
    started = time.monotonic()
    packed = splitting.pack_words(words, 300, 30)
    assert time.monotonic() - started < 20
    assert sum(len(p.split()) for p in packed) > len(words) and max(map(len, packed)) <= 300


def test_packing_edges(spark):
    assert pieces(spark, ["", "   ", "short", "y" * 45], 20, 5) == [[], [], ["short"], ["y" * 20, "y" * 20, "y" * 5]]


def segments(spark, sentences, sims):
    df = spark.createDataFrame([(sentences, sims)], "s array<string>, v array<double>")
    return df.select(splitting.join_segments(F.col("s"), F.col("v"), 0.55)).first()[0]


def test_segmentation(spark):
    names = ["s0", "s1", "s2", "s3"]
    assert segments(spark, names, [None, 0.9, 0.3, 0.8]) == ["s0 s1", "s2 s3"]
    assert segments(spark, ["s0"], [None]) == ["s0"]
    assert segments(spark, [], []) == []
    assert segments(spark, names, [None, None, 0.55, 0.1]) == ["s0 s1 s2", "s3"]


def test_similarity_with_zero_vector(spark):
    vecs = [[1.0, 0.0], [1.0, 0.1], [0.0, 1.0], [0.1, 1.0], [0.0, 0.0], [1.0, 0.0]]
    df = spark.createDataFrame([(vecs, list("abcdef"))], "v array<array<float>>, s array<string>")
    sims = df.withColumn("sim", splitting.similarity_to_previous(F.col("v")))
    assert sims.select(splitting.join_segments(F.col("s"), F.col("sim"), 0.55)).first()[0] == ["a b", "c d e f"]
    assert sims.first().sim[4] is None


def test_segments_keep_all_sentences_in_order(spark):
    texts = [("d1", "one two. one three. four five six. four five."), ("d2", "alone"), ("d3", "")]
    docs = spark.createDataFrame(texts, "_id string, text string")
    out = chunking.semantic_segments(docs, HashedBow()).orderBy("_id", "segment_no").collect()
    joined = {}
    for r in out:
        joined.setdefault(r._id, []).append(r.segment)
    assert {k: " ".join(v) for k, v in joined.items()} == {"d1": texts[0][1], "d2": "alone"}


def test_repeat_numbers(spark):
    docs = spark.createDataFrame([("a", 0), ("b", 1), ("a", 2), ("a", 3)], "_id string, pos long")
    out = chunking.number_repeats(docs, width=2).orderBy("pos").collect()
    assert [r._id for r in out] == ["a", "b", "a_1", "a_2"]
    assert [r.parent_id for r in out] == ["a", "b", "a", "a"]


def test_ids_without_moving_texts(spark):
    """Counters and repeat numbers come to the documents; documents without a position keep their rows."""
    docs = spark.createDataFrame([("a", 0, "x"), ("b", None, "y"), ("a", 2, "z"), ("c", 1 << 60, "w")], "_id string, pos long, text string")
    segments = docs.select("_id", "pos", F.explode(F.array("text", "text")).alias("segment"), F.lit(1).alias("segment_no"))
    for rows, joined in ((10, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        counted = chunking.with_counters(docs, chunking.segment_counters(segments, width=2), broadcast_rows=rows)
        assert counted.columns == [*docs.columns, "__first", "__doc_no"]
        assert {r.text: (r["__first"], r["__doc_no"]) for r in counted.collect()} == {"y": (0, 0), "x": (2, 1), "z": (4, 2), "w": (6, 3)}
        numbered = chunking.number_repeats(docs, width=2, broadcast_rows=rows)
        assert sorted(r._id for r in numbered.collect()) == ["a", "a_1", "b", "c"]
        if rows:
            for made in (counted, numbered):
                plan = made._jdf.queryExecution().executedPlan().toString()
                assert joined in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_chunk_ids(spark):
    rows = [("d", 0, 0, None, "x"), ("d", 0, 1, 0, "y"), ("e", 3, 0, 1, "z")]
    cut = spark.createDataFrame(rows, "_id string, pos long, segment_no int, piece_no int, text string")
    assert [r._id for r in chunking.chunk_ids(cut).orderBy("text").collect()] == ["d_0", "d_1_0", "e_0_1"]
    segments = cut.select("pos", "segment_no").distinct()
    named = chunking.counter_chunk_ids(cut, segments, width=2).orderBy("text").collect()
    # counter, document, segment, piece
    assert [r._id for r in named] == ["d_000", "d_1010", "e_2101"]


def test_chunk_corpus(spark, monkeypatch):
    long = " ".join(f"w{i}" for i in range(200)) + ". " + " ".join(f"v{i}" for i in range(200)) + "."
    rows = [("aa1", "t", "short one", 0), ("aa1", "t", "short two", 1), ("bb2", "t", long, 2), ("aa1", "t", "three", 3)]
    docs = spark.createDataFrame(rows, "_id string, title string, text string, pos long").repartition(3)
    out = chunk_corpus(docs, HashedBow()).collect()
    by_id = {r._id: r for r in out}
    assert len(by_id) == len(out)
    assert {i for i in by_id if i.startswith("aa")} == {"aa1", "aa1_1", "aa1_2"}
    assert by_id["aa1_2"].text == "three" and by_id["aa1_2"].ticker == "aa"
    parts = [r for r in out if r.parent_id == "bb2"]
    assert len(parts) > 4 and all(len(r.text) <= 300 and r.ticker == "bb" for r in parts)
    covered = {w for r in parts for w in r.text.split()}
    assert covered == set(long.split())
    # documents long and short with one id: chunk ids stay unique
    mixed = docs.withColumn("_id", F.lit("aa1"))
    mixed = chunk_corpus(mixed.unionByName(mixed.withColumn("pos", F.col("pos") + 10)), HashedBow()).collect()
    assert len({r._id for r in mixed}) == len(mixed) == 2 * len(out)
    assert {r.parent_id for r in mixed} == {"aa1"}
    # the same rows without the broadcast
    monkeypatch.setattr(chunking, "BROADCAST_REPEATS", 0)
    again = chunk_corpus(docs, HashedBow()).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_repeated_ids(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("a",)], "_id string")
    assert [tuple(r) for r in chunking.repeated_ids(rows).collect()] == [("a", 2)]


def _packed_by_words(words, size, overlap):
    """The rule stated word by word."""
    pieces, piece = [], []
    measure = lambda own: sum(map(len, own)) + len(own) - 1
    for part in (w[i : i + size] for w in words for i in range(0, len(w), size)):
        if piece and measure([*piece, part]) > size:
            pieces.append(" ".join(piece))
            piece = piece[1:]
            while piece and measure(piece) > min(overlap, size - 1 - len(part)):
                piece = piece[1:]
        piece.append(part)
    return [*pieces, " ".join(piece)] if piece else pieces


def test_packing_goes_by_pieces():
    import random

    rng = random.Random(6)
    for _ in range(3000):
        size = rng.randint(1, 40)
        overlap = rng.randrange(size)
        words = ["é" * (rng.choice([1, 1, 2, 5, size, size + 1, 2 * size + 3])) for _ in range(rng.randint(0, 30))]
        assert splitting.pack_words(words, size, overlap) == _packed_by_words(words, size, overlap)
    # words are walked once, not once for each step
    seen = iter(["ab"] * 50_000)
    assert len(splitting.pack_words(seen, 300, 30)) > 400


def test_sentences_are_split_once(spark):
    """The plan of the chunks split all sentences twice, and counted the words of a text three times."""
    docs = spark.createDataFrame([("A1", "t", "x y. z", 0)], "_id string, title string, text string, pos long")
    plan = chunk_corpus(docs, HashedBow())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("([.!?])") == 1
