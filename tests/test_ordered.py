import random

from pyspark.sql import functions as F

from sparkrank.operators import chunking
from sparkrank.operators.ordered import RANGE, carry_forward, occurrence_number, place_in_run, range_starts, running_sums, with_range


def table(spark, rows, schema):
    shuffled = list(rows)
    random.Random(3).shuffle(shuffled)
    return spark.createDataFrame(shuffled, schema).repartition(5)


def test_running_sums_per_key(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), p, rng.randint(0, 5)) for p in range(60)]
    df = table(spark, rows, "k string, pos long, v long")
    out = {
        (r.k, r.pos): (r.total, r.n)
        for r in running_sums(df, {"total": F.col("v"), "n": F.lit(1)}, "pos", ["k"], width=7).collect()
    }
    totals = {}
    for k, pos, v in rows:
        total, n = totals.get(k, (0, 0))
        totals[k] = (total + v, n + 1)
        assert out[(k, pos)] == totals[k]


def test_occurrence_number_on_one_hot_key(spark):
    df = table(spark, [("x", p) for p in range(50)], "id string, pos long")
    out = occurrence_number(df, "id", "pos", "n", width=8).orderBy("pos").collect()
    assert [r.n for r in out] == list(range(50))


def test_carry_forward(spark):
    rng = random.Random(2)
    rows = [(p, rng.choice(["a", "b", None, None, None])) for p in range(40)]
    rows[0] = (0, None)
    df = table(spark, rows, "pos long, v string")
    out = carry_forward(df, "v", "pos", "w", width=3).orderBy("pos").collect()
    last = None
    for row, (_, v) in zip(out, rows):
        last = v or last
        assert row.w == last


def skip_loop(flags):
    """Positions a loop moves that deletes from the list it walks."""
    items, moved, i = list(range(len(flags))), [], 0
    while i < len(items):
        if flags[items[i]]:
            moved.append(items.pop(i))
        i += 1
    return moved


def test_skip_routing_matches_loop(spark):
    assert skip_loop([True, True, True, False, True]) == [0, 2, 4]
    for seed in range(6):
        rng = random.Random(seed)
        flags = [rng.random() < 0.75 for _ in range(70)] if seed else [True] * 40
        df = table(spark, list(enumerate(flags)), "pos long, is_long boolean")
        out = chunking.skip_after_removal(df, width=4).filter("is_long").orderBy("pos").collect()
        assert [r.pos for r in out] == skip_loop(flags)


def test_place_in_run_with_gaps_in_positions(spark):
    flags = {3: True, 10: True, 25: False, 70: True, 71: True, 300: True}
    df = table(spark, list(flags.items()), "pos long, f boolean")
    out = place_in_run(df, "f", "pos", width=10).orderBy("pos").collect()
    assert [r.place for r in out] == [1, 2, 0, 1, 2, 3]


def test_rows_without_position_or_key_stay(spark):
    rows = [(None, True, "k"), (1, True, None), (2, True, None), (50, True, None), (51, False, "k"), (52, True, "k")]
    df = table(spark, rows, "pos long, f boolean, k string")
    placed = {r.pos: r.place for r in place_in_run(df, "f", "pos", width=10).collect()}
    assert placed == {None: 1, 1: 2, 2: 3, 50: 4, 51: 0, 52: 1}
    numbered = {r.pos: r.occurrence for r in occurrence_number(df, "k", "pos", width=10).collect()}
    assert numbered == {None: 0, 1: 0, 2: 1, 50: 2, 51: 1, 52: 2}
    carried = carry_forward(df.withColumn("v", F.when(F.col("pos") == 1, "x")), "v", "pos", "w", ["k"], width=10)
    assert {r.pos: r.w for r in carried.collect()} == {None: None, 1: "x", 2: "x", 50: "x", 51: None, 52: None}


def test_sparse_positions(spark):
    """Random positions of 60 bits, a dense stretch and a far one: no range is wider than asked for."""
    n, width = 200_000, 1000
    df = spark.range(n).selectExpr("case when id % 4 = 0 then id else shiftright(xxhash64(id), 3) end as pos", "cast(id % 7 as long) as v", "id % 3 = 0 as f")
    starts = range_starts(df, "pos", width)
    assert n / width <= len(starts) <= 3 * n / width
    sizes = [r["count"] for r in with_range(df, "pos", width).groupBy(RANGE).count().collect()]
    assert max(sizes) <= width and len(sizes) <= 3 * n / width
    rows = sorted((r.pos, r.v, r.f) for r in df.collect())
    total, place = 0, 0
    summed = {r.pos: r.total for r in running_sums(df, {"total": F.col("v")}, "pos", width=width).collect()}
    placed = {r.pos: r.place for r in place_in_run(df, "f", "pos", width=width).collect()}
    for pos, v, f in rows:
        total, place = total + v, place + 1 if f else 0
        assert (summed[pos], placed[pos]) == (total, place)


def test_sparse_positions_with_nulls_ties_and_keys(spark):
    rows = [(None, 1, "a"), (None, 2, None), (-(1 << 62), 3, "a"), (1 << 62, 4, "a"), (1 << 62, 4, "b"), (5, 6, None), (7, 7, None)]
    df = spark.createDataFrame(rows, "pos long, v long, k string")
    assert range_starts(df, "pos", 2) is not None and range_starts(df.filter("pos is null"), "pos", 2) is None
    out = running_sums(df, {"total": F.col("v")}, "pos", ["k"], width=2).collect()
    assert sorted((r.total, r.k or "") for r in out) == [(1, "a"), (2, ""), (4, "a"), (4, "b"), (8, ""), (8, "a"), (15, "")]
