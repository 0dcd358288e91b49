import pytest
from pyspark.sql import functions as F

from sparkrank.operators import skew
from sparkrank.operators.entities import COMPANIES, Dictionary, invert, route_queries

QUERIES = [
    (0, "q0", "what did the firm say"),
    (1, "q1", "microsoft revenue"),
    (2, "q2", "msft segment breakdown"),
    (3, "q3", "nothing here"),
    (4, "q4", "v  apple or visa"),
    (5, "q5", "v overview v"),
    (6, "q6", "who else"),
]


def routed(spark, **options):
    queries = spark.createDataFrame(QUERIES, "pos long, query_id string, query_text string").repartition(3)
    table = Dictionary(COMPANIES).table(spark)
    rows = route_queries(queries, table, width=2, **options).orderBy("pos").collect()
    return {r.query_id: (r.ticker, r.route, r.embed_text) for r in rows}


def test_inverse_keeps_last_name(spark):
    names = {r.ticker: r.company for r in invert(Dictionary(COMPANIES).table(spark)).collect()}
    assert len(COMPANIES) == 22 and len(names) == 20
    assert names["aapl"] == "appl" and names["googl"] == "alphabet"


def test_routes(spark):
    out = routed(spark)
    assert out["q0"] == (None, "all", QUERIES[0][2])
    assert out["q1"] == ("msft", "company", "microsoft revenue")
    assert out["q2"] == ("msft", "ticker", "microsoft segment breakdown")
    assert out["q3"] == ("msft", "carry", "nothing here")
    # a company name anywhere wins over a ticker before it
    assert out["q4"] == ("aapl", "company", "v  apple or visa")
    assert out["q5"] == ("v", "ticker", "visa overview visa")
    assert out["q6"] == ("v", "carry", "who else")


def test_unresolved_options(spark):
    assert routed(spark, on_unresolved="all")["q3"] == (None, "all", "nothing here")
    assert set(routed(spark, on_unresolved="drop")) == {"q1", "q2", "q4", "q5"}
    assert routed(spark, substring=True)["q5"][2] == "visa ovisaerviewvisa".replace("viewvisa", "visaiew visa")
    with pytest.raises(ValueError):
        routed(spark, on_unresolved="guess")


def test_dictionary_size_is_checked(spark):
    many = spark.range(Dictionary.MAX_ENTRIES + 5).select(
        F.concat(F.lit("c"), "id").alias("company"), F.concat(F.lit("t"), "id").alias("ticker"), F.col("id").alias("pos")
    )
    with pytest.raises(ValueError):
        Dictionary.from_table(many)


def test_a_table_of_any_size_cleans_as_the_lookup_does(spark):
    """Null and repeated positions, a company given twice, a ticker of two companies, null titles."""
    from sparkrank.operators.cleaning import clean_titles

    entries = [("apple", "aapl", 0), ("visa", "v", 1), ("appl", "aapl", 2), ("visa", "vv", 3), ("apple", "aapl", 4), ("meta", "m", 5)]
    table = spark.createDataFrame(entries, "company string, ticker string, pos long")
    more = table.union(spark.range(5_000).selectExpr("concat('c', id)", "concat('t', id)", "id + 10"))
    docs = [("V one", 1), ("VV two m", 1), ("AAPL three aapl", None), ("m four", None), (None, 5), ("none", None), ("T77 x v", 2), ("V one", 9)]
    frame = spark.createDataFrame(docs, "title string, pos long")
    small = clean_titles(frame, Dictionary.from_table(table)).select("title").collect()
    assert sorted(map(str, small)) == sorted(map(str, clean_titles(frame, table).select("title").collect()))
    large = sorted(r.title for r in clean_titles(frame, more).select("title").collect())
    assert large == sorted(["v one", "v one", "visa two m", "appl three", "meta four", "", "none", "c77 x v"])
    plan = clean_titles(frame, more)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_heavy_keys_are_dealt_in_proportion(spark):
    """A word in a third of all rows takes as many salts as its share of the rows; rare words take none."""
    many = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', if(id % 3 = 1 and id < 1500, 'warm', concat('w', id))) as word", "id")
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("warm", 3), ("w2", 4), ("none", 5), (None, 6)], "word string, n int")
    heavy = {r.word: r["__salts"] for r in skew.heavy_keys(many, "word", 100).collect()}
    assert heavy == {"hot": 10, "warm": 5}
    plain = sorted(map(tuple, many.join(few, "word").collect()))
    assert len(plain) == 2000 + 500 + 1
    for rows in (100, 1 << 20):
        joined = skew.join_spread(many, few, "word", "id", rows)
        assert joined.columns == ["word", "id", "n"] and sorted(map(tuple, joined.collect())) == plain
    parts = skew.join_spread(many, few, "word", "id", 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in parts and "explode" not in skew.join_spread(many, few, "word", "id")._jdf.queryExecution().optimizedPlan().toString()
