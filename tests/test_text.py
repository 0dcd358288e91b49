import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkrank.catalog import oracle
from sparkrank.functions import text as T
from sparkrank.operators import cleaning
from sparkrank.operators.entities import COMPANIES, Dictionary


def values(spark, column, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("c"))).collect()]


def cleaned(spark, rows, **options):
    docs = spark.createDataFrame(rows, "_id string, title string, text string")
    out = cleaning.clean_corpus(docs, Dictionary(COMPANIES), **options)
    return [tuple(r) for r in out.select("_id", "title", "text").collect()]


def test_corpus_cleaning_as_coded(spark):
    rows = [
        (
            "MSFT20230014",
            "MSFT Annual MSFT report",
            "Revenue — was $1,234 (up 5%) and a loss of (12.5); see (Note) # AI's\nnext+line*",
        ),
        ("V20230004", "V overview", "Visa (2 of 3) (a(b)c) moved"),
        ("BRK.A20230396", "BRK.A Report", "x"),
    ]
    assert cleaned(spark, rows, as_coded_ids=True, substring=True) == [
        (
            "msft20230014",
            "microsoft annual report",
            "microsoft annual report revenue was dollar 1234 (up 5 percent ) and a loss of -12.5 "
            "see note ainext line",
        ),
        ("v20230004", "visa ovisaervisaiew", "visa ovisaervisaiew visa (2 of 3) a(bc) moved"),
        ("brk.a20230396", "brk.a report", "brk.a report x"),
    ]


def test_corpus_cleaning_defaults(spark):
    rows = [("V20230004", "V overview", "b"), ("BRK.A20230396", "BRK.A Report", "x\ny")]
    assert cleaned(spark, rows) == [
        ("v20230004", "visa overview", "visa overview b"),
        ("brka20230396", "brk.a report", "brk.a report xy"),
    ]
    assert cleaned(spark, rows, newline_as_space=True)[1][2] == "brk.a report x y"


def test_titles_by_dictionary_table(spark):
    rows = [("A1", "V and MSFT v", "x", 0), ("B2", "no name no", "y", 1), ("C3", None, "z", 2), ("D4", "aapl", "", 3)]
    docs = spark.createDataFrame(rows, "_id string, title string, text string, pos long")
    small = Dictionary(COMPANIES)
    sides = [
        sorted(map(tuple, cleaning.clean_corpus(docs, d).select("_id", "title", "text", "pos").collect()))
        for d in (small, small.table(spark))
    ]
    assert sides[0] == sides[1]
    assert [r[1] for r in sides[0]] == ["visa and msft", "no name no", "", "appl"]


def test_missing_title_and_text(spark):
    assert cleaned(spark, [("A1", None, None)]) == [("a1", "", "")]


def test_marks_before_s(spark):
    rows = ["it's", "it`s", "it'—,s", "it``ss", "It'S", "it'#s", "`'ss"]
    out = values(spark, lambda c: T.clean_corpus_text(F.lit(""), c), rows)
    assert out == ["it", "it", "it", "its", "its", "it s", "s"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aB9'`s.,•—#+*$%() \n", max_size=40), min_size=1, max_size=8))
def test_cleaning_matches_sql(spark, rows):
    out = values(spark, lambda c: T.clean_corpus_text(F.lit(""), c), rows)
    stated = oracle._clean("(' ' || $1)")
    assert out == [duckdb.execute(f"SELECT {stated}", [r]).fetchone()[0] for r in rows]
    assert all(re.fullmatch(r"[a-z0-9(). -]*", t) for t in out)


def test_query_cleaning(spark):
    rows = ["HD Net PP&E as of 2023", "Home Depot # of employee", "Microsoft`s 5% of $3"]
    out = values(spark, T.clean_query_text, rows)
    assert out == [
        "hd net ppe as of 2023",
        "home depot  number  of employee",
        "microsoft 5 percent  of  dollar 3",
    ]
    assert values(spark, T.clean_query_text, out) == out


def test_identifiers(spark):
    assert values(spark, T.normal_id, ["BRK.A20230396"]) == ["brka20230396"]
    assert values(spark, T.tag_of, ["BRK.A2023", "abc", "1a"]) == ["brk.a", "abc", ""]
    assert values(spark, T.parent_of, ["p1_0_2", "p1"]) == ["p1", "p1"]


def test_replace_whole_word_keeps_spacing(spark):
    out = values(
        spark, lambda c: T.replace_word(c, F.lit("v"), F.lit("visa")), ["v  v v", "overview", " v", "a   b v "]
    )
    assert out == ["visa  visa visa", "overview", " visa", "a   b visa "]


def test_sentences(spark):
    out = values(spark, T.sentences, ["Hi there. It is 3.5 m!  Yes? ok", "", "   ", "one"])
    assert out == [["Hi there.", "It is 3.5 m!", "Yes?", "ok"], [], [], ["one"]]


def test_version_label(spark):
    assert values(spark, T.bump_version, ["v1.0", "v1.9", "free text", None]) == ["v1.1", "v2.0", None, None]


def test_judgments(spark):
    rows = spark.createDataFrame([("q1", "BRK.A20230396", 1)], "query_id string, corpus_id string, score int")
    assert cleaning.clean_judgments(rows).first()["corpus_id"] == "brka20230396"


def test_version_keeps_its_digits(spark):
    assert values(spark, T.bump_version, ["v1.25", "v1.04", "7", "v12.50"]) == ["v1.35", "v1.14", "v7.1", "v12.6"]


def test_corpus_cleaning_is_one_function(spark):
    """A text took seven passes of regular expressions in the plan."""
    rows = ["İs Kg 5% of $3 `—,s'•s", "(1.5) (١) (a(b)c)  d\x00\n\te", "''s '`s ÉCU +*#x", "", None]
    out = values(spark, lambda c: T.clean_corpus_text(F.lit(""), c), rows)
    assert out == ["is kg 5 percent of dollar 3", "-1.5 () a(bc) de", "cu x", "", ""]
    df = spark.createDataFrame([("x",)], "c string").select(T.clean_corpus_text(F.lit(""), F.col("c")).alias("c"))
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
