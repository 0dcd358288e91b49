"""Company and ticker dictionaries, and finding the entity a query names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrank.functions import text as T
from sparkrank.operators.ordered import WIDTH, carry_forward
from sparkrank.operators.skew import join_spread
from sparkrank.sources.collection import checkpointed

# The company names and tickers known by default.
COMPANIES = {
    "microsoft": "msft",
    "adobe": "adbe",
    "coupang": "cpng",
    "linde": "lin",
    "oracle": "orcl",
    "nvidia": "nvda",
    "delta": "dal",
    "tesla": "tsla",
    "netflix": "nflx",
    "home": "hd",
    "amazon": "amzn",
    "apple": "aapl",
    "appl": "aapl",
    "johnson": "jnj",
    "jp": "jpm",
    "visa": "v",
    "unitedhealth": "unh",
    "google": "googl",
    "alphabet": "googl",
    "berkshire": "brka",
    "meta": "meta",
    "pg": "pg",
}

DICTIONARY_SCHEMA = "company string, ticker string, pos long"


def invert(dictionary: DataFrame) -> DataFrame:
    """One company per ticker: the last company wins.

    A company given twice keeps its first place and its last ticker, as in :class:`Dictionary`.
    """
    companies = dictionary.groupBy("company").agg(F.max_by("ticker", "pos").alias("ticker"), F.min("pos").alias("pos"))
    return companies.groupBy("ticker").agg(F.max_by("company", "pos").alias("company"))


class Dictionary:
    """A small company dictionary held in the plan as a map literal.

    It is meant for the cleaning of titles, where a join would shuffle the whole
    corpus for a lookup. ``MAX_ENTRIES`` bounds it, because every word of a title
    is compared with every entry; cleaning and routing also take a table of any
    size.
    """

    MAX_ENTRIES = 1_000

    def __init__(self, companies: Mapping[str, str]):
        if len(companies) > self.MAX_ENTRIES:
            raise ValueError(f"more than {self.MAX_ENTRIES} dictionary entries: use a table")
        self.companies = dict(companies)
        names = {ticker: company for company, ticker in self.companies.items()}
        cells = [F.lit(part) for pair in names.items() for part in pair]
        self._tickers = F.array(*[F.lit(t) for t in names]).cast("array<string>")
        self._names = F.create_map(*cells).cast("map<string,string>")

    @classmethod
    def from_table(cls, table: DataFrame) -> Dictionary:
        """Read a dictionary table whose size is checked on the way.

        At most ``MAX_ENTRIES + 1`` rows reach the driver; more is an error.
        """
        rows = table.select("company", "ticker", "pos").limit(cls.MAX_ENTRIES + 1).collect()
        return cls({r["company"]: r["ticker"] for r in sorted(rows, key=lambda r: r["pos"])})

    @classmethod
    def fitting(cls, table: DataFrame) -> Dictionary | DataFrame:
        """The table in the plan when it is small enough for that, else the table itself.

        Cleaning and routing take both and give the same rows.
        """
        few = table.select("company", "ticker", "pos").limit(cls.MAX_ENTRIES + 1)
        return cls.from_table(table) if few.count() <= cls.MAX_ENTRIES else table

    def is_ticker(self, word: Column) -> Column:
        return F.array_contains(self._tickers, word)

    def company_of(self, ticker: Column) -> Column:
        return F.try_element_at(self._names, ticker)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, t, i) for i, (c, t) in enumerate(self.companies.items())]
        return spark.createDataFrame(rows, DICTIONARY_SCHEMA)


def resolve_entities(queries: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Ticker each query names: ``query_id, ticker, company, route``.

    The first word that is a company name decides; if the query has none, the
    first word that is a ticker. Queries that name nothing have no row. Words
    meet the dictionary in a join that spreads frequent words, and hits are
    reduced to the best per query before the shuffle.
    """
    lookup = dictionary.select(
        F.col("company").alias("word"), F.lit(0).alias("kind"), "ticker", "company"
    ).unionByName(
        invert(dictionary).select(F.col("ticker").alias("word"), F.lit(1).alias("kind"), "ticker", "company")
    )
    named = queries.select("query_id", F.posexplode(F.split("query_text", " ")).alias("at", "word"))
    best = (
        join_spread(named, lookup, "word", by="query_id")
        .groupBy("query_id")
        .agg(F.min(F.struct("kind", "at", "ticker", "company")).alias("hit"))
    )
    route = F.when(F.col("hit.kind") == 0, "company").otherwise("ticker")
    return best.select("query_id", "hit.ticker", "hit.company", route.alias("route"))


def route_queries(
    queries: DataFrame,
    dictionary: DataFrame,
    *,
    pos: str = "pos",
    on_unresolved: str = "carry",
    substring: bool = False,
    width: int = WIDTH,
) -> DataFrame:
    """Queries with the ticker to search and the text to embed.

    ``queries`` has ``query_id, query_text`` and a whole-number order ``pos``.
    A query that names nothing takes the ticker of the query before it
    (``carry``), is searched without a filter (``all``), or leaves (``drop``).
    With ``carry``, a query before any resolved one is searched without a filter.
    """
    if on_unresolved not in ("carry", "all", "drop"):
        raise ValueError(f"unknown on_unresolved: {on_unresolved}")
    how = "inner" if on_unresolved == "drop" else "left"
    resolved = resolve_entities(queries, dictionary)
    if on_unresolved == "carry":
        resolved = checkpointed(resolved)  # read for each range and for each query
    joined = queries.join(resolved, "query_id", how)
    rewritten = T.replace_word(F.col("query_text"), F.col("ticker"), F.col("company"), substring)
    routed = joined.withColumn(
        "embed_text",
        F.when(F.col("route") == "ticker", rewritten).otherwise(F.col("query_text")),
    )
    if on_unresolved == "carry":
        routed = carry_forward(
            routed.withColumnRenamed("ticker", "__own"), "__own", pos, "ticker", width=width
        )
    fallback = "carry" if on_unresolved == "carry" else "all"
    return routed.select(
        "query_id",
        pos,
        "query_text",
        "embed_text",
        "ticker",
        F.when(F.col("ticker").isNull(), "all").otherwise(F.coalesce("route", F.lit(fallback))).alias("route"),
    )
