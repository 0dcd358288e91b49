"""Documents to training sequences: five stages, each one operator.

Every stage takes the documents that its predecessor kept, with the columns of
``documents``, and all but the last return those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrank.llm import decontamination, packing, pii, simhash, toxicity
from sparkrank.llm.common import stored, table
from sparkrank.llm.queries import TOKENIZER

#: SQL cannot express fingerprints, learned scores or tokens; tests hold the stages against plain versions.
ORACLE_SQL = None


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    return toxicity.civil(docs, table(spark, sf_dir, "labels"))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near-duplicates."""
    return simhash.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def anonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` counts the new text."""
    masked = pii.masked(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = dict(docs.dtypes)["n_chars"]
    return masked.withColumn("n_chars", F.length("text").cast(kind))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", civil),
    ("simhash", deduplicated),
    ("decontamination", decontaminated),
    ("pii", anonymous),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
