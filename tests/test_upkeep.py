"""Upkeep of a collection: increments, audits, and writers at once."""

import pytest
from pyspark.sql import functions as F

from sparkrank.functions.embedding import HashedBow
from sparkrank.operators.entities import Dictionary
from sparkrank.plans import index, upkeep
from sparkrank.sources import snapshots
from sparkrank.sources.readers import input_fingerprint

COMPANIES = {"visa": "v", "apple": "aapl"}


def corpus(spark, changed=(), gone=(), added=()):
    long = " ".join(f"Sentence {i} tells of matter {i % 7}." for i in range(120))
    rows = [(f"D.{i}", f"V report {i}", f"{long} {'changed ' if i in changed else ''}{i}" if i % 5 == 0 else f"short text {i} {'changed' if i in changed else ''}", i) for i in range(40) if i not in gone]
    rows += [("SAME1", "a", "first of three", 100), ("same-1", "b", "second", 101), ("SAME.1", None, long, 102)]
    return spark.createDataFrame(rows + list(added), "_id string, title string, text string, pos long")


def maintained(spark, tmp_path, **options):
    return upkeep.MaintainedCollection(spark, str(tmp_path), Dictionary(COMPANIES), HashedBow(16), **options)


def rows(df):
    return sorted(tuple(r) for r in df.select("_id", "parent_id", "title", "text", "ticker", F.col("embedding").cast("string")).collect())


def fresh(docs):
    return rows(index.build_collection(docs, Dictionary(COMPANIES), HashedBow(16)))


def test_an_increment_equals_a_fresh_build(spark, tmp_path):
    kept = maintained(spark, tmp_path)
    first = kept.update(corpus(spark))
    assert rows(kept.table()) == fresh(corpus(spark)) and first.number == 1
    edited = corpus(spark, changed={5}, gone={7}, added=[("NEW9", "new", "a new text", 200), ("D.8", "again", "a second text of this id", 201)])
    second = kept.update(edited)
    assert rows(kept.table()) == fresh(edited)
    assert second.parts[: len(first.parts)] == first.parts and len(second.parts) == 2
    written = {r.parent_id for r in spark.read.parquet(second.parts[-1]).select("parent_id").collect()}
    assert written == {"d5", "d8", "new9"}
    assert rows(kept.table(first)) == fresh(corpus(spark))  # an earlier state can still be read
    again = kept.update(edited)
    assert again.number == second.number


def test_one_change_of_three_documents_with_one_id(spark, tmp_path):
    kept = maintained(spark, tmp_path)
    kept.update(corpus(spark))
    edited = corpus(spark).withColumn("text", F.when(F.col("pos") == 101, "other").otherwise(F.col("text")))
    state = kept.update(edited)
    assert rows(kept.table()) == fresh(edited)
    assert {r.parent_id for r in spark.read.parquet(state.parts[-1]).collect()} == {"same1"}


def test_worn_states_are_copied_into_one_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upkeep, "MAX_PARTS", 2)
    kept = maintained(spark, tmp_path)
    for i in range(4):
        state = kept.update(corpus(spark, changed=set(range(i))))
    assert len(state.parts) <= 2 and rows(kept.table()) == fresh(corpus(spark, changed={0, 1, 2}))


def test_other_rules_build_anew(spark, tmp_path):
    kept = maintained(spark, tmp_path)
    first = kept.update(corpus(spark))
    second = maintained(spark, tmp_path, size=100).update(corpus(spark))
    assert not set(first.parts) & set(second.parts) and second.number == 2


def test_a_taken_id_is_refused(spark, tmp_path):
    """``same1_1`` made from a repeat meets a document that bears this id."""
    kept = maintained(spark, tmp_path)
    before = kept.update(corpus(spark))
    chunks = kept.table().filter("_id = 'd1'").withColumn("_id", F.lit("same1_1"))
    with pytest.raises(snapshots.AuditFailed, match="n_taken: 1"):
        kept._audit(chunks, kept.table())
    with pytest.raises(snapshots.AuditFailed, match="n_repeated: 1"):
        snapshots.check(upkeep.audit_collection(kept.table().union(chunks.select(*kept.table().columns))))
    with pytest.raises(snapshots.AuditFailed, match="n_null_embedding"):
        snapshots.check(upkeep.audit_collection(kept.table().withColumn("embedding", F.lit(None).cast("array<float>"))))
    assert kept.snapshots.current().number == before.number


def test_a_failed_update_publishes_and_leaves_nothing(spark, tmp_path, monkeypatch):
    kept = maintained(spark, tmp_path)
    before = kept.update(corpus(spark))
    files = sorted(p for p in tmp_path.rglob("*.parquet"))

    def refuse(*args):
        raise snapshots.AuditFailed("refused")

    monkeypatch.setattr(kept, "_audit", refuse)
    with pytest.raises(snapshots.AuditFailed):
        kept.update(corpus(spark, changed={3}))
    assert kept.snapshots.current() == before and sorted(p for p in tmp_path.rglob("*.parquet")) == files


def test_two_writers_at_once(spark, tmp_path):
    one, two = maintained(spark, tmp_path), maintained(spark, tmp_path)
    base = one.update(corpus(spark))
    slow = two.snapshots.publish

    def late(state, after):  # the other writer publishes just before
        one.update(corpus(spark, changed={1}))
        return slow(state, after)

    two.snapshots.publish = late
    with pytest.raises(snapshots.Conflict):
        two.update(corpus(spark, changed={2}))
    assert one.snapshots.numbers() == [base.number, base.number + 1]
    assert rows(one.table()) == fresh(corpus(spark, changed={1}))


def test_empty_and_no_documents(spark, tmp_path):
    kept = maintained(spark, tmp_path)
    with pytest.raises(ValueError):
        kept.table()
    kept.update(corpus(spark))
    kept.update(corpus(spark).filter("false"))
    assert kept.table().count() == 0


def test_wide_plans_have_their_own_keys(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wide = [F.col("text").alias(f"c{i}") for i in range(31)]
    keys = {input_fingerprint(docs.select(*wide, last.alias("z"))) for last in (F.col("text"), F.upper("text"), F.col("text"))}
    assert len(keys) == 2
    assert input_fingerprint(docs.selectExpr("text a", "lang b")) != input_fingerprint(docs.selectExpr("text b", "lang a"))
