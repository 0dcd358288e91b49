"""Upkeep of a stored collection: only what changed is cleaned, cut and embedded again.

The unit is the parent: all documents with one normalised id, since documents that share an id also share
the numbering of their chunk ids. A manifest holds a digest of each parent. Against the manifest
of the current state, parents are changed, new, missing or unchanged; the documents of the first two become
a new part, and rows of changed and missing parents in older parts no longer count. The new part is staged,
audited together with what stays, and published in one step. Once a state has many parts or many rows
that no longer count, its rows are copied into one part; chunks are not made again for that.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank import schemas
from sparkrank.functions import text as T
from sparkrank.functions.embedding import Embedder
from sparkrank.operators import tracking
from sparkrank.operators.entities import Dictionary
from sparkrank.plans import index
from sparkrank.sources import collection as store
from sparkrank.sources.readers import table_fingerprint
from sparkrank.sources.snapshots import Snapshots, State, audit, check

MAX_PARTS = 16
MAX_REMOVED = 0.3  # share of parents whose rows in older parts no longer count

KEY = "parent_id"


def parent_manifest(docs: DataFrame) -> DataFrame:
    """``name, md5``: each normalised id with a digest of its documents.

    Positions count where several documents share an id, as they are part of its chunk ids. Sums of
    row hashes are combined before the shuffle, so a frequent id is no list.
    """
    named = docs.select(T.normal_id("_id").alias("name"), "title", "text", "pos")
    flags = [F.col(c).isNull() for c in ("title", "text")]  # hashes pass over nulls
    content = [F.xxhash64(F.lit(i), "title", "text", *flags).cast("decimal(38,0)") for i in (0, 1)]
    placed = [F.xxhash64(F.lit(i), "title", "text", "pos", *flags).cast("decimal(38,0)") for i in (2, 3)]
    sums = named.groupBy("name").agg(F.count(F.lit(1)).alias("n"), *[F.sum(e).alias(f"s{i}") for i, e in enumerate([*content, *placed])])

    def joined(*columns: str):
        return F.md5(F.concat_ws("/", *[F.col(c).cast("string") for c in ("n", *columns)]))

    return sums.select("name", F.when(F.col("n") > 1, joined("s2", "s3")).otherwise(joined("s0", "s1")).alias("md5"))


def audit_collection(chunks: DataFrame) -> DataFrame:
    """The rules of a collection: unique chunk ids, no nulls, vectors of one length."""
    return audit(chunks, "_id", ["parent_id", "text", "embedding", "ticker"], "embedding")


class MaintainedCollection:
    """A collection under a folder that follows its documents.

    Options are those of :func:`index.build_collection`, but for ``skip_as_coded``, which
    makes a document depend on those before it.
    """

    def __init__(self, spark, folder: str, dictionary: Dictionary | DataFrame, embedder: Embedder, *, version: str = "", **options):
        if embedder.name is None:
            raise ValueError("a stored collection needs an embedder with a name")
        if options.get("skip_as_coded"):
            raise ValueError("skip_as_coded makes documents depend on those before them")
        self.spark, self.snapshots = spark, Snapshots(spark, folder)
        self.dictionary, self.embedder, self.options = dictionary, embedder, options
        entries = repr(list(dictionary.companies.items())) if isinstance(dictionary, Dictionary) else table_fingerprint(dictionary).first()["md5"]
        self.settings = hashlib.md5(repr((version, repr(embedder), sorted(options.items()), entries, index.rules())).encode()).hexdigest()

    def table(self, state: State | None = None) -> DataFrame:
        """The chunks of the current state, or of a given one."""
        state = state or self.snapshots.current()
        if state is None:
            raise ValueError(f"nothing is published under {self.snapshots.folder}")
        return self.snapshots.table(state, schemas.COLLECTION, KEY)

    def changes(self, docs: DataFrame, state: State | None = None) -> DataFrame:
        """``name, main_md5, current_md5, status`` of all parents against a state."""
        main = self.spark.read.parquet(state.manifest) if state else self.spark.createDataFrame([], "name string, md5 string")
        return tracking.compare_manifests(main, parent_manifest(docs))

    def update(self, docs: DataFrame) -> State:
        """Bring the collection to ``docs`` (``_id, title, text, pos``); returns the published state.

        Nothing is published if nothing changed, if the audit fails (:class:`snapshots.AuditFailed`)
        or if another writer was faster (:class:`snapshots.Conflict`).
        """
        now = self.snapshots.current()
        base = now if now and now.settings == self.settings else None  # other rules: nothing can be reused
        written: list[str] = []

        def new(kind: str) -> str:
            written.append(self.snapshots.new_folder(kind))
            return written[-1]

        try:
            changes_at = new("changes")
            self.changes(docs, base).write.parquet(changes_at)
            changes = self.spark.read.parquet(changes_at)
            counts = {r.status: r["count"] for r in changes.groupBy("status").count().collect()}
            touched = sum(n for s, n in counts.items() if s != "unchanged")
            if base and not touched:
                self.snapshots.discard(changes_at)
                return base
            manifest = new("manifests")
            changes.filter("status <> 'missing'").select("name", F.col("current_md5").alias("md5")).write.parquet(manifest)
            state = State(parts=list(base.parts) if base else [], manifest=manifest, settings=self.settings)
            if base:
                state.removed = new("removed")
                self._removed(base, changes).write.parquet(state.removed)
            kept = self.table(State(parts=state.parts, removed=state.removed)) if base else None
            if counts.get("changed", 0) + counts.get("new", 0):
                part = new("parts")
                dirty = changes.filter("status in ('changed', 'new')").select(F.col("name").alias("__name"))
                some = docs if not base else docs.withColumn("__name", T.normal_id("_id")).join(dirty, "__name", "left_semi").drop("__name")
                store.write_collection(index.build_collection(some, self.dictionary, self.embedder, **self.options), part)
                self._audit(store.read_collection(self.spark, part), kept)
                state.parts.append(part)
            if base and self._worn(state):
                state = self._compact(state, new)
            published = self.snapshots.publish(state, now)
        except Exception:
            for path in written:
                self.snapshots.discard(path)
            raise
        self.snapshots.discard(changes_at)
        return published

    def _removed(self, base: State, changes: DataFrame) -> DataFrame:
        """``part, key``: parents whose rows in older parts no longer count."""
        gone = changes.filter("status in ('changed', 'missing')").select(F.col("name").alias("key"))
        parts = self.spark.createDataFrame([(p,) for p in base.parts], "part string")  # at most MAX_PARTS
        rows = gone.select(F.explode(F.array(*[F.lit(p) for p in base.parts])).alias("part"), "key") if base.parts else parts.selectExpr("part", "part as key")
        older = self.spark.read.parquet(base.removed).select("part", "key") if base.removed else None
        return (rows if older is None else rows.unionByName(older)).distinct()

    def _audit(self, part: DataFrame, kept: DataFrame | None) -> None:
        """The rules for a new part, whose ids must not be taken by rows that stay."""
        report = audit_collection(part)
        if kept is not None:
            taken = kept.select("_id").join(part.select("_id"), "_id", "left_semi")
            report = report.crossJoin(F.broadcast(taken.agg(F.count(F.lit(1)).alias("n_taken"))))  # one row each
        check(report)

    def _worn(self, state: State) -> bool:
        if len(state.parts) > MAX_PARTS:
            return True
        removed = self.spark.read.parquet(state.removed).select("key").distinct().count()
        return removed > MAX_REMOVED * max(self.spark.read.parquet(state.manifest).count(), 1)

    def _compact(self, state: State, new) -> State:
        """The same rows in one part."""
        part = new("parts")
        store.write_collection(self.table(state), part)
        return State(parts=[part], manifest=state.manifest, settings=state.settings)
