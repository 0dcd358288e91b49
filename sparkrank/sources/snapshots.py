"""Published states of a stored table: staged, audited, then made current by one atomic step.

A state is a small JSON record: the folders of its data (parts), which of their rows no longer count
(a table of removed keys), the manifest it was made from, and the settings. Records are numbered.
A record becomes current by creating the file with the next number, which only one writer can do, so
of two writers at once one publishes and the other gets :class:`Conflict`. Readers take the highest number and
never see a state that is half written. Parts are never changed after they are written.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(Exception):
    """Another writer has published since this state was read."""


class AuditFailed(Exception):
    """A staged table breaks a rule; it was not published."""


@dataclass
class State:
    number: int = 0
    parts: list[str] = field(default_factory=list)
    manifest: str | None = None
    removed: str | None = None
    settings: str = ""


class Snapshots:
    """The states under a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _files(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def new_folder(self, kind: str) -> str:
        return f"{self.folder}/{kind}/{uuid.uuid4().hex}"

    def discard(self, path: str) -> None:
        """Delete a folder that no record names."""
        files, hadoop = self._files(path)
        files.delete(hadoop, True)

    def numbers(self) -> list[int]:
        files, hadoop = self._files(f"{self.folder}/current")
        if not files.exists(hadoop):
            return []
        names = [s.getPath().getName() for s in files.listStatus(hadoop)]
        return sorted(int(n) for n in names if n.isdigit())

    def current(self) -> State | None:
        """The state published last."""
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def read(self, number: int) -> State:
        files, hadoop = self._files(f"{self.folder}/current/{number:012d}")
        stream = files.open(hadoop)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return State(**json.loads(text))

    def publish(self, state: State, after: State | None) -> State:
        """Make ``state`` current if ``after`` still is."""
        state.number = (after.number if after else 0) + 1
        files, staged = self._files(f"{self.folder}/staged/{uuid.uuid4().hex}.json")
        out = files.create(staged, False)
        out.write(bytearray(json.dumps(asdict(state)).encode()))
        out.close()
        _, target = self._files(f"{self.folder}/current/{state.number:012d}")
        files.mkdirs(target.getParent())
        if not self._claim(files, staged, target):
            files.delete(staged, False)
            raise Conflict(f"state {state.number} of {self.folder} was published by another writer")
        return state

    def _claim(self, files, staged, target) -> bool:
        """Give the staged record its number; false if that is taken."""
        if files.getScheme() == "file":  # a local rename would replace the record of the other writer
            jvm = self.spark.sparkContext._jvm
            paths = [jvm.java.nio.file.Paths.get(files.makeQualified(p).toUri().getPath(), self._none()) for p in (target, staged)]
            try:
                jvm.java.nio.file.Files.createLink(*paths)
            except Exception as error:
                if "FileAlreadyExists" in str(error):
                    return False
                raise
            files.delete(staged, False)
            return True
        return not files.exists(target) and files.rename(staged, target)

    def _none(self):
        return self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.java.lang.String, 0)

    def table(self, state: State, schema: str, key: str) -> DataFrame:
        """The rows of a state: those of its parts without removed keys."""
        every = None
        gone = self.spark.read.parquet(state.removed) if state.removed else None
        for part in state.parts:
            rows = self.spark.read.schema(schema).parquet(part)
            if gone is not None:
                rows = rows.join(gone.filter(F.col("part") == part).select(F.col("key").alias(key)), key, "left_anti")
            every = rows if every is None else every.unionByName(rows)
        return every if every is not None else self.spark.createDataFrame([], schema)


def audit(rows: DataFrame, key: str, required: list[str], vector: str | None = None) -> DataFrame:
    """One row: rows, keys that are null or repeated, nulls in required columns, and lengths of vectors.

    ``n_repeated`` counts keys, not rows. One aggregation by key, combined before the
    shuffle, so a key in many rows is one row of it.
    """
    nulls = {f"n_null_{c}": F.count(F.when(F.col(c).isNull(), 1)) for c in required}
    sizes = {"least_size": F.min(F.size(vector)), "most_size": F.max(F.size(vector))} if vector else {}
    by_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *[e.alias(n) for n, e in (nulls | sizes).items()])
    repeated = F.count(F.when((F.col("n") > 1) & F.col(key).isNotNull(), 1))
    null_keys = F.sum(F.when(F.col(key).isNull(), F.col("n")).otherwise(0))

    def total(e) -> object:
        return F.coalesce(e, F.lit(0)).cast("long")

    return by_key.agg(
        total(F.sum("n")).alias("n_rows"),
        total(null_keys).alias("n_null_key"),
        repeated.alias("n_repeated"),
        *[total(F.sum(n)).alias(n) for n in nulls],
        *([F.min("least_size").alias("least_size"), F.max("most_size").alias("most_size")] if vector else []),
    )


def check(report: DataFrame) -> dict:
    """The row of an audit; raises :class:`AuditFailed` if a rule is broken."""
    found = report.first().asDict()
    broken = {c: n for c, n in found.items() if n and (c.startswith("n_null") or c in ("n_repeated", "n_taken"))}
    if found.get("least_size") != found.get("most_size"):
        broken["sizes"] = (found["least_size"], found["most_size"])
    if broken:
        raise AuditFailed(", ".join(f"{c}: {n}" for c, n in broken.items()))
    return found
