"""Tables of runs, run settings and data manifests, and the promotion rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkrank.functions import text as T

# Branches whose runs are logged and never compared.
BASE_BRANCHES = ("main", "prod")
FIRST_VERSION = "v1.0"
UPDATED_VERSION = "Base version changed check data diff"


def compare_manifests(main: DataFrame, current: DataFrame) -> DataFrame:
    """Files of two manifests side by side with their status.

    Both have ``name, md5``. A main entry without an md5 counts as absent, so
    its file is new.
    """
    a = main.select("name", F.col("md5").alias("main_md5"), F.lit(True).alias("__main"))
    b = current.select("name", F.col("md5").alias("current_md5"), F.lit(True).alias("__current"))
    status = (
        F.when(F.col("__current").isNull(), "missing")
        .when(F.col("main_md5").isNull(), "new")
        .when(~F.col("main_md5").eqNullSafe(F.col("current_md5")), "changed")
        .otherwise("unchanged")
    )
    return a.join(b, "name", "full_outer").select(
        "name", "main_md5", "current_md5", status.alias("status")
    )


BUCKET_ROWS = 10_000
MOST_BUCKETS = 1 << 18


def compare_large_manifests(main: DataFrame, current: DataFrame, buckets: int | None = None) -> DataFrame:
    """The rows of :func:`compare_manifests`, shuffling only buckets of names that differ.

    Names are dealt over buckets by hash, and each side has one digest a bucket: its count and two sums
    of row hashes, combined before the shuffle. Where both sides agree, every row is unchanged and
    stays where it is; only the others are joined. Names are unique within a manifest. The
    default makes buckets of about :data:`BUCKET_ROWS` names, and at most :data:`MOST_BUCKETS`,
    whose numbers are what is broadcast.
    """
    if buckets is None:
        buckets = min(max(main.count() // BUCKET_ROWS, 1), MOST_BUCKETS)
    bucket = F.pmod(F.xxhash64("name"), F.lit(buckets)).alias("__bucket")

    def digests(manifest: DataFrame, side: str) -> DataFrame:
        sums = [F.sum(F.xxhash64(F.lit(i), "name", "md5", F.col("md5").isNull()).cast("decimal(38,0)")).alias(f"s{i}") for i in (0, 1)]
        rows = manifest.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), *sums)
        return rows.select("__bucket", F.struct("n", "s0", "s1").alias(side))

    both = digests(main, "a").join(digests(current, "b"), "__bucket", "full_outer")
    differing = F.broadcast(both.filter(~F.col("a").eqNullSafe(F.col("b"))).select("__bucket"))
    a, b = (m.select("name", "md5", bucket) for m in (main, current))
    same = a.join(differing, "__bucket", "left_anti")
    status = F.when(F.col("md5").isNull(), "new").otherwise("unchanged")
    equal = same.select("name", F.col("md5").alias("main_md5"), F.col("md5").alias("current_md5"), status.alias("status"))
    return equal.unionByName(compare_manifests(*(m.join(differing, "__bucket", "left_semi") for m in (a, b))))


def with_new_versions(diff: DataFrame, main_version: Column) -> DataFrame:
    """Add the version a changed or new file gets."""
    version = F.when(F.col("status") == "changed", T.bump_version(main_version)).when(
        F.col("status") == "new", FIRST_VERSION
    )
    return diff.withColumn("new_version", version)


def integrity(diff: DataFrame) -> DataFrame:
    """One row: whether nothing changed, and how many files have each status."""

    def count(status: str) -> Column:
        return F.count(F.when(F.col("status") == status, 1)).alias(f"n_{status}")

    return diff.agg(
        F.coalesce(F.bool_and(F.col("status") == "unchanged"), F.lit(True)).alias("data_integrity_passed"),
        *[count(s) for s in ("unchanged", "changed", "new", "missing")],
    )


def version_entries(
    diff: DataFrame, main_version: Column, *, by: Sequence[str] = ()
) -> DataFrame:
    """Data-version records with the lists of changed, new and missing files.

    A list holds the files of one record: name the columns that tell records
    apart in ``by``. For manifests of very many files use the rows of
    :func:`compare_manifests` themselves as the log.
    """

    def names(status: str, value: str = "name") -> Column:
        found = F.collect_list(F.when(F.col("status") == status, F.struct("name", F.col(value).alias("v"))))
        return F.transform(F.sort_array(found), lambda f: f["v"])

    diff = with_new_versions(diff, main_version)
    touched = F.count(F.when(F.col("status") != "unchanged", 1)) > 0
    return diff.groupBy(*by).agg(
        F.first(main_version).alias("base_main_version"),
        names("changed").alias("changed_files"),
        names("new").alias("new_files"),
        names("missing").alias("missing_files"),
        names("changed", "new_version").alias("changed_versions"),
        (~touched).alias("data_integrity_passed"),
        touched.alias("intentional_data_update"),
        F.when(touched, UPDATED_VERSION).otherwise(F.first(main_version)).alias("data_version"),
    )


def flatten_settings(runs: DataFrame, key: str = "run_name", settings: str = "settings") -> DataFrame:
    """Two-level settings as rows ``run_name, key, value`` with dotted keys."""
    sections = runs.select(key, F.explode(settings).alias("section", "values"))
    return sections.select(key, "section", F.explode("values").alias("name", "value")).select(
        key, F.concat_ws(".", "section", "name").alias("key"), F.col("value").cast("string").alias("value")
    )


def compare_settings(main: DataFrame, current: DataFrame, on: Sequence[str] = ("key",)) -> DataFrame:
    """Settings of two runs side by side: ``main, current, differs``."""
    a = main.select(*on, F.col("value").alias("main"))
    b = current.select(*on, F.col("value").alias("current"))
    return a.join(b, list(on), "full_outer").select(
        *on, "main", "current", (~F.col("main").eqNullSafe(F.col("current"))).alias("differs")
    )


# Sections whose kind is that of the main run; the others have that of the current one.
KIND_OF_MAIN = ("splitter", "vectordb")


def model_entries(main: DataFrame, current: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """Settings of two runs by section: ``current`` and ``main`` as maps, with ``type`` and ``storage``.

    Both have ``key, value`` with dotted keys, and the columns ``on`` that tell runs apart.
    """
    compared = compare_settings(main, current, on=(*on, "key"))
    named = compared.withColumn("section", F.substring_index("key", ".", 1)).withColumn("name", F.expr("substr(key, length(section) + 2)"))

    def values(side: str) -> Column:
        return F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col(side).isNotNull(), F.struct("name", side))))).alias(side)

    sections = named.groupBy(*on, "section").agg(values("current"), values("main"), F.bool_or("differs").alias("differs"))

    def kind(name: str) -> Column:
        of_main = F.col("section").isin(*KIND_OF_MAIN)
        return F.when(of_main, F.try_element_at("main", F.lit(name))).otherwise(F.try_element_at("current", F.lit(name))).alias(name)

    return sections.select("*", kind("type"), kind("storage"))


def parameter_rows(settings: DataFrame, manifest: DataFrame | None = None, system: DataFrame | None = None) -> DataFrame:
    """``run_name, key, value`` of all that is logged with a run: settings, data digests, and the system.

    ``settings`` and ``system`` are such rows; ``manifest`` has ``run_name, name, md5``.
    """
    rows = settings.select("run_name", "key", "value")
    if manifest is not None:
        rows = rows.unionByName(manifest.select("run_name", F.concat(F.lit("data."), "name").alias("key"), F.col("md5").alias("value")))
    if system is not None:
        rows = rows.unionByName(system.select("run_name", F.concat(F.lit("system."), "key").alias("key"), "value"))
    return rows


def stamped(entries: DataFrame, runs: DataFrame, on: Sequence[str] = (), commit: Column | None = None) -> DataFrame:
    """Log records with the ``run_name``, ``timestamp``, ``branch`` and ``commit`` of their run.

    ``runs`` has ``run_name, branch, ts`` and the columns ``on``; without any there is one run. A
    missing commit is ``unknown``.
    """
    known = F.coalesce(commit if commit is not None else F.lit(None).cast("string"), F.lit("unknown"))
    marks = runs.select(*on, "run_name", F.date_format("ts", "yyyyMMdd_HHmmss").alias("timestamp"), "branch", known.alias("commit")).distinct()
    if on:
        return marks.join(entries, list(on))
    one = marks.limit(1)
    return entries.select(*[one.select(c).scalar().alias(c) for c in ("run_name", "timestamp", "branch", "commit")], "*")


def run_name(branch: Column, ts: Column) -> Column:
    return F.concat(branch, F.lit("_run_"), F.date_format(ts, "yyyyMMdd_HHmmss"))


def is_compared(branch: Column) -> Column:
    """Whether runs of a branch are compared with the best main run."""
    return ~branch.isin(*BASE_BRANCHES)


def _score(value: Column | str = "value") -> Column:
    """A metric that counts: null and NaN are no score."""
    return F.nullif(F.col(value) if isinstance(value, str) else value, F.lit(float("nan")))


def best_run_per_branch(runs: DataFrame, metric: str = "recall") -> DataFrame:
    """Best run of every branch; the smaller run name wins a tie."""
    scored = runs.filter((F.col("metric") == metric) & _score().isNotNull())
    # negated value so that one minimum orders by value down and name up
    best = scored.groupBy("branch").agg(
        F.min(F.struct((-F.col("value")).alias("down"), "run_name")).alias("best")
    )
    return best.select("branch", F.col("best.run_name").alias("run_name"), (-F.col("best.down")).alias("value"))


def best_run(runs: DataFrame, metric: str = "recall", branch: str = "main") -> DataFrame:
    """The best run of one branch; no row when it has none."""
    scored = runs.filter((F.col("branch") == branch) & (F.col("metric") == metric) & _score().isNotNull())
    return scored.orderBy(F.col("value").desc(), "run_name").limit(1)


def promotion_decisions(candidates: DataFrame, runs: DataFrame, metric: str = "recall") -> DataFrame:
    """Whether each candidate run beats the best main run.

    Runs on the base branches are left out. Without a main run that has a score
    the baseline is 0, and a candidate without one is skipped.
    """
    # the maximum over no row is null, so there is always one baseline row
    main_runs = runs.filter((F.col("branch") == "main") & (F.col("metric") == metric))
    baseline = main_runs.agg(F.coalesce(F.max(_score()), F.lit(0.0)).alias("main_score")).scalar()
    compared = candidates.filter(is_compared(F.col("branch")) & (F.col("metric") == metric))
    scored = compared.withColumn("main_score", baseline)
    status = F.when(_score() > F.col("main_score"), "approved").otherwise("skipped")
    return scored.select(
        "run_name",
        status.alias("promotion_status"),
        "branch",
        "metric",
        "main_score",
        F.col("value").alias("new_score"),
    )


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest run of every branch."""
    newest = W.partitionBy("branch").orderBy(F.col("ts").desc(), F.col("run_name").desc())
    return runs.withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n")
