"""From the metrics of a run to log records and a promotion decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrank.operators import evaluate, tracking
from sparkrank.sources import writers


def run_rows(metrics: DataFrame, branch: Column, ts: Column) -> DataFrame:
    """The run record of per-query metrics: its name and mean recall."""
    means = evaluate.mean_metrics(metrics)
    return means.select(
        tracking.run_name(branch, ts).alias("run_name"),
        branch.alias("branch"),
        ts.alias("ts"),
        F.lit("recall").alias("metric"),
        F.col("recall").alias("value"),
    )


def decide(
    candidates: DataFrame,
    runs: DataFrame,
    main_manifest: DataFrame,
    current_manifest: DataFrame,
    main_version: Column,
) -> DataFrame:
    """Promotion decisions with the state of the data they were made on."""
    diff = tracking.compare_manifests(main_manifest, current_manifest)
    passed = tracking.integrity(diff).select("data_integrity_passed").scalar()
    decisions = tracking.promotion_decisions(candidates, runs)
    marked = decisions.withColumn("data_integrity_passed", passed)
    return marked.withColumns(
        {
            "intentional_data_update": ~F.col("data_integrity_passed"),
            "data_version": F.when(F.col("data_integrity_passed"), main_version).otherwise(
                tracking.UPDATED_VERSION
            ),
        }
    )


def track_and_promote(
    run: DataFrame,
    settings: DataFrame,
    runs_path: str,
    main_manifest: DataFrame,
    current_manifest: DataFrame,
    main_settings: DataFrame,
    main_version: Column,
    folder: str,
    commit: Column | None = None,
    manifest: DataFrame | None = None,
    system: DataFrame | None = None,
) -> DataFrame:
    """Log one run, compare it with main, write the decision and return it.

    The logs carry the run's name, time, branch and ``commit``; its parameters are the settings, the
    digests of ``manifest`` (``run_name, name, md5``) and the rows of ``system``.

    ``runs_path`` is the table of earlier runs; ``settings`` and
    ``main_settings`` are ``run_name, key, value`` and ``key, value`` rows.
    The decision is made before the run joins the table, so a run is never
    compared with itself.
    """
    spark = run.sparkSession
    runs = spark.read.parquet(runs_path)
    decision = decide(run, runs, main_manifest, current_manifest, main_version)
    writers.write_decision(decision, f"{folder}/promotion")
    compared = run.select(F.max(tracking.is_compared(F.col("branch")))).scalar()
    diff = tracking.compare_manifests(main_manifest, current_manifest)
    entry = tracking.version_entries(diff, main_version).filter(compared)
    writers.append_log(tracking.stamped(entry, run, commit=commit), f"{folder}/version_log")
    models = tracking.compare_settings(main_settings, settings).filter(compared)
    writers.append_log(tracking.stamped(models, run, commit=commit), f"{folder}/model_version_log")
    sections = tracking.model_entries(main_settings, settings).filter(compared)
    writers.append_log(tracking.stamped(sections, run, commit=commit), f"{folder}/section_log")
    writers.append_table(tracking.parameter_rows(settings, manifest, system), f"{folder}/run_params")
    writers.append_table(run, runs_path)
    return spark.read.json(f"{folder}/promotion", schema=decision.schema)
