"""Sinks: metrics, logs and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Per-query metrics as CSV with a header, ordered by query."""
    metrics.orderBy("query_id").write.mode(mode).option("header", True).csv(path)


def append_log(records: DataFrame, path: str) -> None:
    """Add records to a JSON-lines log; what is there is never rewritten."""
    records.write.mode("append").json(path)


def append_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def write_decision(decision: DataFrame, path: str, mode: str = "overwrite") -> None:
    decision.write.mode(mode).json(path)
