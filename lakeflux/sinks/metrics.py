"""Metrics log (K6): long table (run_id, metric, value), appended."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_metrics(metrics: DataFrame, path: str) -> str:
    metrics.select("run_id", "metric", "value").write.mode("append").parquet(path)
    return path
