"""Shared helpers for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed ingestion time used by the queries so results are comparable.
AS_OF = "2024-02-01 00:00:00"
TS_TEXT = "yyyy-MM-dd HH:mm:ss"
RUN_ID = "run-0001"
# Reference/current cut for the drift queries (events cover January 2024).
DRIFT_CUT = "2024-01-16 00:00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(c) -> F.Column:
    return F.round(c, 6)


def as_text_ts(c) -> F.Column:
    return F.date_format(c, TS_TEXT)
