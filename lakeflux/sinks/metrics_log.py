"""Metrics log with keys (K6): one value a (run_id, metric), whichever run wrote it last.

Every write is a folder of its own behind a commit log; its version is the commit's. Readers
fold the live folders by ``max_by(value, version)``, so a run that is retried replaces its own
values and nothing else. ``compact`` writes the folded rows as one folder that takes the place
of those it has read; a write committed meanwhile stays beside it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeflux.sources import commit_log

SCHEMA = "run_id string, metric string, value double, version long"
#: Live folders beyond which a write compacts the log.
MOST_FOLDERS = 20
KEY = ["run_id", "metric"]


def _live(entries: list[dict]) -> dict[str, int]:
    """Data folders that count, with their versions."""
    gone = {d for e in entries for d in e.get("replaces", [])}
    return {e["data"]: e["version"] for e in entries if e["data"] not in gone}


def upsert_metrics(metrics: DataFrame, table: str) -> int:
    """Write (run_id, metric, value); a key that is there already gets the new value. The version it got.

    A key that stands twice in one write raises: which value holds would be chance.
    """
    spark = metrics.sparkSession
    rows = metrics.select("run_id", "metric", F.col("value").cast("double").alias("value"), F.lit(None).cast("long").alias("version"))
    folder = f"data/{uuid.uuid4().hex}"
    rows.write.parquet(f"{table}/{folder}")
    twice = spark.read.schema(SCHEMA).parquet(f"{table}/{folder}").groupBy(*KEY).count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"metric {twice.metric!r} of run {twice.run_id!r} stands {twice['count']} times in one write")
    known = commit_log.entries(spark, table)
    version = commit_log.commit(spark, table, {"data": folder}, commit_log.newest(known))
    if len(_live(known)) >= MOST_FOLDERS:
        compact(spark, table)
    return version


def _rows(spark: SparkSession, table: str, live: dict[str, int]) -> DataFrame:
    if not live:
        return spark.createDataFrame([], SCHEMA)
    read = spark.read.schema(SCHEMA).parquet(*[f"{table}/{d}" for d in live])
    versions = spark.createDataFrame([(d.partition("/")[2], v) for d, v in live.items()], "folder string, committed long")
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/data/([0-9a-f]{32})/", 1)
    # a row a live folder: bounded by compaction
    placed = read.withColumn("folder", folder).join(F.broadcast(versions), "folder")
    return placed.select("run_id", "metric", "value", F.coalesce("version", "committed").alias("version"))


def _folded(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.max_by("value", "version").alias("value"), F.max("version").alias("version"))


def metrics_latest(spark: SparkSession, table: str) -> DataFrame:
    """(run_id, metric, value): one row a key."""
    return _folded(_rows(spark, table, _live(commit_log.entries(spark, table)))).select(*KEY, "value")


def compact(spark: SparkSession, table: str) -> int:
    """Replace the live folders by one of their folded rows; the version it got."""
    known = commit_log.entries(spark, table)
    live = _live(known)
    folder = f"data/{uuid.uuid4().hex}"
    _folded(_rows(spark, table, live)).coalesce(1).write.parquet(f"{table}/{folder}")
    return commit_log.commit(spark, table, {"data": folder, "replaces": sorted(live)}, commit_log.newest(known))
