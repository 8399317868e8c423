"""Snapshots behind a commit log (S7): what a producer published, read as of a run date.

A table's folder holds ``data/<id>`` (one folder a snapshot, written whole by Spark) and a
commit log with an entry (run, data folder, schema, rows) a snapshot. A snapshot exists once
its entry does: a half-written one is never seen, and neither is one whose data folder lacks
Spark's mark. Two producers at the same time get versions of their own.

Runs are dates, or whole numbers, and are compared as such: 9 is before 10. Of several
snapshots of one run the one committed last counts. Readers open no data folder but the one
they read.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakeflux.sources import commit_log, store

DATA = "data"


def run_key(run: str | int | dt.date) -> tuple[int, int]:
    """Sort key of a run: a date (``date`` or yyyy-mm-dd) or a whole number; a table has one kind."""
    if isinstance(run, dt.datetime):
        raise TypeError("a run is a date or a whole number")
    if isinstance(run, dt.date):
        return 1, run.toordinal()
    text = str(run)
    if text.isdigit():
        return 0, int(text)
    return 1, dt.date.fromisoformat(text).toordinal()


def snapshots(spark: SparkSession, table: str) -> list[dict]:
    """Entries (version, run, data, rows, schema) of all snapshots, by version."""
    return commit_log.entries(spark, table)


def publish(df: DataFrame, table: str, run: str | int | dt.date, partition_by: list[str] | None = None) -> int:
    """Write ``df`` as the snapshot of a run and commit it; the version it got. Earlier snapshots stay."""
    spark, key = df.sparkSession, run_key(run)
    known = commit_log.entries(spark, table)
    if any(run_key(e["run"])[0] != key[0] for e in known):
        raise ValueError(f"runs of {table} are {'numbers' if key[0] else 'dates'}")
    folder = f"{DATA}/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{table}/{folder}")
    rows = spark.read.schema(df.schema).parquet(f"{table}/{folder}").count()
    entry = {"run": str(run), "data": folder, "rows": rows, "schema": json.loads(df.schema.json())}
    return commit_log.commit(spark, table, entry, commit_log.newest(known))


def find(spark: SparkSession, table: str, as_of: str | int | dt.date | None = None) -> dict | None:
    """Entry of the newest snapshot whose run is not after ``as_of`` (None: of all); None if there is none."""
    until = None if as_of is None else run_key(as_of)
    entries = [e for e in snapshots(spark, table) if until is None or run_key(e["run"]) <= until]
    for entry in sorted(entries, key=lambda e: (run_key(e["run"]), e["version"]), reverse=True):
        if store.exists(spark, f"{table}/{entry['data']}/_SUCCESS"):
            return entry
    return None


def read_as_of(spark: SparkSession, table: str, as_of: str | int | dt.date | None = None) -> DataFrame:
    """Rows of the newest snapshot whose run is not after ``as_of``, with the schema they were written with."""
    entry = find(spark, table, as_of)
    if entry is None:
        raise FileNotFoundError(f"no snapshot in {table}" + ("" if as_of is None else f" as of {as_of}"))
    return spark.read.schema(StructType.fromJson(entry["schema"])).parquet(f"{table}/{entry['data']}")


def vacuum(spark: SparkSession, table: str, keep_runs: int | None = None) -> list[str]:
    """Delete data folders that no entry names (runs that were lost) and, with keep_runs, those of all but so many newest
    runs; their names. No producer may be writing meanwhile."""
    entries = snapshots(spark, table)
    runs = sorted({run_key(e["run"]) for e in entries}, reverse=True)
    kept = {e["data"] for e in entries if keep_runs is None or run_key(e["run"]) in runs[:keep_runs]}
    gone = [n for n in store.names(spark, f"{table}/{DATA}") if f"{DATA}/{n}" not in kept]
    for n in gone:
        store.delete(spark, f"{table}/{DATA}/{n}")
    return gone
