"""A table's commit log: small entries in ``_log``, one a version, each created whole by one writer only.

``<table>/_log/<version>.json`` is created with the next free version; a writer that finds it
taken takes the one after, so versions have no gaps and every reader sees the same order.
Every ``CHECKPOINT`` versions the entries so far are also written as one file.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from lakeflux.sources import store

LOG = "_log"
CHECKPOINT = 50
#: Writers that may commit between a writer's look at the log and its own commit, before it gives up.
ATTEMPTS = 1000


def _name(version: int) -> str:
    return f"{version:020d}.json"


def entries(spark: SparkSession, table: str) -> list[dict]:
    """All entries, by version: the last checkpoint's and those behind it."""
    names = store.names(spark, f"{table}/{LOG}")
    versions = sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())
    marks = sorted(int(n.split(".")[0]) for n in names if n.endswith(".checkpoint"))
    found = json.loads(store.read_text(spark, f"{table}/{LOG}/{marks[-1]:020d}.checkpoint")) if marks else []
    after = marks[-1] if marks else -1
    return found + [json.loads(store.read_text(spark, f"{table}/{LOG}/{_name(v)}")) for v in versions if v > after]


def commit(spark: SparkSession, table: str, entry: dict, after: int) -> int:
    """Add an entry behind the version that the writer has seen; the version it got."""
    for version in range(after + 1, after + 1 + ATTEMPTS):
        if store.write_new(spark, f"{table}/{LOG}/{_name(version)}", json.dumps(entry | {"version": version})):
            break
    else:
        raise RuntimeError(f"no free version in {table}")
    if version % CHECKPOINT == CHECKPOINT - 1:  # all lower versions are there
        found = [e for e in entries(spark, table) if e["version"] <= version]
        store.write_new(spark, f"{table}/{LOG}/{version:020d}.checkpoint", json.dumps(found))
    return version


def newest(found: list[dict]) -> int:
    return max((e["version"] for e in found), default=-1)
