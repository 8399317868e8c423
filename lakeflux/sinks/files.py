"""File sinks: zone CSV (K2), Parquet replace (K3), feature-set publish (K7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lakeflux.sources.snapshot import publish_snapshot

# CSV options that make quotes, backslashes and line breaks round-trip the way
# a pandas ``to_csv`` does (quotes doubled, fields with breaks quoted). Empty
# strings are written as "" and nulls as nothing, so both survive a read.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
}
# Reading: an unquoted empty field is null, a quoted "" is the empty string
# (a null marker no text uses keeps the two apart).
CSV_READ_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "nullValue": "\u0000"}


def write_zone_csv(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, mode: str = "overwrite") -> str:
    """Header CSV, no index (K2). Returns the written path."""
    writer = df.write.mode(mode).options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
    return path


def write_parquet_replace(df: DataFrame, path: str) -> str:
    """Parquet, replacing what is there (K3)."""
    df.write.mode("overwrite").parquet(path)
    return path


def publish_feature_set(df: DataFrame, path: str, split_col: str = "split", snapshot: str = "00000000") -> str:
    """One table partitioned by snapshot and split (K7): train and test, features and
    label together; earlier snapshots stay, readers take the newest and prune on ``split``."""
    publish_snapshot(df, path, snapshot, [split_col])
    return path
