"""File sources."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from lakeflux.sources import store

#: A record file is one string and one array in a task's memory.
MAX_RECORD_FILE_BYTES = 256 << 20
FILE_COL = "file"
POS_COL = "pos"


def whole_files(reader, path: str) -> DataFrame:
    """(file, bytes, value): one row per file, from a batch or stream reader."""
    raw = reader.text(path, wholetext=True)  # an option of that name would give way to the argument's default
    return raw.select(F.col("_metadata.file_path").alias(FILE_COL), F.col("_metadata.file_size").alias("bytes"), "value")


def unread_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True, max_bytes: int | None = None) -> DataFrame:
    """(file, bytes, value) of files that a scan does not read: those without a byte, which Spark leaves out, and
    those beyond max_bytes. Value is empty."""
    size = F.col("bytes")
    found = store.list_files(spark, path, glob, recursive).where((size == 0) | (size > max_bytes if max_bytes else F.lit(False)))
    file = F.regexp_replace("path", "^file:/+", "file:///")  # as Spark's metadata has it
    return found.select(file.alias(FILE_COL), F.col("bytes"), F.lit("").alias("value"))


def parse_record_files(raw: DataFrame, schema: StructType, max_bytes: int = MAX_RECORD_FILE_BYTES) -> DataFrame:
    """(file, reason, __records): reason is null where the file holds one well-formed array of records."""
    records = F.from_json("value", ArrayType(schema))
    reason = F.when(F.col("bytes") > max_bytes, f"larger than {max_bytes} bytes").when(records.isNull(), "not an array of records")
    return raw.select(FILE_COL, reason.alias("reason"), records.alias("__records"))


def explode_records(parsed: DataFrame, on_bad: str = "fail") -> DataFrame:
    """``file, pos, <fields>`` of parsed files. A broken file raises (``fail``) or is left
    to ``rejected_files`` (``reject``); none goes unnoticed."""
    if on_bad not in ("fail", "reject"):
        raise ValueError("on_bad is fail or reject")
    if on_bad == "fail":
        stop = F.raise_error(F.concat(F.lit("broken record file "), FILE_COL, F.lit(": "), "reason"))
        parsed = parsed.withColumn("__records", F.when(F.col("reason").isNull(), F.col("__records")).otherwise(stop))
    else:
        parsed = parsed.where(F.col("reason").isNull())
    return parsed.select(FILE_COL, F.posexplode("__records").alias(POS_COL, "__r")).select(FILE_COL, POS_COL, "__r.*")


def rejected_files(parsed: DataFrame) -> DataFrame:
    """(file, reason) of every file that gives no records."""
    return parsed.where(F.col("reason").isNotNull()).select(FILE_COL, "reason")


def record_files(
    spark: SparkSession, path: str, schema: StructType, glob: str | None = "*.json", recursive: bool = True, max_bytes: int = MAX_RECORD_FILE_BYTES
) -> DataFrame:
    """Parsed record files below a path, for ``explode_records`` and ``rejected_files``. Larger files are told by the
    listing and never read."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    read = whole_files(reader, path).where(F.col("bytes") <= max_bytes)
    return parse_record_files(read.unionByName(unread_files(spark, path, glob, recursive, max_bytes)), schema, max_bytes)


def read_record_arrays(
    spark: SparkSession,
    path: str,
    schema: StructType,
    glob: str | None = "*.json",
    recursive: bool = True,
    on_bad: str = "fail",
) -> DataFrame:
    """Files that each hold one JSON array of records.

    Each file is read whole (one row per file, ``wholetext``), parsed with an
    explicit schema (text that looks like a number stays text) and exploded
    with its position, giving ``file, pos, <fields>``. Files are the unit of
    parallelism, so files beyond ``MAX_RECORD_FILE_BYTES`` count as broken.
    """
    return explode_records(record_files(spark, path, schema, glob, recursive), on_bad)


def relative_to(root: str, c: str = FILE_COL) -> Column:
    """A file's path below ``root`` (its folder up to the first wildcard): unlike the
    base name, no two files share it."""
    base = re.split(r"[*?{\[]", root, maxsplit=1)[0]
    if base != root:
        base = base.rpartition("/")[0]
    base = re.sub(r"^[a-z0-9+.-]+:/*", "/", base).rstrip("/")
    return F.regexp_replace(F.col(c), f"^[a-z0-9+.-]+:/*(?:[^/]+/)*?{re.escape(base.lstrip('/'))}/", "")


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet object scan (S3); selected columns reach the scan's ReadSchema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def lake_table_path(root: str, owner: str, table: str) -> str:
    return f"{root.rstrip('/')}/{owner}/{table}"


def read_lake_table(spark: SparkSession, root: str, owner: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Curated lake table ``<root>/<owner>/<table>`` (S4); ``fmt`` parquet or delta."""
    return spark.read.format(fmt).load(lake_table_path(root, owner, table))


def dated_files(spark: SparkSession, root: str, zone_prefix: str, ds: str, glob: str = "*.json") -> list[str]:
    """Files of one run date (S5), by name; one folder's listing. A date without a folder has none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{dated_prefix(root, zone_prefix, ds)}/{glob}")
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(folder)
    return sorted(str(f.getPath()) for f in found or [] if f.isFile())


def dated_prefix(root: str, zone_prefix: str, ds: str) -> str:
    """``<root>/<prefix>/<yyyymmdd>`` folder of one run date."""
    return f"{root.rstrip('/')}/{zone_prefix}/{ds}"


def literal_table(spark: SparkSession, rows: list, schema: StructType | str) -> DataFrame:
    """Small literal table from in-memory records."""
    return spark.createDataFrame(rows, schema)
