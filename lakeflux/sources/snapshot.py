"""Latest-published snapshot (S7): producers append a ``snapshot`` partition,
consumers read only the newest one."""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SNAPSHOT_COL = "snapshot"


def publish_snapshot(df: DataFrame, path: str, snapshot: str, extra_partitions: list[str] | None = None) -> None:
    """Write ``df`` as partition ``snapshot=<snapshot>``; other snapshots stay."""
    (
        df.withColumn(SNAPSHOT_COL, F.lit(snapshot))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SNAPSHOT_COL, *(extra_partitions or []))
        .parquet(path)
    )


def latest_snapshot(spark: SparkSession, path: str) -> str | None:
    """Name of the newest partition, from one listing of the table's folder; no data file is opened.

    Names that are all numbers are compared as numbers. Tables whose readers need a run date, or whose
    producers may be lost half way, keep a commit log: see ``snapshot_log``.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    entries = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    names = [e.getPath().getName() for e in entries if e.isDirectory()]
    found = [unquote(n.partition("=")[2]) for n in names if n.startswith(f"{SNAPSHOT_COL}=")]
    numbers = all(n.isdigit() for n in found)
    return max(found, key=lambda n: (int(n), n) if numbers else n, default=None)


def read_latest_snapshot(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Rows of the newest snapshot only.

    The newest partition's folder is the only one that is listed and scanned.
    Pass the schema (with ``snapshot`` as string) so partition values are not re-typed.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    latest = latest_snapshot(spark, path)
    if latest is None:
        raise FileNotFoundError(f"no {SNAPSHOT_COL}= partition in {path}")
    folder = quote(latest, safe=" !$&'()+,-.;<>@_`|~")
    return reader.option("basePath", path).parquet(f"{path.rstrip('/')}/{SNAPSHOT_COL}={folder}")
