"""Incremental zone ingestion (M1, with S5 and K5).

Each new file in the landing folder is processed exactly once: a file stream
source with an explicit schema reads only files not yet recorded in the
checkpoint; ``trigger(availableNow=True)`` drains what is there and stops, so
a scheduled run is a bounded batch that survives restarts (the checkpoint,
on shared storage, records progress). ``cleanSource`` archives (or deletes)
processed landing files, which is the promotion step of the zone flow; Spark
does that in a later micro-batch, so files of the last batch stay until the
next run that brings new files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeflux.functions.jsonfmt import LOSSLESS_OPTIONS
from lakeflux.sinks.files import CSV_OPTIONS, CSV_READ_OPTIONS
from lakeflux.sources.files import MAX_RECORD_FILE_BYTES, POS_COL, explode_records, parse_record_files, rejected_files, relative_to, whole_files


def landing_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    clean_source: str = "archive",
    archive_dir: str | None = None,
    max_files_per_trigger: int | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """JSON-lines files. A broken line stops the run, and its files stay in the landing
    folder; ``mode="PERMISSIVE"`` with a ``_corrupt_record`` string in the schema keeps
    such lines as rows instead."""
    reader = (
        spark.readStream.schema(schema)
        .option("timestampNTZFormat", LOSSLESS_OPTIONS["timestampNTZFormat"])
        .option("cleanSource", clean_source)
        .option("mode", mode)
    )
    if clean_source == "archive":
        if not archive_dir:
            raise ValueError("cleanSource=archive needs archive_dir")
        reader = reader.option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(source)


def ingest_available(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
) -> dict:
    """Write everything currently available to ``target`` and stop; batches and rows of this run."""
    return _drain(stream, target, checkpoint, fmt, {}, partition_by)


def _committed(spark: SparkSession, checkpoint: str) -> int:
    """Batches that the checkpoint has recorded as done."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return max((int(n) + 1 for n in names if n.isdigit()), default=0)


#: Batches of a run whose progress is kept; a run of more raises, as its rows could not be told.
KEPT_PROGRESS = 10_000
_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"


def _drain(stream: DataFrame, target: str, checkpoint: str, fmt: str, options: dict[str, str], partition_by, read_options=None) -> dict:
    """Write what is available; batches from the checkpoint, rows as the stream observed them on their way to the sink,
    so a run costs nothing for what earlier runs have written."""
    spark = stream.sparkSession
    batches = _committed(spark, checkpoint)
    before = spark.conf.get(_PROGRESS, None)
    spark.conf.set(_PROGRESS, str(KEPT_PROGRESS))
    try:
        return _run(stream, target, checkpoint, fmt, options, partition_by, read_options or options, batches)
    finally:
        spark.conf.unset(_PROGRESS) if before is None else spark.conf.set(_PROGRESS, before)


def _run(stream, target, checkpoint, fmt, options, partition_by, read_options, batches) -> dict:
    spark = stream.sparkSession
    counted = stream.observe("lakeflux", F.count(F.lit(1)).alias("rows"))
    writer = counted.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.trigger(availableNow=True).start(target)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    done = _committed(spark, checkpoint) - batches
    if done > KEPT_PROGRESS:
        raise RuntimeError(f"{done} batches in one run: set maxFilesPerTrigger higher")
    seen = {p.batchId: p.observedMetrics["lakeflux"]["rows"] for p in query.recentProgress if "lakeflux" in p.observedMetrics}
    return {"batches": done, "rows": sum(seen.values())}


def landing_files_once(
    spark: SparkSession, source: str, schema: StructType, keep: str = "30 days", clean_source: str = "off", archive_dir: str | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Rows of JSON-lines files, each content once: a file that lands again, under its own name or another, adds nothing.

    Keyed streaming state holds the SHA-256 of every file's bytes, in the query's checkpoint, so it holds across
    restarts; a digest goes once ``keep`` has passed, by the files' own times of change, since it was last new. A
    file is one row until its digest is known, and one beyond ``MAX_RECORD_FILE_BYTES`` raises; so does a line that does not parse.
    """
    reader = spark.readStream.option("cleanSource", clean_source)
    if clean_source == "archive":
        if not archive_dir:
            raise ValueError("cleanSource=archive needs archive_dir")
        reader = reader.option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.text(source, wholetext=True).select("value", F.col("_metadata.file_modification_time").alias("changed"), F.col("_metadata.file_size").alias("bytes"))
    fine = F.when(F.col("bytes") <= MAX_RECORD_FILE_BYTES, F.col("value")).otherwise(F.raise_error(F.lit("file beyond the size limit")))
    keyed = raw.select(fine.alias("value"), "changed").withColumn("digest", F.sha2("value", 256))
    once = keyed.withWatermark("changed", keep).dropDuplicatesWithinWatermark(["digest"])
    lines = once.select(F.explode(F.split("value", "\n")).alias("line")).where(F.trim("line") != "")
    options = {"mode": "FAILFAST", "timestampNTZFormat": LOSSLESS_OPTIONS["timestampNTZFormat"]}
    return lines.select(F.from_json("line", schema, options).alias("r")).select("r.*")


def write_landing_json(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> str:
    """JSON-lines landing files with lossless timestamps (test fixture writer)."""
    writer = df.write.mode("append").options(**LOSSLESS_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)
    return path


def record_file_stream(
    spark: SparkSession,
    source: str,
    record_schema: StructType,
    clean_source: str = "archive",
    archive_dir: str | None = None,
) -> DataFrame:
    """New record files, parsed whole (stream form of S2), for ``explode_records`` and ``rejected_files``."""
    reader = spark.readStream.option("cleanSource", clean_source)
    if clean_source == "archive":
        if not archive_dir:
            raise ValueError("cleanSource=archive needs archive_dir")
        reader = reader.option("sourceArchiveDir", archive_dir)
    return parse_record_files(whole_files(reader, source), record_schema)


def curate_stream(
    spark: SparkSession,
    source: str,
    record_schema: StructType,
    curated: str,
    checkpoint: str,
    keep: Sequence[str] = ("title", "body"),
    n: int = 5,
    archive_dir: str | None = None,
    rejects: str | None = None,
) -> dict:
    """Incremental zone job: every new file's first ``n`` records, chosen columns,
    appended to the curated CSV folder (one folder per input file, by its path below
    the source).

    A broken file stops the run. With a ``rejects`` folder its name and reason are
    written there first, by a pass of its own with its own checkpoint, and the run goes on.
    """
    out = {"rejects": 0}
    if rejects is not None:
        seen = rejected_files(record_file_stream(spark, source, record_schema, "off"))
        out["rejects"] = _drain(seen, rejects, f"{checkpoint}-rejects", "parquet", {}, None)["rows"]
    parsed = record_file_stream(spark, source, record_schema, "archive" if archive_dir else "off", archive_dir)
    records = explode_records(parsed, "fail" if rejects is None else "reject")
    head = records.where(F.col(POS_COL) < n).select(relative_to(source).alias("source_file"), POS_COL, *keep)
    return out | _drain(head, curated, checkpoint, "csv", CSV_OPTIONS, ["source_file"], CSV_READ_OPTIONS)
