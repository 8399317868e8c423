"""Zone promotion (K5): landing files to the next zone, byte by byte, under a commit manifest.

A run goes through four steps, and whatever step it is lost in, the next run goes on from there:

1. tasks copy every file that no manifest has yet to ``_staging/<run>``, each attempt under a
   name of its own that is renamed when it is whole; a copy of another length than listed fails;
2. the copies' rows (file, stored, bytes, sha256, ...) are written as the run's manifest, whose
   ``_SUCCESS`` mark, put last by Spark's committer, is the commit;
3. tasks move the staged files to the date folder, and the run is marked published;
4. with ``delete_source``, tasks delete the landing files that are still what was copied.

Before it lists anything, a run publishes what an earlier one committed and drops what an
earlier one only staged. The date folder therefore never holds a partial file, and none twice.
Folders that begin with an underscore are not seen by Spark's readers. One run at a time may
work on a date folder.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeflux.sources import store
from lakeflux.sources.files import dated_prefix, relative_to

MANIFESTS, STAGING, PUBLISHED = "_promoted", "_staging", "_published"
#: Bytes of landing files that a task copies, about.
TASK_BYTES = 256 << 20
#: Characters of the landing path that a stored name keeps; its digest keeps names apart.
READABLE = 120
_ENTRY = "file string, stored string, path string, bytes long, modified long, sha256 string"


def _runs(spark: SparkSession, target: str) -> list[str]:
    """Committed runs of a date folder, oldest first."""
    folder = f"{target}/{MANIFESTS}"
    return [n for n in store.names(spark, folder) if n.startswith("run=") and store.exists(spark, f"{folder}/{n}/_SUCCESS")]


def manifest(spark: SparkSession, target: str, runs: list[str] | None = None) -> DataFrame:
    """(file, stored, path, bytes, modified, sha256) of what the committed runs promoted to a date folder."""
    found = _runs(spark, target) if runs is None else runs
    if not found:
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).parquet(*[f"{target}/{MANIFESTS}/{r}" for r in found])


def _each(rows: DataFrame, act: Callable[[fs.FileSystem | None, dict], dict | None], schema: str, tasks: int) -> DataFrame:
    """Rows that ``act`` gives for each row, in about so many tasks (never coalesced, as rows are small and their work is not)."""
    columns = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = act(row)
                if out is not None:
                    yield pa.RecordBatch.from_pylist([{c: out[c] for c in columns}], fields)

    fields = pa.schema([(f.split(" ")[0], {"string": pa.string(), "long": pa.int64()}[f.split(" ")[1]]) for f in schema.split(", ")])
    return rows.repartition(max(1, tasks), "path").mapInArrow(run, schema)


def _copy_to(staging: str):
    def act(row: dict) -> dict:
        (source, path), (target, root) = store.open_store(row["path"]), store.open_store(staging)
        target.create_dir(root, recursive=True)
        attempt, digest, n = f"{root}/{row['stored']}.{TaskContext.get().taskAttemptId()}", hashlib.sha256(), 0
        with source.open_input_stream(path) as i, target.open_output_stream(attempt) as o:
            while part := i.read(store.COPY_BYTES):
                o.write(part)
                digest.update(part)
                n += len(part)
        if n != row["bytes"]:
            target.delete_file(attempt)
            raise OSError(f"{row['path']} changed while it was copied: {n} bytes, {row['bytes']} listed")
        _rename(target, attempt, f"{root}/{row['stored']}")
        return row | {"sha256": digest.hexdigest()}

    return act


def _rename(client: fs.FileSystem, source: str, target: str) -> None:
    """Rename; a copy of the same file that another attempt put there gives way."""
    try:
        client.move(source, target)
    except OSError:
        if client.get_file_info(target).type == fs.FileType.NotFound:
            raise
        client.delete_file(target)
        client.move(source, target)


def _move_from(staging: str, folder: str):
    def act(row: dict) -> dict:
        client, root = store.open_store(staging)
        target = f"{store.open_store(folder)[1]}/{row['stored']}"
        staged = f"{root}/{row['stored']}"
        if client.get_file_info(staged).type != fs.FileType.NotFound:
            _rename(client, staged, target)
        info = client.get_file_info(target)  # an earlier attempt may have moved it
        if info.type != fs.FileType.File or info.size != row["bytes"]:
            raise OSError(f"{row['stored']} is not in {folder} with {row['bytes']} bytes")
        return {"path": row["path"]}

    return act


def _delete_unchanged(row: dict) -> dict:
    client, path = store.open_store(row["path"])
    info = client.get_file_info(path)
    same = info.type == fs.FileType.File and info.size == row["bytes"] and info.mtime_ns // 1_000_000 == row["modified"]
    if same:
        client.delete_file(path)
    return {"path": row["path"], "deleted": int(same)}


def _tasks(spark: SparkSession, n_files: int, n_bytes: int) -> int:
    return min(n_files, max(spark.sparkContext.defaultParallelism, -(-n_bytes // TASK_BYTES)))


def _publish(spark: SparkSession, target: str, run: str) -> None:
    entries = manifest(spark, target, [run])
    n = entries.count()
    _each(entries, _move_from(f"{target}/{STAGING}/{run}", target), "path string", _tasks(spark, n, 0)).count()
    store.write_new(spark, f"{target}/{MANIFESTS}/{run}/{PUBLISHED}", "")
    store.delete(spark, f"{target}/{STAGING}/{run}")


def recover(spark: SparkSession, target: str) -> dict[str, list[str]]:
    """Publish committed runs that were not published, drop the staging folders and manifests of others; the names of both."""
    done, folder = _runs(spark, target), f"{target}/{MANIFESTS}"
    late = [r for r in done if not store.exists(spark, f"{folder}/{r}/{PUBLISHED}")]
    for run in late:
        _publish(spark, target, run)
    lost = sorted({*store.names(spark, f"{target}/{STAGING}"), *store.names(spark, folder)} - {*done})
    for run in lost:
        store.delete(spark, f"{target}/{STAGING}/{run}")
        store.delete(spark, f"{folder}/{run}")
    return {"published": late, "dropped": lost}


def stored_name(stamp: str, below: Column) -> Column:
    """``business-<stamp>-<readable path>-<digest>.json``: one name a landing path, found by readers of ``*.json``."""
    plain = F.substring(F.regexp_replace(F.regexp_replace(below, r"\.json$", ""), "[^A-Za-z0-9._-]", "_"), 1, READABLE)
    return F.concat(F.lit(f"business-{stamp}-"), plain, F.lit("-"), F.substring(F.md5(below), 1, 8), F.lit(".json"))


def promote(
    spark: SparkSession, landing: str, processing: str, ds: str, as_of: Column | None = None, glob: str | None = "*.json", delete_source: bool = False
) -> DataFrame:
    """Every file of the landing folder that is new, byte for byte, to ``<processing>/business/<ds>``.

    Returns the run's manifest: (file, stored, path, bytes, modified, sha256), file below the landing folder. A file
    counts as known by path, length and time of change, so a run over the same files copies nothing. Empty files and
    files of any bytes are files like others. The run's stamp is taken once, so names are those that were written.
    """
    target = store.qualified(spark, dated_prefix(processing, "business", ds))
    recover(spark, target)
    stamp = spark.range(1).select(F.date_format(as_of if as_of is not None else F.current_timestamp(), "yyyyMMddHHmmss")).first()[0]
    root = store.qualified(spark, landing)
    found = store.list_files(spark, root, glob).withColumn("file", relative_to(root, "path"))
    new = found.join(manifest(spark, target).select("path", "bytes", "modified"), ["path", "bytes", "modified"], "left_anti")
    size = new.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    if not size.n:
        return spark.createDataFrame([], _ENTRY)
    run = f"run={stamp}-{uuid.uuid4().hex[:8]}"
    named = new.select("file", stored_name(stamp, F.col("file")).alias("stored"), "path", "bytes", "modified")
    copies = _each(named, _copy_to(f"{target}/{STAGING}/{run}"), _ENTRY, _tasks(spark, size.n, size.bytes))
    copies.write.parquet(f"{target}/{MANIFESTS}/{run}")
    _publish(spark, target, run)
    entries = manifest(spark, target, [run])
    if delete_source:
        _each(entries, _delete_unchanged, "path string, deleted long", _tasks(spark, size.n, 0)).count()
    return entries
