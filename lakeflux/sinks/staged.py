"""Warehouse files behind a commit (K1, K4): tasks stage, the driver commits or aborts.

A Python data source, ``lakeflux_staged``. Each task attempt writes one Parquet file under a
name of its own to ``_staging/<job>`` and reports it in its commit message. Spark hands the
messages of the attempts that count to ``commit``: their files move to ``data/<job>``, and one
entry of the table's commit log names them. Readers see files of entries only, so a failed
job, a lost attempt or a speculative twin leaves nothing that is read, and no half target.
``overwrite`` is an entry that ends what stood before it; the old files stay readable to whoever
has already begun, until ``vacuum``. A write that carries a ``batch`` the log has seen adds
nothing: a job that is run again after its commit was lost sight of delivers once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from lakeflux.sources import commit_log, store

FORMAT = "lakeflux_staged"
DATA, STAGING = "data", "_staging"


@dataclass
class Staged(WriterCommitMessage):
    """A file that a task attempt has written whole; no name if it had no row."""

    name: str | None
    rows: int


class StagedSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return StagedWriter(self.options["path"], schema, overwrite, self.options.get("batch"))


class StagedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool, batch: str | None):
        self.path, self.schema, self.overwrite, self.batch = path.rstrip("/"), schema.json(), overwrite, batch
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        context = TaskContext.get()
        client, root = store.open_store(self.path)
        folder, rows, writer = f"{root}/{STAGING}/{self.job}", 0, None
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}.parquet"
        try:
            for batch in iterator:
                if writer is None:
                    client.create_dir(folder, recursive=True)
                    writer = pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=client)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Staged(name if writer is not None else None, rows)

    def commit(self, messages: list[Staged | None]) -> None:
        client, root = store.open_store(self.path)
        entries = _entries(client, root)
        if self.batch is not None and any(e.get("batch") == self.batch for e in entries):
            self.abort(messages)
            return
        kept = [m for m in messages if m is not None and m.name is not None]
        if kept:
            client.create_dir(f"{root}/{DATA}", recursive=True)
            client.move(f"{root}/{STAGING}/{self.job}", f"{root}/{DATA}/{self.job}")
        entry = {
            "files": [f"{DATA}/{self.job}/{m.name}" for m in kept], "rows": sum(m.rows for m in kept), "overwrite": self.overwrite,
            "batch": self.batch, "schema": json.loads(self.schema),
        }
        client.create_dir(f"{root}/{commit_log.LOG}", recursive=True)
        after = commit_log.newest(entries)
        for version in range(after + 1, after + 1 + commit_log.ATTEMPTS):
            if store.create_new(client, f"{root}/{commit_log.LOG}/{version:020d}.json", json.dumps(entry | {"version": version})):
                return
        raise RuntimeError(f"no free version in {self.path}")

    def abort(self, messages: list[Staged | None]) -> None:
        client, root = store.open_store(self.path)
        if client.get_file_info(f"{root}/{STAGING}/{self.job}").type == fs.FileType.Directory:
            client.delete_dir(f"{root}/{STAGING}/{self.job}")


def _entries(client, root: str) -> list[dict]:
    """The log as the committing process sees it, which has no Spark session."""
    folder = f"{root}/{commit_log.LOG}"
    if client.get_file_info(folder).type == fs.FileType.NotFound:
        return []
    found = [f.path for f in client.get_file_info(fs.FileSelector(folder)) if f.base_name.endswith(".json") and f.base_name[:-5].isdigit()]
    out = []
    for path in sorted(found):
        with client.open_input_stream(path) as f:
            out.append(json.loads(f.read()))
    return out


def write_staged(df: DataFrame, path: str, mode: str = "append", batch: str | None = None) -> str:
    """Write ``df`` to a table behind a commit; ``batch`` names the write, so that it counts once."""
    spark = df.sparkSession
    spark.dataSource.register(StagedSink)
    target = store.qualified(spark, path)
    writer = df.write.format(FORMAT).mode(mode).option("path", target)
    if batch is not None:
        writer = writer.option("batch", batch)
    writer.save()
    return target


def _live(entries: list[dict]) -> list[dict]:
    start = max((i for i, e in enumerate(entries) if e["overwrite"]), default=0)
    return entries[start:]


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the committed files, with the schema of the last write."""
    target = store.qualified(spark, path)
    live = _live(commit_log.entries(spark, target))
    if not live:
        raise FileNotFoundError(f"nothing was committed to {path}")
    schema = StructType.fromJson(live[-1]["schema"])
    files = [f"{target}/{f}" for e in live for f in e["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete what no live entry names: staging of lost jobs, files that an overwrite ended; the jobs' names. No writer or reader of old files may be at work."""
    target = store.qualified(spark, path)
    kept = {f.split("/")[1] for e in _live(commit_log.entries(spark, target)) for f in e["files"]}
    gone = []
    for folder in (DATA, STAGING):
        for job in store.names(spark, f"{target}/{folder}"):
            if folder == STAGING or job not in kept:
                store.delete(spark, f"{target}/{folder}/{job}")
                gone.append(job)
    return gone
