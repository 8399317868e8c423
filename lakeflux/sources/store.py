"""Files of a store as tasks and the driver see them: listing through Spark, bytes through the store's own client.

Spark's readers and writers own the names and the framing of what they write. Copying files
byte by byte, renaming and deleting them need the store itself: ``open_store`` gives a
client (pyarrow's) that tasks can use, for local, HDFS, S3 and other URIs; the driver's
small steps (markers, listings) go through Spark's own Hadoop client.
"""

from __future__ import annotations

import fnmatch
import os
import re
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: How much is copied at a time.
COPY_BYTES = 8 << 20


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as Spark resolves it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(hadoop_conf(spark)).makeQualified(p).toString()


def hadoop_conf(spark: SparkSession):
    return spark.sparkContext._jsc.hadoopConfiguration()


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """(client, path) of a qualified path; the path is taken as it is, without decoding."""
    scheme, authority, path = re.fullmatch(r"(?:([a-z][a-z0-9+.-]*):)?(?://([^/]*))?(.*)", uri, re.S).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), path
    client, base = fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme) }://{authority or ''}/")
    return client, base.rstrip("/") + path


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, bytes, modified) of every file below a path (which may hold wildcards), by the store's own listing.

    Spark's file scans leave empty files out; these are files like others here. The driver lists the first level,
    tasks walk what lies below it; names that begin with ``_`` or ``.`` are left out, as Spark does. modified: milliseconds.
    """
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop = top.getFileSystem(hadoop_conf(spark))
    rows = []
    for root in hadoop.globStatus(top) or []:
        for f in hadoop.listStatus(root.getPath()) if root.isDirectory() else [root]:
            if not _hidden(f.getPath().getName()):
                rows.append((f.getPath().toString(), None if f.isDirectory() else f.getLen(), f.getModificationTime()))
    folders = [(p,) for p, n, _ in rows if n is None]
    files = spark.createDataFrame([r for r in rows if r[1] is not None and (not glob or fnmatch.fnmatchcase(r[0].rpartition("/")[2], glob))], LISTED)
    if not recursive or not folders:
        return files

    def walk(batches):
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                client, base = open_store(folder)
                found = [
                    (folder + f.path[len(base) :], f.size, f.mtime_ns // 1_000_000)
                    for f in client.get_file_info(fs.FileSelector(base, recursive=True))
                    if f.type == fs.FileType.File and not any(map(_hidden, f.path[len(base) + 1 :].split("/"))) and (not glob or fnmatch.fnmatchcase(f.base_name, glob))
                ]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["path", "bytes", "modified"])

    return files.union(spark.createDataFrame(folders, "path string").repartition(min(len(folders), 4 * spark.sparkContext.defaultParallelism)).mapInArrow(walk, LISTED))


LISTED = "path string, bytes long, modified long"


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(hadoop_conf(spark)).exists(p))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(hadoop_conf(spark))
    return sorted(f.getPath().getName() for f in store.listStatus(p)) if store.exists(p) else []


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole or not at all; False where another writer was first.

    The text is written under a name of its own and renamed, which no store client lets replace an existing file.
    """
    jvm = spark.sparkContext._jvm
    Path, Rename = jvm.org.apache.hadoop.fs.Path, getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    p = Path(path)
    attempt = Path(p.getParent(), f"_attempt-{jvm.java.util.UUID.randomUUID().toString()}")
    store = p.getFileSystem(hadoop_conf(spark))
    out = store.create(attempt, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    none = spark.sparkContext._gateway.new_array(Rename, 1)
    none[0] = Rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), hadoop_conf(spark)).rename(store.makeQualified(attempt), store.makeQualified(p), none)
    except Exception as e:
        store.delete(attempt, False)
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    return True


def create_new(client: fs.FileSystem, path: str, text: str) -> bool:
    """``write_new`` for a process without a Spark session; False where the file is there.

    Local files are linked into place and HDFS does not rename onto a file, so one writer wins. Object stores
    have no such step: there one writer at a time may commit to a table.
    """
    attempt = f"{path.rpartition('/')[0]}/_attempt-{uuid.uuid4().hex}"
    with client.open_output_stream(attempt) as out:
        out.write(text.encode("utf-8"))
    try:
        if isinstance(client, fs.LocalFileSystem):
            os.link(attempt, path)
            client.delete_file(attempt)
        else:
            if client.get_file_info(path).type != fs.FileType.NotFound:
                raise FileExistsError(path)
            client.move(attempt, path)
    except OSError:
        if client.get_file_info(attempt).type != fs.FileType.NotFound:
            client.delete_file(attempt)
        if client.get_file_info(path).type == fs.FileType.NotFound:
            raise
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(hadoop_conf(spark)).open(p)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(hadoop_conf(spark)).delete(p, True))
