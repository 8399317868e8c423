"""Zone ETL family: record files, per-file head, CSV sink, incremental stream,
file and warehouse sinks, snapshots."""

from __future__ import annotations

import json
import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from lakeflux.operators.promotion import manifest, promote
from lakeflux.operators.zones import DEFAULT_RECORDS_PER_FILE, apply_per_file, hash_chunk, write_landing_records
from lakeflux.plans.zones import BUSINESS_SCHEMA, curate, select_head
from lakeflux.queries.common import AS_OF, load, r6
from lakeflux.session import work_dir
from lakeflux.sinks.files import CSV_READ_OPTIONS, write_parquet_replace, write_zone_csv
from lakeflux.sinks.staged import read_staged
from lakeflux.sinks.warehouse import write_warehouse
from lakeflux.sources.files import (
    dated_prefix,
    explode_records,
    read_lake_table,
    read_parquet,
    read_record_arrays,
    record_files,
    rejected_files,
    whole_files,
)
from lakeflux.sources import snapshot_log, store
from lakeflux.sources.snapshot import SNAPSHOT_COL, read_latest_snapshot
from lakeflux.sources.splits import line_heads, read_record_arrays_split
from lakeflux.streaming.zone_stream import curate_stream, ingest_available, landing_files_once, landing_stream, write_landing_json


def _documents_landing(spark: SparkSession, sf_dir: str) -> str:
    """documents -> record-array files, one folder per source (fixture)."""
    docs = load(spark, sf_dir, "documents")
    path = work_dir(spark, "landing-documents")
    record = {
        "id": F.col("doc_id"),
        "user_id": F.col("n_chars"),
        "title": F.col("lang"),
        "body": F.col("text"),
    }
    return write_landing_records(docs, path, "source", "doc_id", record, DEFAULT_RECORDS_PER_FILE)


def zone_head_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _documents_landing(spark, sf_dir)
    records = read_record_arrays(spark, path, BUSINESS_SCHEMA, glob=None)
    return select_head(records, keep=("id", "title", "body")).select("id", "pos", "title", "body")


def zone_stream_curate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream form of the zone job: record files -> first 5 of each -> CSV."""
    path = _documents_landing(spark, sf_dir)
    root = work_dir(spark, "stream-curate")
    curate_stream(
        spark, f"{path}/*/*/*.txt", BUSINESS_SCHEMA, f"{root}/curated", f"{root}/checkpoint",
        keep=("id", "title", "body"), archive_dir=f"{root}/archive",
    )
    schema = "pos int, id bigint, title string, body string, source_file string"
    back = spark.read.options(**CSV_READ_OPTIONS).schema(schema).csv(f"{root}/curated")
    return back.select("id", "pos", "title", "body")


def zone_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record files of documents, those of every source that ends in 3 cut short: what
    the batch reader keeps and what it rejects, by source."""
    path = _documents_landing(spark, sf_dir)
    raw = whole_files(spark.read.option("recursiveFileLookup", "true"), path)
    source = F.regexp_extract("file", "source=([^/]*)", 1)
    broken = F.expr("substring(value, 1, length(value) - 2)")
    root = work_dir(spark, "broken-documents")
    cut = raw.select(source.alias("source"), F.regexp_extract("file", "chunk=([^/]*)", 1).alias("chunk"), F.when(source.endswith("3"), broken).otherwise(F.col("value")).alias("value"))
    cut.write.partitionBy("source", "chunk").text(root)
    parsed = record_files(spark, root, BUSINESS_SCHEMA, glob=None)
    kept = explode_records(parsed, "reject").groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("n_records"))
    rejected = rejected_files(parsed).groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("n_rejected"))
    return kept.join(rejected, "source", "full").select(
        "source", F.coalesce("n_records", F.lit(0)).alias("n_records"), F.coalesce("n_rejected", F.lit(0)).alias("n_rejected")
    )


def record_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of the record-array files, each file read by many tasks, with their positions."""
    path = _documents_landing(spark, sf_dir)
    return read_record_arrays_split(spark, path, BUSINESS_SCHEMA, glob="*.txt", split_bytes=1 << 16).select("id", "pos", "title", "body")


def zone_head_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 5 lines of each JSON-lines file, files read in many splits."""
    docs = load(spark, sf_dir, "documents")
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    chunk = hash_chunk(F.col("id"), F.ceil(F.col("n") / F.lit(float(DEFAULT_RECORDS_PER_FILE))))
    rows = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("title"), F.col("text").alias("body"), "source").join(counts, "source").withColumn("chunk", chunk)
    path = work_dir(spark, "lines-documents")
    rows.drop("n").repartition("source", "chunk").sortWithinPartitions("source", "chunk", "id").write.partitionBy("source", "chunk").json(path)
    return line_heads(spark, path, BUSINESS_SCHEMA, 5, split_bytes=1 << 16).select("id", "pos", "title", "body")


def zone_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing -> processing: every record file under a stamped name of its own, read back by its date folder."""
    path = _documents_landing(spark, sf_dir)
    root = work_dir(spark, "processing-documents")
    promote(spark, path, root, "20240201", F.lit(AS_OF).cast("timestamp"), "*.txt").count()
    stored = read_record_arrays(spark, dated_prefix(root, "business", "20240201"), BUSINESS_SCHEMA, glob=None)
    return stored.groupBy(F.regexp_extract("file", "source_([^_]*)_chunk", 1).alias("source")).agg(
        F.countDistinct("file").alias("n_files"), F.count(F.lit(1)).alias("n_records"), F.sum("user_id").alias("n_chars")
    )


def zone_promote_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain, landing -> processing -> curated: files are promoted and deleted from landing, a second run finds
    nothing new, and the zone job reads what was stored. Each curated row carries how many files the second run
    copied, how many are left in landing, and how many stored files differ from their manifest."""
    path = _documents_landing(spark, sf_dir)
    root = work_dir(spark, "zones-documents")
    first = promote(spark, path, f"{root}/processing", "20240201", glob="*.txt", delete_source=True)
    second = promote(spark, path, f"{root}/processing", "20240201", glob="*.txt", delete_source=True)
    target = dated_prefix(f"{root}/processing", "business", "20240201")
    held = spark.read.format("binaryFile").load(f"{target}/*.json").select(F.element_at(F.split("path", "/"), -1).alias("stored"), F.sha2("content", 256).alias("now"))
    entries = manifest(spark, store.qualified(spark, target))
    wrong = entries.join(held, "stored", "full").where(~F.col("sha256").eqNullSafe(F.col("now"))).agg(F.count(F.lit(1)).alias("n"))
    left = store.list_files(spark, path, "*.txt").agg(F.count(F.lit(1)).alias("n"))
    curated = curate(spark, f"{root}/processing", f"{root}/curated", "20240201", keep=("id", "title", "body"))
    schema = "id bigint, title string, body string, source_file string"
    rows = spark.read.options(**CSV_READ_OPTIONS).schema(schema).csv(curated)
    names = first.select("stored")
    return rows.join(names, rows.source_file == names.stored).select(
        "id", "title", "body", F.lit(second.count()).cast("long").alias("copied_again"), left.scalar().alias("left_in_landing"), wrong.scalar().alias("differing")
    )


def per_file_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A callable over whole files: the longest word and the number of words of each source's files."""
    path = _documents_landing(spark, sf_dir)
    raw = whole_files(spark.read.option("recursiveFileLookup", "true"), path)

    def words(file: str, text: str) -> list[tuple]:
        bodies = [r.get("body") or "" for r in json.loads(text)]
        found = [w for b in bodies for w in re.findall(r"[a-z]+", b)]
        return [(file.split("source=")[1].split("/")[0], len(bodies), len(found), max(map(len, found), default=0))]

    out = apply_per_file(raw, words, "source string, n_records long, n_words long, longest long")
    return out.groupBy("source").agg(F.sum("n_records").alias("n_records"), F.sum("n_words").alias("n_words"), F.max("longest").alias("longest"))


def zone_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    path = write_zone_csv(docs, work_dir(spark, "curated-documents"))
    return spark.read.options(**CSV_READ_OPTIONS).schema(docs.schema).csv(path)


EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def zone_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events land in two waves of day folders; each run ingests only new files."""
    events = load(spark, sf_dir, "events").withColumn("ds", F.date_format("ts", "yyyyMMdd"))
    root = work_dir(spark, "stream-events")
    landing, archive, out, ckpt = (f"{root}/{p}" for p in ("landing", "archive", "bronze", "checkpoint"))
    cut = F.lit("20240116")
    source = f"{landing}/ds=*/*.json"
    write_landing_json(events.where(F.col("ds") < cut), landing, ["ds"])
    ingest_available(landing_stream(spark, source, events.drop("ds").schema, "archive", archive), out, ckpt)
    write_landing_json(events.where(F.col("ds") >= cut), landing, ["ds"])
    ingest_available(landing_stream(spark, source, events.drop("ds").schema, "archive", archive), out, ckpt)
    bronze = spark.read.schema(EVENTS_SCHEMA).parquet(out)
    return bronze.groupBy(F.date_format("ts", "yyyyMMdd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_ids"), r6(F.sum("value")).alias("value_sum")
    )


def zone_stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events land by day; the first wave lands a second time under other names, with the second wave. Each run
    starts the stream anew; what landed again is ingested once."""
    events = load(spark, sf_dir, "events").withColumn("ds", F.date_format("ts", "yyyyMMdd"))
    root = work_dir(spark, "stream-redelivered")
    landing, out, ckpt = (f"{root}/{p}" for p in ("landing", "bronze", "checkpoint"))
    cut = F.lit("20240116")
    by_day = lambda rows: rows.repartition("ds").sortWithinPartitions("ds", "event_id")  # noqa: E731  the same bytes each time
    drain = lambda: ingest_available(landing_files_once(spark, f"{landing}/ds=*/*.json", events.drop("ds").schema), out, ckpt)
    write_landing_json(by_day(events.where(F.col("ds") < cut)), landing, ["ds"])
    drain()
    write_landing_json(by_day(events.where(F.col("ds") < cut)), landing, ["ds"])
    write_landing_json(by_day(events.where(F.col("ds") >= cut)), landing, ["ds"])
    drain()
    bronze = spark.read.schema(EVENTS_SCHEMA).parquet(out)
    return bronze.groupBy(F.date_format("ts", "yyyyMMdd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_ids"), r6(F.sum("value")).alias("value_sum")
    )


def sink_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders in two appends, the second of them run twice, behind an overwrite; a write that fails half way leaves nothing."""
    orders = load(spark, sf_dir, "orders")
    root = work_dir(spark, "staged")
    even = F.col("o_orderkey") % 2 == 0
    write_warehouse(orders.where(even), "tpch", "orders", "append", "staged", {"batch": "0"}, root)
    write_warehouse(orders.where(even), "tpch", "orders", "overwrite", "staged", {"batch": "1"}, root)
    for _ in range(2):
        write_warehouse(orders.where(~even), "tpch", "orders", "append", "staged", {"batch": "2"}, root)
    key = F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("a row that cannot be written")).cast("long")).otherwise(F.col("o_orderkey"))
    try:
        write_warehouse(orders.withColumn("o_orderkey", key), "tpch", "orders", "overwrite", "staged", None, root)
    except PySparkException:
        pass
    else:
        raise AssertionError("the write should have failed")
    return read_staged(spark, f"{root}/tpch/orders")


def parquet_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = load(spark, sf_dir, "supplier")
    path = work_dir(spark, "supplier-replace")
    write_parquet_replace(supplier, path)
    write_parquet_replace(supplier, path)
    return read_parquet(spark, path)


def warehouse_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation")
    root = work_dir(spark, "warehouse")
    write_warehouse(nation, "tpch", "nation", "append", "parquet", root=root)
    write_warehouse(nation, "tpch", "nation", "append", "parquet", root=root)
    write_warehouse(nation, "tpch", "nation", "overwrite", "parquet", root=root)
    return read_lake_table(spark, root, "tpch", "nation")


def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events published as daily snapshots; the reader keeps the newest."""
    events = load(spark, sf_dir, "events")
    path = work_dir(spark, "snapshots-events")
    (
        events.withColumn(SNAPSHOT_COL, F.date_format("ts", "yyyyMMdd"))
        .write.mode("overwrite")
        .partitionBy(SNAPSHOT_COL)
        .parquet(path)
    )
    schema = StructType(events.schema.fields + [StructField(SNAPSHOT_COL, StringType())])
    return read_latest_snapshot(spark, path, schema)


def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events published once a week, one week a second time and one only half: what a run of 20 January reads."""
    events = load(spark, sf_dir, "events")
    table = work_dir(spark, "snapshot-log-events")
    until = lambda day: events.where(F.col("ts") < F.lit(f"{day} 00:00:00").cast("timestamp_ntz"))
    for day, rows in (("2024-01-22", until("2024-01-22")), ("2024-01-08", until("2024-01-08")), ("2024-01-15", until("2024-01-08")), ("2024-01-15", until("2024-01-15"))):
        snapshot_log.publish(rows, table, day)
    events.write.parquet(f"{table}/data/half-written")
    return snapshot_log.read_as_of(spark, table, "2024-01-20")


HEAD_PER_FILE_SQL = f"""
WITH d AS (SELECT *, count(*) OVER (PARTITION BY source) AS cnt FROM documents),
c AS (SELECT *, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT
               % CAST(ceil(cnt / {float(DEFAULT_RECORDS_PER_FILE)}) AS BIGINT) AS chunk FROM d),
r AS (SELECT doc_id, lang, text, row_number() OVER (PARTITION BY source, chunk ORDER BY doc_id) - 1 AS pos FROM c)
SELECT doc_id AS id, CAST(pos AS INTEGER) AS pos, lang AS title, text AS body FROM r WHERE pos < 5
"""

FILES_SQL = f"""
WITH d AS (SELECT *, count(*) OVER (PARTITION BY source) AS cnt FROM documents),
c AS (SELECT *, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT
               % CAST(ceil(cnt / {float(DEFAULT_RECORDS_PER_FILE)}) AS BIGINT) AS chunk FROM d)
"""

SQL = {
    "zone_rejects": FILES_SQL
    + """
SELECT source, CASE WHEN source LIKE '%3' THEN 0 ELSE count(*) END::BIGINT AS n_records,
       CASE WHEN source LIKE '%3' THEN count(DISTINCT chunk) ELSE 0 END::BIGINT AS n_rejected FROM c GROUP BY source
""",
    "zone_promote": FILES_SQL
    + """
SELECT source, count(DISTINCT chunk)::BIGINT AS n_files, count(*)::BIGINT AS n_records, sum(n_chars)::BIGINT AS n_chars FROM c GROUP BY source
""",
    "zone_promote_manifest": f"SELECT id, title, body, 0::BIGINT AS copied_again, 0::BIGINT AS left_in_landing, 0::BIGINT AS differing FROM ({HEAD_PER_FILE_SQL})",
    "per_file_python": """
WITH w AS (SELECT source, regexp_extract_all(coalesce(text, ''), '[a-z]+') AS ws FROM documents)
SELECT source, count(*)::BIGINT AS n_records, sum(len(ws))::BIGINT AS n_words,
       max(coalesce(list_max(list_transform(ws, lambda x: length(x))), 0))::BIGINT AS longest FROM w GROUP BY source
""",
    "zone_head_per_file": HEAD_PER_FILE_SQL,
    "zone_head_lines": HEAD_PER_FILE_SQL,
    "record_array_split": HEAD_PER_FILE_SQL.replace(" WHERE pos < 5", ""),
    "snapshot_as_of": "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'",
    "zone_csv_roundtrip": "SELECT doc_id, text, lang, source FROM documents",
    "zone_stream_curate": HEAD_PER_FILE_SQL,
    "zone_stream_ingest": """
SELECT strftime(ts, '%Y%m%d') AS day, count(*)::BIGINT AS n, count(DISTINCT event_id)::BIGINT AS n_ids,
       round(sum(value), 6) AS value_sum
FROM events GROUP BY 1
""",
    "zone_stream_redelivered": """
SELECT strftime(ts, '%Y%m%d') AS day, count(*)::BIGINT AS n, count(DISTINCT event_id)::BIGINT AS n_ids, round(sum(value), 6) AS value_sum
FROM events GROUP BY 1
""",
    "sink_commit": "SELECT * FROM orders",
    "parquet_replace": "SELECT * FROM supplier",
    "warehouse_overwrite": "SELECT * FROM nation",
    "snapshot_latest": """
SELECT *, strftime(ts, '%Y%m%d') AS snapshot FROM events
WHERE strftime(ts, '%Y%m%d') = (SELECT max(strftime(ts, '%Y%m%d')) FROM events)
""",
}

QUERIES = {
    "zone_head_per_file": zone_head_per_file,
    "zone_rejects": zone_rejects,
    "zone_head_lines": zone_head_lines,
    "record_array_split": record_array_split,
    "zone_promote": zone_promote,
    "zone_promote_manifest": zone_promote_manifest,
    "per_file_python": per_file_python,
    "zone_csv_roundtrip": zone_csv_roundtrip,
    "zone_stream_curate": zone_stream_curate,
    "zone_stream_ingest": zone_stream_ingest,
    "zone_stream_redelivered": zone_stream_redelivered,
    "sink_commit": sink_commit,
    "parquet_replace": parquet_replace,
    "warehouse_overwrite": warehouse_overwrite,
    "snapshot_latest": snapshot_latest,
    "snapshot_as_of": snapshot_as_of,
}
