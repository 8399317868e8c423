"""Incremental zone ingestion: each file once, archive after a later batch."""

from __future__ import annotations

import os

import pytest

from pyspark.sql import functions as F

from lakeflux.session import local_path, work_dir
from lakeflux.streaming.zone_stream import ingest_available, landing_stream, write_landing_json

SCHEMA = "id long, ts timestamp_ntz, v double"


def _batch(spark, start, n):
    return spark.range(start, start + n).select(
        "id", F.lit("2024-01-01 10:11:12.123456").cast("timestamp_ntz").alias("ts"), (F.col("id") * 0.5).alias("v")
    )


def test_each_file_once_across_runs(spark):
    root = work_dir(spark, "stream-test")
    landing, archive, out, ckpt = (f"{root}/{p}" for p in ("landing", "archive", "out", "ckpt"))
    schema = _batch(spark, 0, 1).schema
    write_landing_json(_batch(spark, 0, 100), landing)
    first = ingest_available(landing_stream(spark, landing, schema, "archive", archive), out, ckpt)
    assert first["rows"] == 100
    # a run with nothing new adds nothing
    again = ingest_available(landing_stream(spark, landing, schema, "archive", archive), out, ckpt)
    assert again["rows"] == 0
    write_landing_json(_batch(spark, 100, 50), landing)
    second = ingest_available(landing_stream(spark, landing, schema, "archive", archive), out, ckpt)
    assert second["rows"] == 50
    got = spark.read.schema(SCHEMA).parquet(out)
    assert got.count() == 150 and got.select("id").distinct().count() == 150
    # lossless timestamps through the JSON landing files
    assert {str(r.ts) for r in got.select("ts").distinct().collect()} == {"2024-01-01 10:11:12.123456"}
    # files of the first wave were archived by the later run with new data
    archived = []
    for base, _dirs, files in os.walk(local_path(archive)):
        archived += [f for f in files if f.endswith(".json")]
    assert archived


def _record_file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


GOOD = '[{"id": 1, "user_id": 2, "title": "t1", "body": "b\\n1"}, {"id": 2, "user_id": 2, "title": "t2", "body": null}]'


def test_same_named_files_stay_apart_and_broken_ones_are_reported(spark, tmp_path):
    from lakeflux.operators.promotion import promote
    from lakeflux.plans.zones import BUSINESS_SCHEMA, curate
    from lakeflux.sources.files import read_record_arrays, record_files, rejected_files
    from lakeflux.streaming.zone_stream import curate_stream

    root = str(tmp_path)
    day = f"{root}/processing/business/20240201"
    _record_file(f"{day}/a", "x.json", GOOD)
    _record_file(f"{day}/b", "x.json", GOOD.replace("t1", "u1"))
    out = curate(spark, f"{root}/processing", f"{root}/curated", "20240201")
    folders = {d for d in os.listdir(local_path(out)) if d.startswith("source_file=")}
    assert folders == {"source_file=a%2Fx.json", "source_file=b%2Fx.json"}

    _record_file(f"{day}/b", "cut.json", GOOD[:-9])
    with pytest.raises(Exception, match="broken record file"):
        read_record_arrays(spark, day, BUSINESS_SCHEMA).collect()
    assert read_record_arrays(spark, day, BUSINESS_SCHEMA, on_bad="reject").count() == 4
    bad = rejected_files(record_files(spark, day, BUSINESS_SCHEMA)).collect()
    assert len(bad) == 1 and bad[0].file.endswith("b/cut.json")

    stored = promote(spark, day, f"{root}/next", "20240202").collect()
    assert len(stored) == 3 and len({r.stored for r in stored}) == 3
    kept = {open(f"{root}/next/business/20240202/{r.stored}").read() for r in stored}
    assert kept == {GOOD, GOOD.replace("t1", "u1"), GOOD[:-9]}

    with pytest.raises(Exception):
        curate_stream(spark, f"{day}/*/*.json", BUSINESS_SCHEMA, f"{root}/c1", f"{root}/k1")
    got = curate_stream(spark, f"{day}/*/*.json", BUSINESS_SCHEMA, f"{root}/c2", f"{root}/k2", rejects=f"{root}/r2")
    assert got == {"rejects": 1, "batches": 1, "rows": 4}
    assert spark.read.parquet(f"{root}/r2").count() == 1


def test_totals_beyond_a_hundred_batches(spark, tmp_path):
    n = 104
    for k in range(n):
        _record_file(f"{tmp_path}/landing", f"{k}.json", f'{{"id": {k}, "v": 1}}\n')
    stream = landing_stream(spark, f"{tmp_path}/landing", "id long, v long", "off", max_files_per_trigger=1)
    got = ingest_available(stream, f"{tmp_path}/out", f"{tmp_path}/ckpt")
    assert got == {"batches": n, "rows": n}


def test_broken_line_stops_the_run(spark, tmp_path):
    _record_file(f"{tmp_path}/landing", "a.json", '{"id": 1}\n{"id": \n')
    with pytest.raises(Exception):
        ingest_available(landing_stream(spark, f"{tmp_path}/landing", "id long", "off"), f"{tmp_path}/out", f"{tmp_path}/c")
    kept = landing_stream(spark, f"{tmp_path}/landing", "id long, _corrupt_record string", "off", mode="PERMISSIVE")
    assert ingest_available(kept, f"{tmp_path}/out2", f"{tmp_path}/c2")["rows"] == 2
    assert spark.read.parquet(f"{tmp_path}/out2").where("_corrupt_record is not null").count() == 1
