"""Sinks behind a commit, streams that see a file again, profiles kept by partition."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from lakeflux.operators import profile_store as PS
from lakeflux.operators.profile import column_profile
from lakeflux.sinks import staged as S
from lakeflux.sinks.warehouse import write_warehouse
from lakeflux.sources import commit_log, store
from lakeflux.streaming.zone_stream import ingest_available, landing_files_once

DDL = "k long, name string, at timestamp, day date, price decimal(10,2), tags array<string>, sub struct<a:int>"


def rows(spark, lo, hi):
    return spark.range(lo, hi, 1, 4).selectExpr(
        "id as k", "concat('n', id) as name", "timestamp_seconds(id) as at", "date '2024-01-01' as day", "cast(id as decimal(10,2)) as price", "array('a', null) as tags", "named_struct('a', int(id)) as sub"
    )


def keys(spark, path):
    return sorted(r.k for r in S.read_staged(spark, path).collect())


def files(path):
    return sorted(f for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_append_overwrite_and_batches(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        S.read_staged(spark, path)
    S.write_staged(rows(spark, 0, 10), path)
    S.write_staged(rows(spark, 10, 20), path, batch="b")
    S.write_staged(rows(spark, 10, 20), path, batch="b")  # the job is run again
    assert keys(spark, path) == list(range(20))
    assert sorted(map(str, S.read_staged(spark, path).collect())) == sorted(map(str, rows(spark, 0, 20).collect()))
    S.write_staged(rows(spark, 5, 8), path, "overwrite")
    assert keys(spark, path) == [5, 6, 7]
    S.write_staged(rows(spark, 0, 0), path, "overwrite")
    assert keys(spark, path) == [] and S.read_staged(spark, path).columns == rows(spark, 0, 1).columns
    S.write_staged(rows(spark, 1, 2), path)
    S.vacuum(spark, path)
    assert keys(spark, path) == [1] and len(files(path)) == 1


def test_a_failing_job_leaves_the_table_as_it_was(spark, tmp_path):
    path = f"{tmp_path}/t"
    S.write_staged(rows(spark, 0, 100), path)
    before = files(path)
    bad = rows(spark, 0, 100).withColumn("k", F.when(F.col("k") == 99, F.raise_error(F.lit("no such row")).cast("long")).otherwise(F.col("k")))
    with pytest.raises(Exception, match="no such row"):
        S.write_staged(bad, path, "overwrite")
    assert keys(spark, path) == list(range(100)) and files(path) == before


def test_files_of_attempts_that_do_not_count_are_not_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    S.write_staged(rows(spark, 0, 10), path)
    job = os.listdir(f"{path}/data")[0]
    some = [f for f in os.listdir(f"{path}/data/{job}") if f.endswith(".parquet")][0]
    shutil.copy(f"{path}/data/{job}/{some}", f"{path}/data/{job}/part-00000-999.parquet")  # a speculative twin
    os.makedirs(f"{path}/_staging/lost")
    shutil.copy(f"{path}/data/{job}/{some}", f"{path}/_staging/lost/{some}")
    assert keys(spark, path) == list(range(10))


def test_two_writers_get_versions_of_their_own(spark, tmp_path):
    path = f"{tmp_path}/t"
    S.write_staged(rows(spark, 0, 1), path)
    client, root = store.open_store(store.qualified(spark, path))
    assert not store.create_new(client, f"{root}/_log/{0:020d}.json", "{}")
    assert store.create_new(client, f"{root}/_log/{1:020d}.json", '{"version": 1, "files": [], "overwrite": false, "rows": 0, "schema": ' + rows(spark, 0, 0).schema.json() + "}")
    S.write_staged(rows(spark, 1, 2), path)
    assert [e["version"] for e in commit_log.entries(spark, path)] == [0, 1, 2] and keys(spark, path) == [0, 1]


def test_warehouse_by_the_staged_format(spark, tmp_path):
    target = write_warehouse(rows(spark, 0, 3), "o", "t", "append", "staged", None, str(tmp_path))
    assert target.endswith("/o/t") and keys(spark, target) == [0, 1, 2]
    with pytest.raises(ValueError):
        write_warehouse(rows(spark, 0, 3), "o", "t", "append", "staged")


# streams


def land(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_files_that_land_again_are_ingested_once(spark, tmp_path):
    source, out, ckpt = (f"{tmp_path}/{x}" for x in ("in", "out", "ckpt"))
    one, two = '{"k": 1}\n{"k": 2}\n', '{"k": 3}'
    run = lambda: ingest_available(landing_files_once(spark, source, "k long"), out, ckpt)["rows"]
    land(source, "a.json", one)
    land(source, "twin.json", one)
    assert run() == 2
    land(source, "b.json", one)  # the same bytes under another name, after a restart
    land(source, "c.json", two)
    land(source, "empty.json", "")
    assert run() == 1
    assert run() == 0
    land(source, "d.json", one + "\n")  # other bytes are another file
    assert run() == 2
    assert sorted(r.k for r in spark.read.schema("k long").parquet(out).collect()) == [1, 1, 2, 2, 3]
    land(source, "bad.json", '{"k": ')
    with pytest.raises(Exception):
        run()


def test_stream_totals_do_not_read_the_target(spark, tmp_path):
    source, out, ckpt = (f"{tmp_path}/{x}" for x in ("in", "out", "ckpt"))
    land(source, "a.json", '{"k": 1}\n')
    stream = lambda: landing_files_once(spark, source, "k long")
    assert ingest_available(stream(), out, ckpt)["rows"] == 1
    for f in files(out):
        os.remove(f"{out}/{f}")  # a later run must not need what earlier ones wrote
    land(source, "b.json", '{"k": 2}\n{"k": 3}\n')
    assert ingest_available(stream(), out, ckpt)["rows"] == 2


# profiles


def test_parts_merge_to_the_profile_of_all_rows(spark, tmp_path):
    df = spark.range(20_000).selectExpr(
        "id", "id % 7 as small", "if(id % 3 = 0, null, cast(id % 1000 as string)) as word", "if(id % 5 = 0, double('nan'), id / 2) as half", "if(id % 2 = 0, 'a', 'b') as two", "id > 5 as flag", "cast(null as int) as none", "id % 4 as part"
    )
    cols = df.columns[:-1]
    table = f"{tmp_path}/parts"
    for part in (3, 0, 1, 2, 1):
        PS.store_part(df.where(F.col("part") == part), table, part, cols)
    exact = {r.feature: r for r in column_profile(df, cols).collect()}
    got = {r.feature: r for r in PS.stored_profile(spark, table).collect()}
    assert set(got) == set(cols)
    for c, e in exact.items():
        g = got[c]
        assert (g.ordinal, g.dtype, g.is_categorical, g.is_binary, g.min_value, g.max_value, g.null_share) == (e.ordinal, e.dtype, e.is_categorical, e.is_binary, e.min_value, e.max_value, e.null_share), c
        assert abs(g.n_unique - e.n_unique) <= PS.distinct_error() * e.n_unique
        assert e.n_unique > 1 << PS.LOG_ENTRIES or g.n_unique == e.n_unique
    early = {r.feature: r.n_unique for r in PS.stored_profile(spark, table, 1).collect()}
    assert early["id"] == 10_000
    with pytest.raises(FileNotFoundError):
        PS.stored_profile(spark, f"{tmp_path}/none")


def test_a_part_is_one_scan(spark, tmp_path):
    spark.range(50).write.parquet(f"{tmp_path}/src")
    plan = PS.profile_part(spark.read.parquet(f"{tmp_path}/src"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    empty = PS.as_profile(PS.profile_part(spark.range(0))).first()
    assert empty.n_unique == 0 and empty.null_share is None
