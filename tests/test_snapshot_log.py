"""Snapshots behind a commit log: order of runs, as-of reads, half-written snapshots, writers at the same time."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from lakeflux.sources import commit_log, snapshot_log as S
from lakeflux.sources.snapshot import latest_snapshot, publish_snapshot


def value(spark, table, as_of=None):
    return S.read_as_of(spark, table, as_of).first().v


def put(spark, table, run, v):
    return S.publish(spark.createDataFrame([(v,)], "v long"), table, run)


def test_runs_are_compared_as_numbers_and_dates(spark, tmp_path):
    numbers, dates = f"{tmp_path}/n", f"{tmp_path}/d"
    for run in (10, 9, 100):
        put(spark, numbers, run, run)
    assert value(spark, numbers) == 100 and value(spark, numbers, 99) == 10 and value(spark, numbers, "9") == 9
    with pytest.raises(FileNotFoundError):
        S.read_as_of(spark, numbers, 8)
    with pytest.raises(ValueError):
        put(spark, numbers, "2024-01-01", 1)
    put(spark, dates, dt.date(2024, 1, 31), 131)
    put(spark, dates, "2024-02-10", 210)
    assert value(spark, dates, "2024-02-09") == 131 and value(spark, dates, dt.date(2024, 2, 10)) == 210
    put(spark, dates, "2024-01-31", 132)  # a rerun of an earlier date
    assert value(spark, dates, "2024-02-01") == 132 and value(spark, dates) == 210


def test_half_written_snapshots_are_invisible(spark, tmp_path):
    table = f"{tmp_path}/t"
    put(spark, table, 1, 11)
    spark.range(3).write.parquet(f"{table}/data/lost")
    assert value(spark, table) == 11 and len(S.snapshots(spark, table)) == 1
    put(spark, table, 2, 22)
    entry = S.find(spark, table)
    os.remove(f"{table}/{entry['data']}/_SUCCESS")  # a store that lost the mark
    assert value(spark, table) == 11
    assert S.vacuum(spark, table) == ["lost"]
    with pytest.raises(FileNotFoundError):
        S.read_as_of(spark, f"{tmp_path}/none")


def test_writers_at_the_same_time_get_versions_of_their_own(spark, tmp_path, monkeypatch):
    table = f"{tmp_path}/t"
    put(spark, table, 1, 1)
    real = commit_log.entries
    stale = real(spark, table)
    monkeypatch.setattr(commit_log, "entries", lambda *a: stale)  # both have looked at the log before either commits
    assert [put(spark, table, 2, 2), put(spark, table, 3, 3)] == [1, 2]
    monkeypatch.setattr(commit_log, "entries", real)
    assert [e["version"] for e in S.snapshots(spark, table)] == [0, 1, 2] and value(spark, table) == 3


def test_checkpoints_of_the_log_change_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commit_log, "CHECKPOINT", 3)
    table = f"{tmp_path}/t"
    for run in range(8):
        put(spark, table, run, run * 10)
    marks = [n for n in os.listdir(f"{table}/_log") if n.endswith(".checkpoint")]
    assert len(marks) == 2 and [e["run"] for e in S.snapshots(spark, table)] == [str(r) for r in range(8)]
    assert value(spark, table, 4) == 40 and value(spark, table) == 70
    for v in range(6):  # entries before a checkpoint may be taken away
        os.remove(f"{table}/_log/{v:020d}.json")
    assert value(spark, table, 4) == 40
    S.vacuum(spark, table, keep_runs=2)
    assert value(spark, table) == 70 and len(os.listdir(f"{table}/data")) == 2


def test_schema_and_empty_snapshots(spark, tmp_path):
    table = f"{tmp_path}/t"
    S.publish(spark.createDataFrame([], "a int, p string"), table, 1, ["p"])
    assert S.read_as_of(spark, table).count() == 0 and S.read_as_of(spark, table).columns == ["a", "p"]
    S.publish(spark.createDataFrame([(1, "007")], "a int, p string"), table, 2, ["p"])
    assert S.read_as_of(spark, table).first().p == "007"


def test_partition_snapshots_are_ordered_by_number(spark, tmp_path):
    for name in ("9", "10"):
        publish_snapshot(spark.range(int(name)), f"{tmp_path}/p", name)
    assert latest_snapshot(spark, f"{tmp_path}/p") == "10"
