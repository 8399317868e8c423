"""Promotion of landing files: bytes, names, second runs, runs lost at every step."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from lakeflux.operators import promotion as P
from lakeflux.plans.zones import curate
from lakeflux.sources import store
from lakeflux.sources.files import dated_files

DS = "20240201"
RECORDS = b'[{"id": 1, "user_id": 2, "title": "t", "body": "b"}]'
FILES = {
    "a/x.json": RECORDS,
    "b/x.json": RECORDS + b"\n",
    "empty.json": b"",
    "bytes.json": bytes(range(256)) * 3,
    "no end.json": b"\xff\xfe no line end",
    "deep/er/with space, and %20.json": b"[]\r\n\r\n",
    f"{'long' * 50}.json": b"[ ]",
}


@pytest.fixture
def landing(tmp_path):
    for name, data in FILES.items():
        path = tmp_path / "landing" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return str(tmp_path / "landing")


def zone(tmp_path, name="processing"):
    return str(tmp_path / name)


def stored_files(root):
    folder = f"{root}/business/{DS}"
    return {n: open(f"{folder}/{n}", "rb").read() for n in os.listdir(folder) if not n.startswith(("_", "."))}


def test_files_arrive_byte_for_byte_under_the_returned_names(spark, landing, tmp_path):
    got = {r.file: r for r in P.promote(spark, landing, zone(tmp_path), DS).collect()}
    assert set(got) == set(FILES)
    held = stored_files(zone(tmp_path))
    assert held == {got[f].stored: data for f, data in FILES.items()}
    for name, data in FILES.items():
        assert got[name].sha256 == hashlib.sha256(data).hexdigest() and got[name].bytes == len(data)
    found = dated_files(spark, zone(tmp_path), "business", DS)
    assert sorted(p.rpartition("/")[2] for p in found) == sorted(held)
    assert all(os.path.exists(f"{landing}/{n}") for n in FILES)


def test_a_second_run_copies_only_what_is_new(spark, landing, tmp_path):
    P.promote(spark, landing, zone(tmp_path), DS)
    before = stored_files(zone(tmp_path))
    assert P.promote(spark, landing, zone(tmp_path), DS).count() == 0
    assert stored_files(zone(tmp_path)) == before
    with open(f"{landing}/a/y.json", "wb") as f:
        f.write(b"new")
    again = P.promote(spark, landing, zone(tmp_path), DS).collect()
    assert [r.file for r in again] == ["a/y.json"] and len(stored_files(zone(tmp_path))) == len(FILES) + 1
    assert P.manifest(spark, store.qualified(spark, f"{zone(tmp_path)}/business/{DS}")).count() == len(FILES) + 1


def test_sources_go_only_if_they_are_what_was_copied(spark, landing, tmp_path, monkeypatch):
    publish = P._publish

    def late(spark, target, run):
        publish(spark, target, run)
        with open(f"{landing}/a/x.json", "ab") as f:  # a producer writes on, after the copy
            f.write(b" ")

    monkeypatch.setattr(P, "_publish", late)
    P.promote(spark, landing, zone(tmp_path), DS, delete_source=True)
    left = [os.path.relpath(os.path.join(d, n), landing) for d, _, ns in os.walk(landing) for n in ns if not n.startswith(".")]
    assert left == ["a/x.json"] and open(f"{landing}/a/x.json", "rb").read() == RECORDS + b" "
    monkeypatch.setattr(P, "_publish", publish)
    assert [r.bytes for r in P.promote(spark, landing, zone(tmp_path), DS, delete_source=True).collect()] == [len(RECORDS) + 1]


def test_a_run_lost_before_its_manifest_leaves_nothing(spark, landing, tmp_path):
    os.makedirs(f"{zone(tmp_path)}/business/{DS}/_staging/run=1-dead")
    with open(f"{zone(tmp_path)}/business/{DS}/_staging/run=1-dead/business-1-half.json.7", "wb") as f:
        f.write(b"[")
    os.makedirs(f"{zone(tmp_path)}/business/{DS}/_promoted/run=1-dead/_temporary")
    assert P.promote(spark, landing, zone(tmp_path), DS).count() == len(FILES)
    assert sorted(stored_files(zone(tmp_path)).values()) == sorted(FILES.values())
    assert not os.path.exists(f"{zone(tmp_path)}/business/{DS}/_staging/run=1-dead")


def test_a_run_lost_after_its_manifest_is_finished_by_the_next(spark, landing, tmp_path, monkeypatch):
    publish = P._publish

    def dies(spark, target, run):
        raise RuntimeError("lost")

    monkeypatch.setattr(P, "_publish", dies)
    with pytest.raises(RuntimeError, match="lost"):
        P.promote(spark, landing, zone(tmp_path), DS)
    assert stored_files(zone(tmp_path)) == {}
    monkeypatch.setattr(P, "_publish", publish)
    assert P.promote(spark, landing, zone(tmp_path), DS).count() == 0  # all are in the earlier run's manifest
    assert sorted(stored_files(zone(tmp_path)).values()) == sorted(FILES.values())
    # moved in part before it was lost: the rest follows
    target = store.qualified(spark, f"{zone(tmp_path)}/business/{DS}")
    run = P._runs(spark, target)[0]
    os.remove(f"{zone(tmp_path)}/business/{DS}/_promoted/{run}/_published")
    assert P.recover(spark, target)["published"] == [run]


def test_a_file_that_changes_while_it_is_copied_fails_the_run(spark, landing, tmp_path, monkeypatch):
    listing = store.list_files
    monkeypatch.setattr(store, "list_files", lambda *a: listing(*a).withColumn("bytes", F.when(F.col("path").endswith("bytes.json"), 5).otherwise(F.col("bytes"))))
    with pytest.raises(Exception, match="changed while it was copied"):
        P.promote(spark, landing, zone(tmp_path), DS, delete_source=True)
    assert stored_files(zone(tmp_path)) == {} and os.path.exists(f"{landing}/a/x.json")


def test_curate_reads_what_was_promoted(spark, tmp_path):
    for name in ("a.json", "b.txt"):
        (tmp_path / "landing").mkdir(exist_ok=True)
        (tmp_path / "landing" / name).write_bytes(RECORDS)
    P.promote(spark, str(tmp_path / "landing"), zone(tmp_path), DS, as_of=F.lit("2024-02-01 10:11:12").cast("timestamp"), glob=None)
    assert all(n.startswith("business-20240201101112-") and n.endswith(".json") for n in stored_files(zone(tmp_path)))
    out = curate(spark, zone(tmp_path), zone(tmp_path, "curated"), DS)
    assert spark.read.option("header", True).csv(out).count() == 2


def test_new_files_are_created_by_one_writer(spark, tmp_path):
    assert store.write_new(spark, f"{tmp_path}/log/0001", "first é")
    assert not store.write_new(spark, f"{tmp_path}/log/0001", "second")
    assert store.read_text(spark, f"{tmp_path}/log/0001") == "first é" and store.names(spark, f"{tmp_path}/log") == ["0001"]
    assert store.names(spark, f"{tmp_path}/none") == []


def test_store_paths():
    assert store.open_store("file:///a/b c%20")[1] == "/a/b c%20" and store.open_store("file:/a")[1] == "/a" and store.open_store("/a")[1] == "/a"


def test_promote_job(spark, landing, tmp_path):
    from lakeflux import cli

    args = ["promote", "--landing", landing, "--processing", zone(tmp_path), "--ds", DS, "--delete-source"]
    assert cli.main(args) == {"promoted": len(FILES)} and cli.main(args) == {"promoted": 0}
    assert not [n for _, _, ns in os.walk(landing) for n in ns if not n.startswith(".")]
