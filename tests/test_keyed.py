"""Pairing by key, the metrics log and reconciled delivery."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeflux.operators import keyed
from lakeflux.operators.evaluate import accuracy, align, align_rejects, confusion_wide
from lakeflux.operators.features import attach_label
from lakeflux.plans.delivery import DeliveryMismatch, deliver_table
from lakeflux.sinks import metrics_log as M
from lakeflux.sources import commit_log

TRUTH = [(1, "a"), (2, "b"), (3, "a"), (3, "b"), (None, "a"), (None, "b"), (5, "c"), (6, "c"), (6, "d")]
PRED = [(1, "a"), (2, "a"), (3, "a"), (5, "c"), (5, "d"), (6, "c"), (6, "c"), (7, "x"), (None, "z")]


def sides(spark):
    return spark.createDataFrame(TRUTH, "k long, target string"), spark.createDataFrame(PRED, "k int, Predictions string")


def test_unpaired_keys_raise_or_are_reported(spark):
    truth, pred = sides(spark)
    with pytest.raises(Exception, match="keys do not match"):
        align(truth, pred, "k").collect()
    assert sorted(map(tuple, align(truth, pred, "k", "reject").collect())) == [(1, "a", "a"), (2, "b", "a")]
    assert {r.k: (r.reason, r.n_left, r.n_right) for r in align_rejects(truth, pred, "k").collect()} == {
        None: (keyed.NULL_KEY, 2, 1), 3: (keyed.REPEATED_LEFT, 2, 1), 5: (keyed.REPEATED_RIGHT, 1, 2), 6: (keyed.REPEATED_BOTH, 2, 2), 7: (keyed.RIGHT_ONLY, 0, 1),
    }
    with pytest.raises(ValueError):
        align(truth, pred, "k", "drop")


def test_a_truth_scored_three_times_is_no_accuracy_of_one(spark):
    truth = spark.createDataFrame([(1, "a"), (2, "b")], "k long, target string")
    pred = spark.createDataFrame([(1, "a")] * 3, "k long, Predictions string")
    with pytest.raises(Exception, match="keys do not match"):
        accuracy(align(truth, pred, "k")).collect()
    assert accuracy(align(truth, pred, "k", "reject")).first().n == 0
    fine = align(truth, spark.createDataFrame([(2, "b"), (1, "b")], "k long, Predictions string"), "k")
    assert fine.columns == ["k", "target", "Predictions"] and accuracy(fine).first().accuracy == 0.5


def test_counts_are_observed_in_the_pass_that_pairs(spark):
    rows, bad, seen = keyed.pair_checked(*sides(spark), "k")
    assert rows.count() == seen["matched"] == 2
    assert Counter(r.reason.replace(" ", "_") for r in bad.collect()) == Counter({k: v for k, v in seen.items() if v and k != "matched"})
    rows, bad, seen = keyed.pair_checked(spark.createDataFrame([], "k long, a int"), spark.createDataFrame([], "k long, b int"), "k")
    assert rows.count() == bad.count() == 0 and set(seen.values()) == {0}


def test_attach_label_does_not_multiply_rows(spark):
    x = spark.createDataFrame([(1, 1.0), (2, 2.0), (None, 3.0), (None, 4.0)], "k long, x double")
    y = spark.createDataFrame([(2, "b"), (3, "c"), (None, "n")], "k long, y string")
    got = sorted(map(tuple, attach_label(x, y, "k").collect()), key=repr)
    assert got == sorted(map(tuple, x.join(y, "k", "full").collect()), key=repr)
    with pytest.raises(Exception, match="rows would be multiplied"):
        attach_label(x, y.union(y), "k").collect()


def test_wide_confusion_matrix(spark):
    a = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "z"), (None, "a")], "target string, Predictions string")
    got = {r.truth: (r.a, r.b, r.c) for r in confusion_wide(a, ["a", "b", "c"]).collect()}
    assert got == {"a": (1, 1, 0), "b": (0, 0, 0), "c": (0, 0, 0)}


# metrics log


def write(spark, table, run, **values):
    return M.upsert_metrics(spark.createDataFrame([(run, k, float(v)) for k, v in values.items()], "run_id string, metric string, value double"), table)


def latest(spark, table):
    return {(r.run_id, r.metric): r.value for r in M.metrics_latest(spark, table).collect()}


def test_a_retried_run_replaces_its_own_values(spark, tmp_path):
    table = f"{tmp_path}/m"
    assert latest(spark, table) == {}
    write(spark, table, "r1", a=1, b=2)
    write(spark, table, "r2", a=5)
    write(spark, table, "r1", a=3)
    want = {("r1", "a"): 3.0, ("r1", "b"): 2.0, ("r2", "a"): 5.0}
    assert latest(spark, table) == want
    M.compact(spark, table)
    assert latest(spark, table) == want and len(M._live(commit_log.entries(spark, table))) == 1
    write(spark, table, "r2", a=6, c=7)
    assert latest(spark, table) == want | {("r2", "a"): 6.0, ("r2", "c"): 7.0}
    with pytest.raises(ValueError, match="stands 2 times"):
        M.upsert_metrics(spark.createDataFrame([("r", "a", 1.0), ("r", "a", 2.0)], "run_id string, metric string, value double"), table)
    assert ("r", "a") not in latest(spark, table)


def test_a_write_during_compaction_is_kept(spark, tmp_path, monkeypatch):
    table = f"{tmp_path}/m"
    write(spark, table, "r1", a=1)
    stale = commit_log.entries(spark, table)
    write(spark, table, "r1", a=2)
    real = commit_log.entries
    monkeypatch.setattr(commit_log, "entries", lambda *x: stale)  # the compaction has looked before the second write
    M.compact(spark, table)
    monkeypatch.setattr(commit_log, "entries", real)
    assert latest(spark, table) == {("r1", "a"): 2.0}


def test_a_long_log_is_compacted_as_it_grows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "MOST_FOLDERS", 2)
    table = f"{tmp_path}/m"
    for i in range(5):
        write(spark, table, f"r{i % 2}", a=i)
    assert latest(spark, table) == {("r0", "a"): 4.0, ("r1", "a"): 3.0} and len(M._live(commit_log.entries(spark, table))) <= 3


# delivery


def test_delivery_counts_where_rows_are_written(spark, tmp_path):
    source = spark.range(500).withColumnRenamed("id", "k")
    assert deliver_table(source, fmt="text", path=f"{tmp_path}/a", as_of="2024-02-01 00:00:00") == {"rows_written": 500, "delivered": 500}
    taken = deliver_table(source.where(F.rand() < 0.5), fmt="text", path=f"{tmp_path}/b", snapshot_path=f"{tmp_path}/s")
    assert taken["rows_written"] == taken["delivered"] == spark.read.text(f"{tmp_path}/b").count() == spark.read.parquet(f"{tmp_path}/s").count()
    assert deliver_table(source.limit(0), fmt="text", path=f"{tmp_path}/e")["delivered"] == 0


def test_a_source_that_changes_under_the_job_stops_it(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    for name in "ab":
        with open(f"{tmp_path}/in/{name}.json", "w") as f:
            f.write('{"k": 1}\n{"k": 2}\n')
    source = spark.read.schema("k long").json(f"{tmp_path}/in")
    assert source.count() == 4
    with open(f"{tmp_path}/in/b.json", "w") as f:  # one row less since the caller counted
        f.write('{"k": 1}\n')
    with pytest.raises(DeliveryMismatch, match="3 rows were delivered, the messages say 4"):
        deliver_table(spark.read.schema("k long").json(f"{tmp_path}/in"), fmt="text", path=f"{tmp_path}/out", rows_written=4)


def test_the_delivery_plan_scans_the_source_once(spark, tmp_path):
    from lakeflux.plans.delivery import build_messages

    spark.range(50).write.parquet(f"{tmp_path}/src")
    plan = build_messages(spark.read.parquet(f"{tmp_path}/src"), rows_written=50)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ubquery" not in plan
