"""Job-level plans: delivery, monitoring, modeling chain; approximate profile."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from lakeflux.operators.profile import column_profile
from lakeflux.plans import delivery, modeling, monitoring
from lakeflux.sinks.metrics_log import metrics_latest
from lakeflux.session import work_dir
from tests.conftest import SF_SMALL


def test_deliver_table_to_files(spark):
    src = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    out = work_dir(spark, "deliver")
    delivery.deliver_table(src, fmt="json", path=out, key_cols=["n_nationkey"], topic="t", as_of="2024-02-01 00:00:00")
    msgs = spark.read.json(out)
    assert msgs.count() == 25
    first = json.loads(msgs.first().value)
    assert first["rows_written"] == 25 and first["source_system"] == "sap"
    assert set(msgs.columns) == {"key", "value", "topic"}


def test_monitor_gate(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").toDF(*[c.upper() for c in ["event_id", "ts", "user_id", "event_type", "value", "props"]])
    ref = ev.where(F.col("TS") < "2024-01-16")
    out = monitoring.monitor(ref, ref, ["USER_ID", "VALUE", "EVENT_TYPE"])
    gate = out["gate"].first()
    assert gate.status == "SUCCESS" and gate.retrain is False
    report = json.loads(out["report"].first().report)
    assert report["tests"][0]["name"] == "share_of_drifted_columns"
    assert len(report["tests"]) == 4
    drifted = monitoring.monitor(ref, ref.withColumn("VALUE", F.col("VALUE") + 1000).withColumn("USER_ID", F.col("USER_ID") * 50), ["user_id", "value", "event_type"])
    assert drifted["gate"].first().retrain is True


def test_modeling_chain(spark):
    rows = [(i, float(i % 7), float((i * 3) % 5), "a" if i % 7 < 3 else "b") for i in range(400)]
    df = spark.createDataFrame(rows, "k long, f1 double, f2 double, y string")
    root = work_dir(spark, "chain")
    fs = modeling.prepare(df, "k", ["f1", "f2"], "y", f"{root}/fs")
    assert spark.read.parquet(fs).where("split = 'test'").count() == 80
    mp = modeling.train(spark, fs, ["f1", "f2"], "y", f"{root}/m")
    out = modeling.score_and_evaluate(spark, fs, ["f1", "f2"], "k", "y", mp, "r1", f"{root}/metrics")
    metrics = {r.metric: r.value for r in out["metrics"].collect()}
    assert metrics["accuracy"] > 0.9  # separable on f1
    assert sum(r.n for r in out["confusion"].collect()) == 80
    modeling.score_and_evaluate(spark, fs, ["f1", "f2"], "k", "y", mp, "r1", f"{root}/metrics")  # a retried run
    assert metrics_latest(spark, f"{root}/metrics").count() == 6  # four scores and two feature means


def test_approx_profile_close_to_exact(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    exact = {r.feature: r.n_unique for r in column_profile(li, ["l_orderkey", "l_returnflag"]).collect()}
    approx = {r.feature: r.n_unique for r in column_profile(li, ["l_orderkey", "l_returnflag"], approx_distinct=True).collect()}
    assert approx["l_returnflag"] == exact["l_returnflag"]
    assert abs(approx["l_orderkey"] - exact["l_orderkey"]) <= 0.05 * exact["l_orderkey"]
