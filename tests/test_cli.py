"""Job entry points, run in-process on the test session."""

from __future__ import annotations

import json

from lakeflux import cli
from lakeflux.session import work_dir
from tests.conftest import SF_SMALL


def test_cli_deliver_profile_drift_warehouse(spark):
    root = work_dir(spark, "cli")
    out = cli.main(["deliver", "--source", f"{SF_SMALL}/region.parquet", "--sink-format", "json", "--path", f"{root}/msgs", "--key", "r_regionkey"])
    assert out["delivered_to"].endswith("msgs")
    msgs = spark.read.json(f"{root}/msgs")
    assert msgs.count() == 5 and json.loads(msgs.first().value)["rows_written"] == 5

    cli.main(["profile", "--input", f"{SF_SMALL}/customer.parquet", "--output", f"{root}/profile"])
    assert spark.read.parquet(f"{root}/profile").count() == 5

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.where("ts < '2024-01-16'").write.parquet(f"{root}/ref")
    ev.where("ts >= '2024-01-16'").write.parquet(f"{root}/cur")
    res = cli.main(["drift", "--reference", f"{root}/ref", "--current", f"{root}/cur", "--output", f"{root}/drift",
                    "--columns", "value,event_type", "--numeric-test", "ks", "--categorical-test", "chi2"])
    assert res["status"] in ("SUCCESS", "FAIL")
    assert spark.read.parquet(f"{root}/drift/columns").count() == 2

    spark.read.parquet(f"{SF_SMALL}/nation.parquet").write.parquet(f"{root}/lake/tpch/nation")
    res = cli.main(["warehouse", "--lake-root", f"{root}/lake", "--owner", "tpch", "--table", "nation",
                    "--format", "parquet", "--root", f"{root}/wh"])
    assert spark.read.parquet(res["target"]).count() == 25


def test_cli_ingest(spark):
    root = work_dir(spark, "cli-ingest")
    spark.range(10).selectExpr("id", "id * 2 AS v").write.json(f"{root}/landing")
    res = cli.main(["ingest", "--source", f"{root}/landing", "--schema", "id bigint, v bigint", "--target", f"{root}/out",
                    "--checkpoint", f"{root}/ckpt", "--archive", f"{root}/archive"])
    assert res["rows"] == 10
