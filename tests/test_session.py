"""A session keeps what its submission has set."""

from __future__ import annotations

import os
import subprocess
import sys

from lakeflux.session import recommended_conf, remove_work, work_dir, work_root

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(code: str, **conf: str) -> str:
    args = " ".join(f"--conf {k}={v}" for k, v in {"spark.ui.enabled": "false", **conf}.items())
    env = {**os.environ, "PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": f"{args} pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout.strip().splitlines()[-1]


SHOW = (
    "from lakeflux.session import build_session, recommended_conf\n"
    "s = build_session(defaults=recommended_conf(1 << 40, 64))\n"
    "c = s.sparkContext.getConf()\n"
    "print(s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'), s.sparkContext.appName)"
)


def test_preset_settings_are_kept():
    got = _run(SHOW, **{"spark.master": "local[2]", "spark.sql.shuffle.partitions": "333", "spark.sql.session.timeZone": "CET", "spark.app.name": "mine"})
    assert got == "local[2] 333 CET mine"


def test_defaults_fill_what_is_not_set():
    got = _run(SHOW, **{"spark.master": "local[1]"})
    assert got.split()[:3] == ["local[1]", recommended_conf(1 << 40, 64)["spark.sql.shuffle.partitions"], "UTC"]


def test_work_folder_is_removed(spark):
    path = work_dir(spark, "t")
    spark.range(3).write.parquet(path)
    assert path.startswith(work_root(spark)) and spark.read.parquet(path).count() == 3
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert fs.exists(hadoop) and remove_work(spark) and not fs.exists(hadoop)
