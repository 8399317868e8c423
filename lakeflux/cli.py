"""Command-line entry points for the jobs (``spark-submit lakeflux/cli.py <job> ...``
or ``python -m lakeflux.cli <job> ...``).

Credentials are never passed on the command line: ``--user-env`` and
``--password-env`` name environment variables that hold them.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from lakeflux.operators.drift import CATEGORICAL_TESTS, NUMERIC_TESTS


_sizing: dict[str, str] = {}


def _session() -> SparkSession:
    """The active session, or one with the submission's own master and settings."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from lakeflux.session import build_session

    return build_session(defaults=_sizing)


def _read_source(spark: SparkSession, args) -> "DataFrame":  # noqa: F821
    if args.source_format == "jdbc":
        from lakeflux.sources.jdbc import read_jdbc, read_jdbc_partitioned

        creds = {
            "user": os.environ.get(args.user_env) if args.user_env else None,
            "password": os.environ.get(args.password_env) if args.password_env else None,
            "driver": args.driver,
        }
        if args.partition_column:
            return read_jdbc_partitioned(spark, args.source, args.table, args.partition_column, args.num_partitions, **creds)
        return read_jdbc(spark, args.source, args.table, **creds)
    return spark.read.format(args.source_format).load(args.source)


def cmd_deliver(args) -> dict:
    from lakeflux.plans.delivery import deliver_table

    spark = _session()
    options = {}
    if args.sink_format == "kafka":
        options = {"kafka.bootstrap.servers": args.bootstrap_servers, "topic": args.topic}
    counts = deliver_table(
        _read_source(spark, args),
        fmt=args.sink_format,
        options=options,
        path=args.path,
        snapshot_path=args.snapshot_path,
        key_cols=args.key.split(",") if args.key else None,
        source_system=args.source_system,
    )
    return {"delivered_to": args.path or args.topic, **counts}


def cmd_promote(args) -> dict:
    from lakeflux.operators.promotion import promote

    entries = promote(_session(), args.landing, args.processing, args.ds, glob=args.glob, delete_source=args.delete_source)
    return {"promoted": entries.count()}


def cmd_curate(args) -> dict:
    from lakeflux.plans.zones import curate

    return {"curated": curate(_session(), args.processing, args.curated, args.ds, n=args.head)}


def cmd_ingest(args) -> dict:
    from pyspark.sql.types import StructType

    from lakeflux.streaming.zone_stream import ingest_available, landing_stream

    spark = _session()
    schema = StructType.fromDDL(args.schema)
    clean = "archive" if args.archive else "off"
    stream = landing_stream(spark, args.source, schema, clean, args.archive)
    return ingest_available(stream, args.target, args.checkpoint)


def cmd_profile(args) -> dict:
    from lakeflux.operators.profile import column_profile

    spark = _session()
    df = spark.read.parquet(args.input)
    cols = args.columns.split(",") if args.columns else None
    column_profile(df, cols, approx_distinct=args.approx).write.mode("overwrite").parquet(args.output)
    return {"profile": args.output}


def cmd_drift(args) -> dict:
    from lakeflux.plans.monitoring import monitor

    spark = _session()
    ref, cur = spark.read.parquet(args.reference), spark.read.parquet(args.current)
    out = monitor(
        ref,
        cur,
        args.columns.split(",") if args.columns else None,
        categorical=args.categorical.split(",") if args.categorical else (),
        numeric_test=args.numeric_test,
        categorical_test=args.categorical_test,
    )
    out["columns"].write.mode("overwrite").parquet(f"{args.output}/columns")
    out["report"].write.mode("overwrite").text(f"{args.output}/report")
    gate = out["gate"].first()
    return {"status": gate.status, "retrain": bool(gate.retrain)}


def cmd_warehouse(args) -> dict:
    from lakeflux.sinks.warehouse import write_warehouse
    from lakeflux.sources.files import read_lake_table

    spark = _session()
    df = read_lake_table(spark, args.lake_root, args.owner, args.table, args.lake_format)
    options = {}
    if args.url:
        options["url"] = args.url
        if args.user_env:
            options["user"] = os.environ[args.user_env]
        if args.password_env:
            options["password"] = os.environ[args.password_env]
    target = write_warehouse(df, args.owner, args.table, args.load_type, args.format, options, args.root)
    return {"target": target}


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakeflux")
    p.add_argument("--input-bytes", type=int, help="size of the input: sizes shuffles and scans where the submission does not")
    p.add_argument("--total-cores", type=int, default=8, help="cores of all executors, with --input-bytes")
    sub = p.add_subparsers(dest="job", required=True)

    d = sub.add_parser("deliver", help="source table -> audit columns -> JSON messages -> sink")
    d.add_argument("--source-format", default="parquet", help="jdbc, parquet, delta, ...")
    d.add_argument("--source", required=True, help="JDBC url or table path")
    d.add_argument("--table", help="JDBC table")
    d.add_argument("--driver")
    d.add_argument("--user-env")
    d.add_argument("--password-env")
    d.add_argument("--partition-column")
    d.add_argument("--num-partitions", type=int, default=8)
    d.add_argument("--sink-format", default="kafka")
    d.add_argument("--bootstrap-servers")
    d.add_argument("--topic")
    d.add_argument("--path")
    d.add_argument("--snapshot-path")
    d.add_argument("--key")
    d.add_argument("--source-system", default="sap")
    d.set_defaults(fn=cmd_deliver)

    pm = sub.add_parser("promote", help="landing files -> processing zone, byte for byte, under a manifest")
    pm.add_argument("--landing", required=True)
    pm.add_argument("--processing", required=True)
    pm.add_argument("--ds", required=True, help="run date yyyymmdd")
    pm.add_argument("--glob", default="*.json")
    pm.add_argument("--delete-source", action="store_true", help="delete landing files that are still what was copied")
    pm.set_defaults(fn=cmd_promote)

    c = sub.add_parser("curate", help="processing zone record files -> first records -> curated CSV")
    c.add_argument("--processing", required=True)
    c.add_argument("--curated", required=True)
    c.add_argument("--ds", required=True, help="run date yyyymmdd")
    c.add_argument("--head", type=int, default=5)
    c.set_defaults(fn=cmd_curate)

    i = sub.add_parser("ingest", help="new landing files -> next zone, once each")
    i.add_argument("--source", required=True)
    i.add_argument("--schema", required=True, help="DDL, e.g. 'id bigint, ts timestamp_ntz'")
    i.add_argument("--target", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--archive")
    i.set_defaults(fn=cmd_ingest)

    pr = sub.add_parser("profile", help="column profile of a parquet table")
    pr.add_argument("--input", required=True)
    pr.add_argument("--output", required=True)
    pr.add_argument("--columns")
    pr.add_argument("--approx", action="store_true")
    pr.set_defaults(fn=cmd_profile)

    dr = sub.add_parser("drift", help="reference vs current drift report and retrain gate")
    dr.add_argument("--reference", required=True)
    dr.add_argument("--current", required=True)
    dr.add_argument("--output", required=True)
    dr.add_argument("--columns")
    dr.add_argument("--categorical", help="numeric columns to be tested as categories")
    dr.add_argument("--numeric-test", default="wasserstein", choices=NUMERIC_TESTS)
    dr.add_argument("--categorical-test", default="jensenshannon", choices=CATEGORICAL_TESTS)
    dr.set_defaults(fn=cmd_drift)

    w = sub.add_parser("warehouse", help="curated lake table -> warehouse table")
    w.add_argument("--lake-root", required=True)
    w.add_argument("--lake-format", default="parquet")
    w.add_argument("--owner", required=True)
    w.add_argument("--table", required=True)
    w.add_argument("--load-type", default="overwrite", choices=["overwrite", "append"])
    w.add_argument("--format", default="jdbc")
    w.add_argument("--url")
    w.add_argument("--user-env")
    w.add_argument("--password-env")
    w.add_argument("--root", help="target root for file formats")
    w.set_defaults(fn=cmd_warehouse)
    return p


def main(argv: list[str] | None = None) -> dict:
    from lakeflux.session import recommended_conf, remove_work

    args = build_parser().parse_args(argv)
    own = SparkSession.getActiveSession() is None
    _sizing.clear()
    if args.input_bytes:
        _sizing.update(recommended_conf(args.input_bytes, args.total_cores))
    try:
        result = args.fn(args)
    finally:
        if own and (spark := SparkSession.getActiveSession()) is not None:
            remove_work(spark)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    main()
