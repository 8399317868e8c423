"""Unit tests for scalar functions, column operators, sources and schema inference."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lakeflux.functions.text import file_stamp, day_folder, object_name, os_family
from lakeflux.operators.avro import json_field_types
from lakeflux.operators.columns import (
    drop_all_null_rows,
    lower_case_names,
    rename_positional,
    select_columns,
)
from lakeflux.operators.grouped import grouped_partials
from lakeflux.sinks.messages import message_frame
from lakeflux.sources.jdbc import jdbc_options
from lakeflux.sources.snapshot import publish_snapshot, read_latest_snapshot
from lakeflux.session import work_dir


def test_os_family_cases(spark):
    rows = [
        ("Mozilla (Linux; Android 14)",),
        ("Mozilla (Windows NT 10.0) like Macintosh",),  # two names: the later one wins
        ("iPhone; Android bridge",),  # iphone after android in the list
        ("curl/8",),
        ("",),
        (None,),
        ("UBUNTU desktop",),
    ]
    df = spark.createDataFrame(rows, "ua string")
    got = [r.o for r in df.select(os_family("ua").alias("o")).collect()]
    assert got == ["android", "macintosh", "iphone", "Outro", "Outro", None, "ubuntu"]


def test_stamps(spark):
    df = spark.createDataFrame([("2024-03-05 07:08:09.012345",)], "t string").select(
        F.col("t").cast("timestamp").alias("t")
    )
    r = df.select(day_folder("t").alias("d"), file_stamp("t").alias("s"), object_name("business", F.col("t")).alias("o")).first()
    assert r.d == "20240305"
    assert r.s == "2024-03-05_07h08m09s012345"
    assert r.o == "business/20240305/business-2024-03-05_07h08m09s012345.csv"


def test_column_operators(spark):
    df = spark.createDataFrame([(1, None, None), (None, None, None), (None, 2.0, "x")], "A int, B double, C string")
    assert drop_all_null_rows(df).count() == 2
    with pytest.raises(KeyError):
        select_columns(df, ["A", "missing"])
    with pytest.raises(ValueError):
        lower_case_names(df.toDF("a", "A", "c"))
    with pytest.raises(ValueError):
        rename_positional(df, ["x"])
    assert lower_case_names(rename_positional(df, ["One", "Two", "Three"])).columns == ["one", "two", "three"]


def test_json_field_types_mixed(spark):
    payloads = [
        '{"i": 1, "l": 5, "d": 1.5, "b": true, "s": "x", "n": null, "o": {"a": 1}, "m": 1, "z": "t", "big": 1}',
        '{"i": 2, "l": 12345678901, "d": 12.0, "b": false, "s": "12", "n": null, "o": [1], "m": 2.5, "z": 3, "big": 99999999999999999999}',
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "p string")
    got = {r.field: json.loads(r.avro_type)[1] for r in json_field_types(df, "p").collect()}
    assert got == {
        "i": "int",
        "l": "long",
        "d": "double",
        "b": "boolean",
        "s": "string",
        "n": "string",
        "o": "string",
        "m": "double",
        "z": "string",
        "big": "double",
    }


def test_jdbc_options_partitioned():
    o = jdbc_options("jdbc:x", "t", user="u", partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "4" and o["fetchsize"] == "10000"
    assert "password" not in o
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_message_frame_key_topic(spark):
    df = spark.createDataFrame([(1, "a", None)], "k int, v string, z double")
    f = message_frame(df, key_cols=["k"], topic="t1").first()
    assert f.key == "1" and f.topic == "t1"
    assert json.loads(f.value) == {"k": 1, "v": "a"}


def test_snapshot_reader_reads_newest_only(spark):
    path = work_dir(spark, "snap")
    df = spark.range(3)
    publish_snapshot(df, path, "20240101")
    publish_snapshot(spark.range(5), path, "20240102")
    latest = read_latest_snapshot(spark, path, "id long, snapshot string")
    assert latest.count() == 5
    assert {r.snapshot for r in latest.collect()} == {"20240102"}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partition" in plan.lower()


def test_grouped_partials_hot_key(spark):
    import pandas as pd

    rows = [(0, 1)] * 3000 + [(k, 1) for k in range(1, 200)]
    df = spark.createDataFrame(rows, "k long, one long").repartition(6)

    def partial(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby("k", as_index=False).agg(n=("one", "sum"))

    out = grouped_partials(df, "k", partial, "k long, n long", {"n": F.sum})
    got = {r.k: r.n for r in out.collect()}
    assert got[0] == 3000 and len(got) == 200


def test_message_keys_do_not_collide(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("a|b", None, None), (None, "a", "b"), ("null", "a", "b"), ('a","b":"c', None, None)]
    keys = [r.key for r in message_frame(spark.createDataFrame(rows, "a string, b string, c string"), key_cols=["a", "b", "c"]).collect()]
    assert len(set(keys)) == len(rows)


def test_avro_names_are_unique_and_decimals_logical(spark):
    from lakeflux.operators.avro import avro_schema

    schema = spark.createDataFrame([], "p struct<x: struct<a: int>>, q struct<x: struct<b: string>>, p_x struct<c: int>, d decimal(12,3), l array<struct<x: int>>").schema
    parsed = json.loads(avro_schema(schema, "t", "n"))
    names = []

    def walk(node):
        if isinstance(node, dict):
            if node.get("type") == "record":
                names.append(node["name"])
            for v in node.values():
                walk(v)
        elif isinstance(node, list):
            for v in node:
                walk(v)

    walk(parsed["fields"])
    assert len(names) == len(set(names)) == 6
    assert parsed["fields"][3]["type"][0] == {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 3}


def test_broken_payloads_are_counted(spark):
    from lakeflux.operators.avro import broken_payloads, json_record_schema

    df = spark.createDataFrame([('{"a": 1}',), ('{"a": ',), ("[1]",), ("",), (None,), ('{"b": "x"}',)], "p string")
    assert sorted(r.p for r in broken_payloads(df, "p").collect()) == ["", "[1]", '{"a": ']
    row = json_record_schema(df, "p", "t", "n").first()
    assert row.n_broken == 3
    assert json.loads(row.schema) == {
        "type": "record",
        "name": "t",
        "namespace": "n",
        "fields": [{"name": "a", "type": ["null", "int"]}, {"name": "b", "type": ["null", "string"]}],
    }


def test_profile_exact_ends(spark):
    from lakeflux.operators.profile import column_profile

    df = spark.sql(
        "SELECT * FROM VALUES (9007199254740993L, DATE'2024-02-29', TIMESTAMP'2024-01-02 03:04:05.000006', 1.10BD, 'x'), "
        "(-9007199254740993L, DATE'1969-12-31', TIMESTAMP'1960-01-02 03:04:05', -2.25BD, 'y') AS t(l, d, t, m, s)"
    )
    got = {r.feature: (r.min_text, r.max_text) for r in column_profile(df).collect()}
    assert got == {
        "l": ("-9007199254740993", "9007199254740993"),
        "d": ("1969-12-31", "2024-02-29"),
        "t": ("1960-01-02 03:04:05.000000", "2024-01-02 03:04:05.000006"),
        "m": ("-2.25", "1.10"),
        "s": (None, None),
    }


def test_snapshot_plan_lists_one_folder(spark):
    path = work_dir(spark, "snap-one")
    for k in range(4):
        publish_snapshot(spark.range(k + 1), path, f"2024010{k}")
    latest = read_latest_snapshot(spark, path, "id long, snapshot string")
    assert latest.count() == 4 and all("snapshot=20240103" in f for f in latest.inputFiles())
    with pytest.raises(Exception):
        read_latest_snapshot(spark, work_dir(spark, "none"))


def test_literal_table_and_dated_files(spark):
    from lakeflux.sources.files import dated_files, dated_prefix, literal_table

    rows = literal_table(spark, [("a", 1), ("b", None)], "k string, v int")
    assert rows.where("v is null").count() == 1
    root = work_dir(spark, "dated")
    rows.coalesce(1).write.json(dated_prefix(root, "business", "20240201"))
    assert len(dated_files(spark, root, "business", "20240201")) == 1
    assert dated_files(spark, root, "business", "20240202") == []
