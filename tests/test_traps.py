"""One test per semantic trap on small literal frames."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from lakeflux.functions.jsonfmt import decode_json, row_to_json
from lakeflux.functions.lookup import STATE_REGION, region_dimension, region_of
from lakeflux.operators.audit import add_audit_columns, to_envelope
from lakeflux.operators.avro import avro_schema
from lakeflux.operators.features import standardize
from lakeflux.operators.profile import column_profile
from lakeflux.session import work_dir
from lakeflux.sinks.files import CSV_READ_OPTIONS, write_zone_csv


def test_t1_population_std_and_zero_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, c double")
    out = standardize(df, ["a", "c"]).collect()
    pop_std = math.sqrt(2.0 / 3.0)
    assert [round(r.a, 9) for r in out] == [round(x / pop_std, 9) for x in (-1.0, 0.0, 1.0)]
    assert [r.c for r in out] == [0.0, 0.0, 0.0]  # zero std divides by 1


def test_t2_envelope_drops_nulls_by_default_lossless_keeps(spark):
    df = spark.createDataFrame([(1, None)], "id int, name string").withColumn(
        "ts", F.lit("2024-01-01 00:00:00.123456").cast("timestamp_ntz")
    )
    default = df.select(row_to_json(df).alias("v")).first().v
    lossless = df.select(row_to_json(df, lossless=True).alias("v")).first().v
    assert "name" not in json.loads(default)
    assert json.loads(default)["ts"].endswith(".123")
    assert json.loads(lossless)["name"] is None
    assert json.loads(lossless)["ts"].endswith(".123456")
    back = df.select(row_to_json(df, True).alias("v")).select(decode_json("v", df.schema, True).alias("r")).select("r.*")
    assert back.collect() == df.collect()


def test_t3_nan_is_missing_in_profile(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    r = column_profile(df).first()
    assert r.n_unique == 2
    assert r.max_value == 3.0 and r.min_value == 1.0
    assert r.null_share == 0.5


def test_t4_ansi_division_is_safe_on_empty(spark):
    empty = spark.createDataFrame([], "x double, s string")
    rows = column_profile(empty).orderBy("ordinal").collect()
    assert [r.null_share for r in rows] == [None, None]  # T11: 0/0 is null
    assert [r.n_unique for r in rows] == [0, 0]


def test_t5_csv_round_trip_quotes_backslashes_breaks(spark):
    texts = [None, 'plain', 'say "hi"', "back\\slash", "line\nbreak", "", 'mix "q" \\ and\r\nCRLF', "a,b"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    path = write_zone_csv(df, work_dir(spark, "t5"))
    back = spark.read.options(**CSV_READ_OPTIONS).schema(df.schema).csv(path)
    assert sorted(back.collect()) == sorted(df.collect())


def test_t7_avro_matches_type_class_and_names(spark):
    schema = StructType(
        [
            StructField("s", StringType()),
            StructField("l", LongType()),
            StructField("i", IntegerType()),
            StructField("d", DoubleType()),
            StructField("t", TimestampType()),
            StructField("a", ArrayType(StringType())),
            StructField("ai", ArrayType(IntegerType())),
            StructField("m", MapType(StringType(), LongType())),
            StructField("dec", DecimalType(10, 2)),
        ]
    )
    doc = json.loads(avro_schema(schema, "Orders", "com.example"))
    assert doc["name"] == "Orders" and doc["namespace"] == "com.example"
    types = {f["name"]: f["type"] for f in doc["fields"]}
    assert types["s"] == ["string", "null"]
    assert types["l"] == ["long", "null"]
    assert types["t"] == ["long", "null"]
    assert types["a"] == [{"type": "array", "items": ["string", "null"]}, "null"]
    assert types["ai"] == [{"type": "array", "items": ["int", "null"]}, "null"]
    assert types["m"] == [{"type": "map", "values": ["long", "null"]}, "null"]
    assert types["dec"] == [{"type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2}, "null"]


def test_t9_region_table_corrected(spark):
    mapping = dict(STATE_REGION)
    assert len(mapping) == 27
    assert mapping["BR-MA"] == "Nordeste"
    assert mapping["BR-RJ"] == "Sudeste" and mapping["BR-PI"] == "Nordeste"
    df = spark.createDataFrame([("BR-SP",), ("BR-XX",), (None,)], "state string")
    got = df.select(region_of("state").alias("r")).collect()
    assert [r.r for r in got] == ["Sudeste", None, None]
    assert region_dimension(spark).count() == 27


def test_t10_rows_written_is_bigint(spark):
    df = spark.range(7).withColumnRenamed("id", "k")
    out = add_audit_columns(df, as_of="2024-02-01 00:00:00")
    assert dict(out.dtypes)["rows_written"] == "bigint"
    assert {r.rows_written for r in out.collect()} == {7}
    schema = json.loads(out.first().schema)
    assert [f["name"] for f in schema["fields"]] == ["k"]  # schema of the input
    assert out.columns[1:] == [
        "ingestion_time", "source_system", "user_name", "ingestion_type", "base_format", "rows_written", "schema"
    ]
    env = to_envelope(out)
    assert env.columns == ["value"] and env.count() == 7


def test_profile_boolean_and_mixed_columns(spark):
    df = spark.createDataFrame(
        [(True, 1, "a"), (False, None, "a"), (None, 3, None), (True, 3, "b")], "flag boolean, n int, s string"
    )
    rows = {r.feature: r for r in column_profile(df).collect()}
    f = rows["flag"]
    assert (f.dtype, f.is_categorical, f.is_binary, f.n_unique) == ("boolean", 0, 0, 2)
    assert (f.min_value, f.max_value, f.null_share) == (0.0, 1.0, 0.25)
    n = rows["n"]
    assert (n.n_unique, n.min_value, n.max_value, n.null_share) == (2, 1.0, 3.0, 0.25)
    s = rows["s"]
    assert (s.is_categorical, s.is_binary, s.n_unique, s.min_value) == (1, 1, 2, None)
    assert [r.feature for r in column_profile(df, ["s", "flag"]).orderBy("ordinal").collect()] == ["s", "flag"]
