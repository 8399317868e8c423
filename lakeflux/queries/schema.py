"""Schema family: Avro field tables (Y1) and JSON payload types (Y2)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeflux.operators.avro import avro_fields, json_field_types, json_record_schema
from lakeflux.queries.common import load


def q_avro_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = avro_fields(load(spark, sf_dir, "lineitem")).withColumn("table_name", F.lit("lineitem"))
    em = avro_fields(load(spark, sf_dir, "embeddings")).withColumn("table_name", F.lit("embeddings"))
    return li.unionByName(em).select("table_name", "ordinal", "name", "avro_type", "n_null")


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON payloads from events: the stored ``props`` plus derived objects whose
    keys mix int, long, double, boolean, string, null and nested values."""
    ev = load(spark, sf_dir, "events")
    opts = {"ignoreNullFields": "false"}
    common = [
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("value").alias("v"),
        (F.col("value") > 100).alias("flag"),
        F.col("event_type").alias("tag"),
        (F.col("user_id") * F.lit(10_000_000_000)).alias("big"),
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("maybe"),
        F.struct("event_type", "user_id").alias("nested"),
    ]
    view = F.col("event_type") == "view"
    a = ev.where(view).select(
        F.to_json(F.struct(*common, F.col("user_id").alias("mixed"), F.col("event_type").alias("odd")), opts).alias("payload")
    )
    b = ev.where(~view).select(
        F.to_json(F.struct(*common, F.col("value").alias("mixed"), F.col("user_id").alias("odd")), opts).alias("payload")
    )
    return ev.select(F.col("props").alias("payload")).unionByName(a).unionByName(b)


def q_avro_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_field_types(_payloads(spark, sf_dir), "payload")


def q_avro_record_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record schema of the payloads, one in eleven of them cut short."""
    ev = load(spark, sf_dir, "events")
    cut = F.when(F.col("event_id") % 11 == 0, F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    return json_record_schema(ev.select(cut.alias("payload")), "payload", "event_props", "events")


def _avro_fields_sql() -> str:
    def rows(table: str, fields: list[tuple[str, str]]) -> list[str]:
        return [
            f"SELECT '{table}' AS table_name, {i} AS ordinal, '{n}' AS name, '{json.dumps(t)}' AS avro_type, "
            f"count(*) FILTER (WHERE {n} IS NULL)::BIGINT AS n_null FROM {table}"
            for i, (n, t) in enumerate(fields)
        ]

    li = [
        ("l_orderkey", ["long", "null"]),
        ("l_partkey", ["long", "null"]),
        ("l_suppkey", ["long", "null"]),
        ("l_linenumber", ["int", "null"]),
        ("l_quantity", ["double", "null"]),
        ("l_extendedprice", ["double", "null"]),
        ("l_discount", ["double", "null"]),
        ("l_tax", ["double", "null"]),
        ("l_returnflag", ["string", "null"]),
        ("l_linestatus", ["string", "null"]),
        ("l_shipdate", ["long", "null"]),
    ]
    em = [
        ("vec_id", ["long", "null"]),
        ("embedding", [{"type": "array", "items": ["float", "null"]}, "null"]),
        ("label", ["int", "null"]),
    ]
    return "\nUNION ALL\n".join(rows("lineitem", li) + rows("embeddings", em))


PAYLOADS_SQL = """
SELECT props AS payload FROM events
UNION ALL
SELECT json_object('k', CAST(json_extract_string(props, '$.k') AS INTEGER), 'v', value, 'flag', value > 100,
                   'tag', event_type, 'big', user_id * 10000000000,
                   'maybe', CASE WHEN event_type <> 'error' THEN user_id END,
                   'nested', json_object('event_type', event_type, 'user_id', user_id),
                   'mixed', CASE WHEN event_type = 'view' THEN to_json(user_id) ELSE to_json(value) END,
                   'odd', CASE WHEN event_type = 'view' THEN to_json(event_type) ELSE to_json(user_id) END)::VARCHAR
FROM events
"""

_FROM_JSON_SQL = """
WITH p AS ({payloads}),
e AS (SELECT j.key, j.type, j.atom FROM p, json_each(p.payload::JSON) j),
c AS (SELECT key,
             CASE WHEN type = 'NULL' THEN 'null'
                  WHEN type = 'BOOLEAN' THEN 'boolean'
                  WHEN type = 'VARCHAR' THEN 'string'
                  WHEN type IN ('OBJECT', 'ARRAY') THEN 'string'
                  WHEN type IN ('UBIGINT', 'BIGINT') THEN
                       CASE WHEN CAST(atom AS HUGEINT) BETWEEN -2147483648 AND 2147483647 THEN 'int'
                            WHEN CAST(atom AS HUGEINT) BETWEEN -9223372036854775808 AND 9223372036854775807 THEN 'long'
                            ELSE 'double' END
                  WHEN type = 'DOUBLE' THEN 'double'
                  ELSE 'string' END AS cls
      FROM e),
k AS (SELECT key, count(*) FILTER (WHERE cls <> 'null')::BIGINT AS n_values,
             count(*) FILTER (WHERE cls = 'null')::BIGINT AS n_null,
             list_sort(list_distinct(list(cls) FILTER (WHERE cls <> 'null'))) AS classes
      FROM c GROUP BY key)
SELECT key AS field,
       '["null", "' || CASE WHEN len(classes) = 0 THEN 'string'
                             WHEN len(classes) = 1 THEN classes[1]
                             WHEN len(list_filter(classes, lambda x: x NOT IN ('int', 'long'))) = 0 THEN 'long'
                             WHEN len(list_filter(classes, lambda x: x NOT IN ('int', 'long', 'double'))) = 0 THEN 'double'
                             ELSE 'string' END || '"]' AS avro_type,
       n_values, n_null
FROM k
"""

SQL = {
    "avro_fields": _avro_fields_sql(),
    "avro_from_json": _FROM_JSON_SQL.replace("{payloads}", PAYLOADS_SQL),
    "avro_record_from_json": "WITH r AS ("
    + _FROM_JSON_SQL.replace("{payloads}", "SELECT props AS payload FROM events WHERE event_id % 11 <> 0")
    + """)
SELECT '{"type":"record","name":"event_props","namespace":"events","fields":['
       || string_agg('{"name":"' || field || '","type":' || replace(avro_type, ' ', '') || '}', ',' ORDER BY field) || ']}' AS schema,
       (SELECT count(*) FROM events WHERE event_id % 11 = 0 AND props IS NOT NULL)::BIGINT AS n_broken
FROM r
""",
}
QUERIES = {"avro_fields": q_avro_fields, "avro_from_json": q_avro_from_json, "avro_record_from_json": q_avro_record_from_json}
