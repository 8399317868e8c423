"""Delivery family: audit columns, JSON envelope, message frame, column ops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from lakeflux.functions.jsonfmt import decode_json
from lakeflux.operators.audit import add_audit_columns, to_envelope
from lakeflux.operators.columns import drop_all_null_rows, drop_columns, lower_case_names, rename_positional
from lakeflux.plans.delivery import deliver_table
from lakeflux.queries.common import AS_OF, as_text_ts, load
from lakeflux.session import work_dir
from lakeflux.sinks.messages import message_frame

AUDIT_OUT = ["source_system", "user_name", "ingestion_type", "base_format", "rows_written", "schema"]


def _audit_out(df: DataFrame, base_cols: list[str]) -> DataFrame:
    return df.select(*base_cols, as_text_ts(F.col("ingestion_time")).alias("ingestion_time"), *AUDIT_OUT)


def deliver_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> audit columns -> JSON envelope -> decoded back to columns."""
    orders = load(spark, sf_dir, "orders")
    enriched = add_audit_columns(orders, as_of=AS_OF)
    envelope = to_envelope(enriched)
    decoded = envelope.select(decode_json("value", enriched.schema).alias("r")).select("r.*")
    return _audit_out(decoded, orders.columns)


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    return _audit_out(add_audit_columns(customer, as_of=AS_OF), customer.columns)


def kafka_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> keyed message frame with topic -> decoded back."""
    nation = load(spark, sf_dir, "nation")
    frame = message_frame(nation, key_cols=["n_nationkey"], topic="nation-topic")
    return frame.select(
        "topic", "key", decode_json("value", nation.schema).alias("r")
    ).select("topic", "key", "r.*")


def rename_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = load(spark, sf_dir, "supplier")
    renamed = rename_positional(supplier, ["Supplier_Key", "Supplier_Name", "Nation_Key", "Account_Balance"])
    return drop_columns(lower_case_names(renamed), ["nation_key"])


def drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with nulls derived from the event type; the all-null rows go."""
    ev = load(spark, sf_dir, "events")
    et = F.col("event_type")
    derived = ev.select(
        F.when(et.isin("error", "view"), None).otherwise(F.col("user_id")).alias("user_id"),
        F.nullif(et, F.lit("error")).alias("event_type"),
        F.when(et.isin("error", "click"), None).otherwise(F.col("value")).alias("value"),
        F.when(et.isin("error", "signup"), None).otherwise(F.col("props")).alias("props"),
    )
    return drop_all_null_rows(derived)


def _schema_json(fields: list[tuple[str, object]]) -> str:
    return StructType([StructField(n, t, True) for n, t in fields]).json()


ORDERS_SCHEMA_JSON = _schema_json(
    [
        ("o_orderkey", LongType()),
        ("o_custkey", LongType()),
        ("o_orderstatus", StringType()),
        ("o_totalprice", DoubleType()),
        ("o_orderdate", TimestampNTZType()),
        ("o_orderpriority", StringType()),
    ]
)
CUSTOMER_SCHEMA_JSON = _schema_json(
    [
        ("c_custkey", LongType()),
        ("c_name", StringType()),
        ("c_nationkey", IntegerType()),
        ("c_acctbal", DoubleType()),
        ("c_mktsegment", StringType()),
    ]
)


def _audit_sql(table: str, cols: str, schema_json: str) -> str:
    return f"""
SELECT {cols},
       '{AS_OF}' AS ingestion_time, 'sap' AS source_system, 'airflow' AS user_name,
       'spark' AS ingestion_type, 'table' AS base_format,
       (SELECT count(*) FROM {table})::BIGINT AS rows_written,
       '{schema_json}' AS schema
FROM {table}
"""


def delivery_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders delivered from a snapshot: what the job counted while it wrote, against the messages themselves."""
    orders = load(spark, sf_dir, "orders")
    root = work_dir(spark, "delivery-orders")
    counts = deliver_table(orders, fmt="text", path=f"{root}/messages", snapshot_path=f"{root}/snapshot", as_of=AS_OF)
    value = spark.read.text(f"{root}/messages").select(F.from_json("value", "o_orderkey bigint, rows_written bigint").alias("m"))
    return value.groupBy("m.rows_written").agg(F.count(F.lit(1)).alias("n_messages"), F.countDistinct("m.o_orderkey").alias("n_orders")).select(
        "rows_written", "n_messages", "n_orders", F.lit(counts["delivered"]).cast("long").alias("delivered")
    )


SQL = {
    "delivery_reconciled": """
SELECT count(*)::BIGINT AS rows_written, count(*)::BIGINT AS n_messages, count(DISTINCT o_orderkey)::BIGINT AS n_orders, count(*)::BIGINT AS delivered FROM orders
""",
    "deliver_envelope": _audit_sql(
        "orders", "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority", ORDERS_SCHEMA_JSON
    ),
    "audit_columns": _audit_sql(
        "customer", "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment", CUSTOMER_SCHEMA_JSON
    ),
    "kafka_frame": """
SELECT 'nation-topic' AS topic, CAST(n_nationkey AS VARCHAR) AS key, n_nationkey, n_name, n_regionkey
FROM nation
""",
    "rename_lower": """
SELECT s_suppkey AS supplier_key, s_name AS supplier_name, s_acctbal AS account_balance FROM supplier
""",
    "drop_all_null_rows": """
SELECT * FROM (
  SELECT CASE WHEN event_type IN ('error','view') THEN NULL ELSE user_id END AS user_id,
         NULLIF(event_type, 'error') AS event_type,
         CASE WHEN event_type IN ('error','click') THEN NULL ELSE value END AS value,
         CASE WHEN event_type IN ('error','signup') THEN NULL ELSE props END AS props
  FROM events) t
WHERE NOT (user_id IS NULL AND event_type IS NULL AND value IS NULL AND props IS NULL)
""",
}

QUERIES = {
    "delivery_reconciled": delivery_reconciled,
    "deliver_envelope": deliver_envelope,
    "audit_columns": audit_columns,
    "kafka_frame": kafka_frame,
    "rename_lower": rename_lower,
    "drop_all_null_rows": drop_all_null,
}
