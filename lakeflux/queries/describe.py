"""Helper family: column profile, OS classifier, state->region lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeflux.functions.lookup import STATE_REGION, region_of
from lakeflux.functions.text import OS_FALLBACK, OS_NAMES, os_family
from lakeflux.operators.lookup import attach_region
from lakeflux.operators import profile_store
from lakeflux.operators.profile import column_profile
from lakeflux.queries.common import load
from lakeflux.session import work_dir

# Derived columns so the profile sees nulls in a numeric and a text column.
CUSTOMER_PROFILE_COLS = [
    ("c_custkey", "bigint"),
    ("c_name", "string"),
    ("c_nationkey", "int"),
    ("c_acctbal", "double"),
    ("c_mktsegment", "string"),
    ("c_acctbal_nonneg", "double"),
    ("c_segment_or_null", "string"),
]
LINEITEM_PROFILE_COLS = [
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
]


def _customer_for_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.select(
        "*",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal_nonneg"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_segment_or_null"),
    )


def profile_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _customer_for_profile(spark, sf_dir)
    return column_profile(df, [n for n, _ in CUSTOMER_PROFILE_COLS])


def profile_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "lineitem")
    return column_profile(df, [n for n, _ in LINEITEM_PROFILE_COLS])


ORDERS_PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def profile_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders profiled month by month, one month twice; the stored parts' profile, and whether its distinct counts are
    within their stated error of the exact ones."""
    orders = load(spark, sf_dir, "orders").withColumn("part", F.month("o_orderdate") % 4)
    table = work_dir(spark, "profile-orders")
    for part in (0, 1, 2, 3, 1):
        profile_store.store_part(orders.where(F.col("part") == part), table, part, ORDERS_PROFILE_COLS)
    exact = column_profile(orders, ORDERS_PROFILE_COLS).select("feature", F.col("n_unique").alias("exact"))
    got = profile_store.stored_profile(spark, table).join(exact, "feature")
    near = F.abs(F.col("n_unique") - F.col("exact")) <= profile_store.distinct_error() * F.col("exact")
    return got.select("ordinal", "feature", "dtype", "is_categorical", "is_binary", F.col("exact").alias("n_unique"), "min_value", "max_value", "null_share", near.cast("int").alias("within"))


def _profile_sql(source: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for i, (name, dtype) in enumerate(cols):
        text, when = dtype == "string", dtype.startswith("timestamp")
        exact = {"bigint": "min({0})::VARCHAR", "int": "min({0})::VARCHAR"}.get(dtype, "strftime(min({0}), '%Y-%m-%d %H:%M:%S.%f')" if when else "NULL::VARCHAR")
        nd = f"count(DISTINCT {name})::BIGINT"
        parts.append(
            f"SELECT {i} AS ordinal, '{name}' AS feature, '{dtype}' AS dtype, "
            f"{1 if text else 0} AS is_categorical, "
            f"{f'CASE WHEN count(DISTINCT {name}) = 2 THEN 1 ELSE 0 END' if text else '0'} AS is_binary, "
            f"{nd} AS n_unique, "
            f"{'NULL::DOUBLE' if text or when else f'min({name})::DOUBLE'} AS min_value, "
            f"{'NULL::DOUBLE' if text or when else f'max({name})::DOUBLE'} AS max_value, "
            f"{exact.format(name)} AS min_text, {exact.replace('min(', 'max(').format(name)} AS max_text, "
            f"round_even(count(*) FILTER (WHERE {name} IS NULL) / nullif(count(*), 0), 4) AS null_share "
            f"FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


CUSTOMER_SOURCE = (
    "(SELECT *, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal_nonneg, "
    "NULLIF(c_mktsegment, 'BUILDING') AS c_segment_or_null FROM customer) t"
)


# User agents derived from the events so the classifier sees every case:
# one name, two names (the later one wins), none, empty and null.
def _user_agent(ev: DataFrame):
    et = F.col("event_type")
    return (
        F.when(F.col("value") < 1, F.lit(None).cast("string"))
        .when(et == "view", "Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36")
        .when(et == "click", "Mozilla/5.0 (iPhone; CPU iPhone OS 17_4 like Mac OS X) Mobile/15E148")
        .when(et == "signup", "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:125.0) Gecko/20100101")
        .when((et == "purchase") & (F.col("user_id") % 2 == 0), "Mozilla/5.0 (Windows NT 10.0) like Macintosh")
        .when(et == "purchase", "Mozilla/5.0 (Windows NT 10.0; Win64; x64)")
        .when(F.col("value") < 5, "")
        .otherwise("curl/8.5.0")
    )


def os_family_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    ua = ev.select("event_id", _user_agent(ev).alias("user_agent"))
    return ua.select("event_id", "user_agent", os_family("user_agent").alias("os_family"))


UA_SQL = """CASE WHEN value < 1 THEN NULL
     WHEN event_type = 'view' THEN 'Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36'
     WHEN event_type = 'click' THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 17_4 like Mac OS X) Mobile/15E148'
     WHEN event_type = 'signup' THEN 'Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:125.0) Gecko/20100101'
     WHEN event_type = 'purchase' AND user_id % 2 = 0 THEN 'Mozilla/5.0 (Windows NT 10.0) like Macintosh'
     WHEN event_type = 'purchase' THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; x64)'
     WHEN value < 5 THEN ''
     ELSE 'curl/8.5.0' END"""


def _os_case_sql() -> str:
    whens = " ".join(f"WHEN lower(user_agent) LIKE '%{n}%' THEN '{n}'" for n in reversed(OS_NAMES))
    return f"CASE WHEN user_agent IS NULL THEN NULL {whens} ELSE '{OS_FALLBACK}' END"


# State codes cycled over customers; 'BR-XX' is not in the dimension.
STATE_CYCLE = [code for code, _ in STATE_REGION] + ["BR-XX"]


def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    codes = F.array(*[F.lit(s) for s in STATE_CYCLE])
    with_state = c.select(
        "c_custkey", F.element_at(codes, (F.pmod(F.col("c_custkey"), F.lit(len(STATE_CYCLE))) + 1).cast("int")).alias("state")
    )
    joined = attach_region(with_state, "state", "region")
    # the same lookup as a literal map (X13); must agree with the join
    return joined.select("c_custkey", "state", "region", region_of("state").alias("region_by_map"))


def _region_sql() -> str:
    values = ", ".join(f"('{s}', '{r}')" for s, r in STATE_REGION)
    cycle = ", ".join(f"'{s}'" for s in STATE_CYCLE)
    return f"""
SELECT c.c_custkey, c.state, d.region, d.region AS region_by_map
FROM (SELECT c_custkey, [{cycle}][(c_custkey % {len(STATE_CYCLE)}) + 1] AS state FROM customer) c
LEFT JOIN (VALUES {values}) d(state, region) ON c.state = d.state
"""


ORDERS_PROFILE_SQL = _profile_sql("orders", [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderpriority", "string")])

SQL = {
    "profile_incremental": f"SELECT ordinal, feature, dtype, is_categorical, is_binary, n_unique, min_value, max_value, null_share, 1::INTEGER AS within FROM ({ORDERS_PROFILE_SQL})",
    "column_profile": _profile_sql(CUSTOMER_SOURCE, CUSTOMER_PROFILE_COLS),
    "column_profile_lineitem": _profile_sql("lineitem", LINEITEM_PROFILE_COLS),
    "os_family": f"SELECT event_id, user_agent, {_os_case_sql()} AS os_family FROM (SELECT event_id, {UA_SQL} AS user_agent FROM events) t",
    "region_lookup": _region_sql(),
}

QUERIES = {
    "profile_incremental": profile_incremental,
    "column_profile": profile_customer,
    "column_profile_lineitem": profile_lineitem,
    "os_family": os_family_query,
    "region_lookup": region_lookup,
}
