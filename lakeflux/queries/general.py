"""General operators: table functions, per-group Python, preview, dense
index, object names, labels and standard scores."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeflux.functions.numeric import round_half_even
from lakeflux.operators.features import standardize
from lakeflux.functions.text import day_folder, file_stamp, object_name
from lakeflux.operators.columns import add_label
from lakeflux.operators.grouped import grouped_partials
from lakeflux.operators.ordering import dense_index, preview
from lakeflux.queries.common import load


def _with_region(regions: DataFrame):
    def fn(df: DataFrame) -> DataFrame:
        # region is a 5-row dimension; AQE broadcasts it from its real size
        return df.join(regions, df["n_regionkey"] == regions["r_regionkey"], "left").drop("r_regionkey")

    return fn


def _name_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"name_upper": F.upper("n_name"), "name_len": F.length("n_name")})


def table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-table functions chained with ``DataFrame.transform``."""
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    return nation.transform(_with_region(region)).transform(_name_features)


def _turn_partials(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per conversation inside one Arrow batch: turns, user turns, characters."""
    chars = pdf["text"].fillna("").str.len()
    g = pd.DataFrame(
        {
            "conv_id": pdf["conv_id"],
            "turns": 1,
            "user_turns": (pdf["role"] == "user").astype("int64"),
            "assistant_turns": (pdf["role"] == "assistant").astype("int64"),
            "chars": chars.astype("int64"),
            "last_turn": pdf["turn"].astype("int64"),
        }
    ).groupby("conv_id", as_index=False)
    return g.agg(
        turns=("turns", "sum"),
        user_turns=("user_turns", "sum"),
        assistant_turns=("assistant_turns", "sum"),
        chars=("chars", "sum"),
        last_turn=("last_turn", "max"),
    )


def per_group_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = load(spark, sf_dir, "conversations")
    return grouped_partials(
        conv.select("conv_id", "turn", "role", "text"),
        "conv_id",
        _turn_partials,
        "conv_id bigint, turns bigint, user_turns bigint, assistant_turns bigint, chars bigint, last_turn bigint",
        {
            "turns": F.sum,
            "user_turns": F.sum,
            "assistant_turns": F.sum,
            "chars": F.sum,
            "last_turn": F.max,
        },
    ).select(
        "conv_id",
        *[F.col(c).cast("bigint").alias(c) for c in ("turns", "user_turns", "assistant_turns", "chars", "last_turn")],
    )


def preview_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(load(spark, sf_dir, "orders"), ["o_orderkey"], 5)


def dense_index_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    return dense_index(part, ["p_partkey"], "row_index")


def stamp_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        day_folder("ts").alias("day_folder"),
        file_stamp("ts").alias("file_stamp"),
        object_name("business", F.col("ts")).alias("object_name"),
    )


def standard_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    scaled = standardize(part.select("p_partkey", "p_size", F.col("p_retailprice").alias("z")), ["z"])
    z = F.col("z")
    labelled = add_label(scaled, "is_large", (F.col("p_size") > 25).cast("int"))
    return labelled.select("p_partkey", "is_large", round_half_even(z, 4).alias("price_z"))


SQL = {
    "table_function": """
SELECT n.n_nationkey, n.n_name, n.n_regionkey, r.r_name, upper(n.n_name) AS name_upper,
       CAST(length(n.n_name) AS INTEGER) AS name_len
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""",
    "per_group_python": """
SELECT conv_id, count(*)::BIGINT AS turns,
       count(*) FILTER (WHERE role = 'user')::BIGINT AS user_turns,
       count(*) FILTER (WHERE role = 'assistant')::BIGINT AS assistant_turns,
       sum(length(coalesce(text, '')))::BIGINT AS chars, max(turn)::BIGINT AS last_turn
FROM conversations GROUP BY conv_id
""",
    "preview_topk": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "dense_index": "SELECT p_partkey, p_name, (row_number() OVER (ORDER BY p_partkey) - 1)::BIGINT AS row_index FROM part",
    "stamp_names": """
SELECT event_id, strftime(ts, '%Y%m%d') AS day_folder, strftime(ts, '%Y-%m-%d_%Hh%Mm%Ss%f') AS file_stamp,
       'business/' || strftime(ts, '%Y%m%d') || '/business-' || strftime(ts, '%Y-%m-%d_%Hh%Mm%Ss%f') || '.csv' AS object_name
FROM events
""",
    "standard_label": """
WITH s AS (SELECT avg(p_retailprice) m, coalesce(nullif(stddev_pop(p_retailprice), 0), 1) sd FROM part)
SELECT p_partkey, CAST(p_size > 25 AS INTEGER) AS is_large, round_even((p_retailprice - m) / sd, 4) AS price_z
FROM part, s
""",
}

QUERIES = {
    "table_function": table_function,
    "per_group_python": per_group_python,
    "preview_topk": preview_topk,
    "dense_index": dense_index_query,
    "stamp_names": stamp_names,
    "standard_label": standard_label,
}
