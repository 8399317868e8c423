"""Column profile (A1-A6): one output row per profiled column.

Output columns: ``ordinal`` (position in the requested list), ``feature``,
``dtype`` (Spark simple type), ``is_categorical`` (text type), ``is_binary``
(text type with exactly two distinct values), ``n_unique`` (distinct non-null
values), ``min_value`` / ``max_value`` (numeric and boolean columns, as double;
null for others), ``min_text`` / ``max_text`` (whole numbers, decimals, dates and
timestamps exactly, as text; null for others), ``null_share`` (nulls and NaN over rows, banker's rounding to 4
places; null on an empty frame).

Plan: one aggregate pass computes row count, null counts, min and max for all
columns together (partial aggregation per task, one tiny final merge). Distinct
counts use an unpivot to ``(ordinal, value)`` and a two-level aggregation, so a
wide table does not multiply rows through Spark's Expand for every distinct
aggregate, and a hot value collapses in the map-side partial aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    IntegerType,
    LongType,
    ShortType,
    CharType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
    VarcharType,
)

from lakeflux.functions.numeric import nan_to_null

TEXT_TYPES = (StringType, VarcharType, CharType)


def _is_text(dt) -> bool:
    return isinstance(dt, TEXT_TYPES)


def _has_range(dt) -> bool:
    return isinstance(dt, (NumericType, BooleanType))


def _exact_text(c, dt):
    """An exact value as text, or null for types that have none (floating point, text, nested)."""
    if isinstance(dt, (ByteType, ShortType, IntegerType, LongType, DecimalType, DateType)):
        return c.cast("string")
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return None


def column_profile(
    df: DataFrame, features: Sequence[str] | None = None, approx_distinct: bool = False, rsd: float = 0.01
) -> DataFrame:
    """Profile ``features`` (default: all columns). ``approx_distinct`` swaps
    the exact distinct pass for HyperLogLog++ sketches in the single aggregate
    pass (relative error ``rsd``): one scan, no shuffle of values."""
    spark = df.sparkSession
    features = list(features if features is not None else df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    for name in features:
        if name not in types:
            raise KeyError(f"column not found: {name}")

    cleaned = df.select(
        *[nan_to_null(F.col(f"`{n}`"), types[n]).alias(f"c{i}") for i, n in enumerate(features)]
    )

    # pass 1: row count, null count, min, max for every column at once
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(features):
        c = F.col(f"c{i}")
        aggs.append(F.count_if(c.isNull()).alias(f"nulls{i}"))
        if approx_distinct:
            aggs.append(F.approx_count_distinct(c, rsd).alias(f"nd{i}"))
        if _has_range(types[name]):
            aggs.append(F.min(c).cast("double").alias(f"min{i}"))
            aggs.append(F.max(c).cast("double").alias(f"max{i}"))
        else:
            aggs.append(F.lit(None).cast("double").alias(f"min{i}"))
            aggs.append(F.lit(None).cast("double").alias(f"max{i}"))
        for end, agg in (("lo", F.min), ("hi", F.max)):
            text = _exact_text(agg(c), types[name])
            aggs.append((F.lit(None).cast("string") if text is None else text).alias(f"{end}{i}"))
    totals = cleaned.agg(*aggs)
    per_col = totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("ordinal"),
                        F.col("n").alias("n"),
                        F.col(f"nulls{i}").alias("nulls"),
                        F.col(f"min{i}").alias("min_value"),
                        F.col(f"max{i}").alias("max_value"),
                        F.col(f"lo{i}").alias("min_text"),
                        F.col(f"hi{i}").alias("max_text"),
                        (F.col(f"nd{i}") if approx_distinct else F.lit(None).cast("long")).alias("approx_n"),
                    )
                    for i in range(len(features))
                ]
            )
        )
    )

    # pass 2: distinct non-null values per column via unpivot + two-level agg.
    # Values keep their type in one of three slots (integral, floating, other
    # as text), so numbers are never formatted as strings.
    def slots(i: int, name: str):
        c = F.col(f"c{i}")
        dt = types[name]
        if isinstance(dt, (ByteType, ShortType, IntegerType, LongType)):
            return c.cast("long"), F.lit(None).cast("double"), F.lit(None).cast("string")
        if isinstance(dt, (DoubleType, FloatType)):
            # -0.0 and 0.0 are one value
            return F.lit(None).cast("long"), c.cast("double") + F.lit(0.0), F.lit(None).cast("string")
        return F.lit(None).cast("long"), F.lit(None).cast("double"), c.cast("string")

    items = []
    for i, name in enumerate(features):
        lv, dv, sv = slots(i, name)
        items.append(F.struct(F.lit(i).alias("ordinal"), lv.alias("lv"), dv.alias("dv"), sv.alias("sv")))
    stacked = cleaned.select(F.inline(F.array(*items))).where(
        F.col("lv").isNotNull() | F.col("dv").isNotNull() | F.col("sv").isNotNull()
    )
    distinct_counts = stacked.distinct().groupBy("ordinal").agg(F.count(F.lit(1)).alias("n_unique"))
    if approx_distinct:
        distinct_counts = per_col.select("ordinal", F.col("approx_n").alias("n_unique"))

    meta = spark.createDataFrame(
        [
            (i, name, types[name].simpleString(), 1 if _is_text(types[name]) else 0)
            for i, name in enumerate(features)
        ],
        "ordinal int, feature string, dtype string, is_categorical int",
    )

    joined = meta.join(per_col, "ordinal", "left").join(distinct_counts, "ordinal", "left")
    n_unique = F.coalesce(F.col("n_unique"), F.lit(0)).cast("bigint")
    return joined.select(
        F.col("ordinal").cast("int").alias("ordinal"),
        "feature",
        "dtype",
        F.col("is_categorical").cast("int").alias("is_categorical"),
        F.when((F.col("is_categorical") == 1) & (n_unique == 2), 1).otherwise(0).cast("int").alias("is_binary"),
        n_unique.alias("n_unique"),
        "min_value",
        "max_value",
        "min_text",
        "max_text",
        F.bround(F.try_divide(F.col("nulls").cast("double"), F.nullif(F.col("n"), F.lit(0))), 4).alias(
            "null_share"
        ),
    )
