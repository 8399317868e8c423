"""Column profile kept by partition (A3, A6): a new day profiles only itself.

A part is a small table, one row a column: rows, nulls, least and greatest value, and a theta
sketch of the distinct values. Parts merge without the rows behind them (counts add, ends take
the extreme, sketches unite), so the profile of a table of many days is one look at that many
small rows. Parts are kept by ``snapshot_log`` entries of a store's folder: a day that is
profiled again replaces its own part.

The exact mode is ``column_profile``. A sketch of 2^k entries is exact up to that many distinct
values and beyond has a relative standard error of 1 / sqrt(2^k), whatever the size; k is a
parameter and never chosen by size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, FloatType, NumericType

from lakeflux.functions.numeric import nan_to_null
from lakeflux.operators.profile import TEXT_TYPES
from lakeflux.sources import snapshot_log

LOG_ENTRIES = 14
PART = "ordinal int, feature string, dtype string, is_categorical int, n long, nulls long, min_value double, max_value double, sketch binary"


def distinct_error(log_entries: int = LOG_ENTRIES) -> float:
    """Relative error of a distinct count that three standard errors bound."""
    return 3 / math.sqrt(1 << log_entries)


def profile_part(df: DataFrame, features: Sequence[str] | None = None, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """One row a column, from one aggregate over the frame: combined in the tasks, so no value is shuffled."""
    features = list(features if features is not None else df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(features):
        kind = types[name]
        c = nan_to_null(F.col(f"`{name}`"), kind)
        value = c.cast("double") + F.lit(0.0) if isinstance(kind, (DoubleType, FloatType)) else c if isinstance(kind, BinaryType) else c.cast("string")
        ranged = isinstance(kind, (NumericType, BooleanType))
        end = lambda agg: agg(c.cast("double")) if ranged else F.lit(None).cast("double")  # noqa: B023, E731
        aggs += [
            F.count_if(c.isNull()).alias(f"nulls{i}"), end(F.min).alias(f"min{i}"), end(F.max).alias(f"max{i}"), F.theta_sketch_agg(value, log_entries).alias(f"sketch{i}"),
        ]
    items = [
        F.struct(
            F.lit(i).alias("ordinal"), F.lit(name).alias("feature"), F.lit(types[name].simpleString()).alias("dtype"), F.lit(int(isinstance(types[name], TEXT_TYPES))).alias("is_categorical"),
            F.col("n"), F.col(f"nulls{i}").alias("nulls"), F.col(f"min{i}").alias("min_value"), F.col(f"max{i}").alias("max_value"), F.col(f"sketch{i}").alias("sketch"),
        )
        for i, name in enumerate(features)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*items)))


def merge_parts(parts: DataFrame, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """One part of all rows behind parts of the same columns."""
    return parts.groupBy("ordinal", "feature", "dtype", "is_categorical").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), F.theta_union_agg("sketch", log_entries).alias("sketch")
    )


def as_profile(part: DataFrame) -> DataFrame:
    """The part as ``column_profile`` has it: distinct counts estimated, without exact ends as text."""
    n_unique = F.theta_sketch_estimate("sketch")
    return part.select(
        "ordinal", "feature", "dtype", "is_categorical",
        F.when((F.col("is_categorical") == 1) & (n_unique == 2), 1).otherwise(0).alias("is_binary"),
        n_unique.alias("n_unique"), "min_value", "max_value",
        F.bround(F.try_divide(F.col("nulls").cast("double"), F.nullif(F.col("n"), F.lit(0))), 4).alias("null_share"),
    )


def store_part(df: DataFrame, table: str, run, features: Sequence[str] | None = None, log_entries: int = LOG_ENTRIES) -> int:
    """Profile a run's rows and keep the part under the run; a run that comes again replaces it."""
    return snapshot_log.publish(profile_part(df, features, log_entries), table, run)


def stored_profile(spark: SparkSession, table: str, as_of=None, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """The profile of all runs not after ``as_of``, from their parts alone."""
    until = None if as_of is None else snapshot_log.run_key(as_of)
    newest: dict = {}
    for entry in snapshot_log.snapshots(spark, table):  # by version: the last part of a run counts
        key = snapshot_log.run_key(entry["run"])
        if until is None or key <= until:
            newest[key] = entry["data"]
    if not newest:
        raise FileNotFoundError(f"no part in {table}" + ("" if as_of is None else f" as of {as_of}"))
    parts = spark.read.schema(PART).parquet(*[f"{table}/{d}" for d in newest.values()])
    return as_profile(merge_parts(parts, log_entries))
