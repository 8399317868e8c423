"""Feature statistics, standardisation, seeded split and label join
(A7, F1, F2, J1, K7 layout)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeflux.functions.numeric import standard_score
from lakeflux.operators.keyed import full_checked

SPLIT_COL = "split"


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and population std per feature (A7), one row per feature.

    One aggregate pass for all features; the result is reshaped with
    ``inline`` (no second scan).
    """
    aggs = []
    for i, name in enumerate(features):
        aggs += [F.avg(F.col(name)).alias(f"m{i}"), F.stddev_pop(F.col(name)).alias(f"s{i}")]
    return df.agg(*aggs).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("ordinal"),
                        F.lit(name).alias("feature"),
                        F.col(f"m{i}").alias("mean"),
                        F.col(f"s{i}").alias("std"),
                    )
                    for i, name in enumerate(features)
                ]
            )
        )
    )


def fit_scaler(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and population std of every feature from one aggregate job; the
    result is one row (two numbers per feature)."""
    aggs = []
    for i, name in enumerate(features):
        aggs += [F.avg(F.col(name)).alias(f"m{i}"), F.stddev_pop(F.col(name)).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {name: (row[f"m{i}"], row[f"s{i}"]) for i, name in enumerate(features)}


def standardize(
    df: DataFrame,
    features: Sequence[str],
    fit_on: DataFrame | None = None,
    scaler: dict[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Replace each feature by its standard score (F1).

    Mean and *population* std come from ``scaler`` or are fitted on
    ``fit_on`` (default: all rows of ``df``) with one aggregate job; the
    scaling itself is then a map-only projection against literals. A zero
    std divides by 1 (trap T1).
    """
    stats = scaler if scaler is not None else fit_scaler(df if fit_on is None else fit_on, features)
    replaced = {}
    for name in features:
        mean, std = stats[name]
        replaced[name] = standard_score(F.col(name), F.lit(mean).cast("double"), F.lit(std).cast("double"))
    return df.withColumns(replaced)


def _hex_prefix_int(h: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(h, start, digits), 16, 10).cast("int")


def _boundary(counts: DataFrame, bucket: str, need: int | None = None, fraction: float | None = None):
    """Bucket holding the ``need``-th row in bucket order (``need`` given, or
    ``ceil(fraction * total)``), the rank inside it, and ``need`` itself.

    ``counts`` has at most 16**digits rows, so the running sum runs on a small
    table and only one row (three numbers) comes back.
    """
    w = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = F.lit(need) if need is not None else F.ceil(F.lit(float(fraction)) * F.sum("__cnt").over(total))
    cum = counts.select(
        bucket,
        F.sum("__cnt").over(w).alias("__cum"),
        (F.sum("__cnt").over(w) - F.col("__cnt")).alias("__before"),
        want.cast("bigint").alias("__need"),
    )
    hit = cum.where((F.col("__before") < F.col("__need")) & (F.col("__cum") >= F.col("__need"))).select(
        bucket, (F.col("__need") - F.col("__before")).alias("rank")
    ).first()
    return (None, None) if hit is None else (int(hit[0]), int(hit[1]))


def seeded_split(
    df: DataFrame,
    key: str,
    test_fraction: float = 0.2,
    seed: int = 42,
    digits: int = 4,
) -> DataFrame:
    """Exact, seeded, disjoint and complete train/test split (F2).

    Rows are ranked by ``md5("<key>:<seed>")``; the first
    ``ceil(test_fraction * n)`` rows form the test set. The rank is never
    computed globally: rows are counted per hash bucket (first ``digits`` hex
    digits, at most 16**digits buckets), a running sum over that small table
    finds the bucket holding the boundary, a second level does the same inside
    that bucket with the next digits, and a third finds the last hash of the
    test set. These small aggregates over the key column run first; the split
    itself is one map-only projection against that hash.

    Rows of one key always share a side. Where the boundary would cut through
    them the split is not exact and a ``ValueError`` says so.
    """
    # a null key hashes like the empty string, so no row is ever lost
    h = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}")))
    keys = df.select(h.alias("__h")).withColumns(
        {"__b1": _hex_prefix_int(F.col("__h"), 1, digits), "__b2": _hex_prefix_int(F.col("__h"), 1 + digits, digits)}
    )
    counts1 = keys.groupBy("__b1").agg(F.count(F.lit(1)).alias("__cnt"))
    b1, need1 = _boundary(counts1, "__b1", fraction=test_fraction)
    if b1 is None:  # empty test set (or empty input): everything is train
        return df.withColumn(SPLIT_COL, F.lit("train"))
    inside = keys.where(F.col("__b1") == b1)
    b2, need2 = _boundary(inside.groupBy("__b2").agg(F.count(F.lit(1)).alias("__cnt")), "__b2", need=need1)
    # the hashes of one final sub-bucket: about n / 16**(2 * digits) rows
    last = inside.where(F.col("__b2") == b2).groupBy("__h").agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.orderBy("__h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = last.select("__h", F.sum("__cnt").over(w).alias("__upto"))
    boundary = reach.where(F.col("__upto") >= need2).orderBy("__upto").first()
    if boundary["__upto"] != need2:
        raise ValueError(f"the split boundary lies among rows of one {key!r}: the key must be unique")
    return df.withColumn(SPLIT_COL, F.when(h <= boundary["__h"], "test").otherwise("train"))


def expected_test_size(n: int, test_fraction: float = 0.2) -> int:
    return int(math.ceil(test_fraction * n))


def attach_label(features_df: DataFrame, labels_df: DataFrame, key: str) -> DataFrame:
    """Key-aligned column concat of features and label (J1): full outer join; a repeated key raises."""
    return full_checked(features_df, labels_df, key)
