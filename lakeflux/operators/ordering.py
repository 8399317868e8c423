"""Preview (L2) and dense row index (L3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by key: a top-k (TakeOrderedAndProject), not a full sort."""
    return df.orderBy(*order_by).limit(n)


def dense_index(df: DataFrame, order_by: Sequence[str], index_col: str = "row_index", num_partitions: int | None = None) -> DataFrame:
    """0..n-1 in key order without a single-partition window (L3); rows with
    equal keys get consecutive indexes in an unspecified order.

    The frame is range-partitioned and sorted inside partitions, then
    checkpointed to the shared checkpoint folder so partition ids and row order
    are fixed. Row counts per partition (one row per partition) give offsets by
    a running sum; each row's index is its partition offset plus its position
    inside the partition, read from ``monotonically_increasing_id``.
    """
    spark = df.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # tie-breakers let the range partitioner split a key that holds many rows
    # (ties are ordered by row hash, then scan position)
    keyed = df.withColumns(
        {"__tie": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), "__seq": F.monotonically_increasing_id()}
    )
    order = [*order_by, "__tie", "__seq"]
    ranged = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    fixed = ranged.checkpoint(eager=True).drop("__tie", "__seq")
    tagged = fixed.withColumn("__mid", F.monotonically_increasing_id()).withColumn(
        "__pid", F.shiftright(F.col("__mid"), LOCAL_BITS)
    )
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("__pid", (F.sum("__cnt").over(w) - F.col("__cnt")).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col("__pid"), LOCAL_BITS)
    # one row per partition: bounded by the partition count, safe to broadcast
    out = tagged.join(F.broadcast(offsets), "__pid").withColumn(index_col, (F.col("__off") + local).cast("bigint"))
    return out.drop("__mid", "__pid", "__off")
