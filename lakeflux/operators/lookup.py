"""Dimension lookup (J4): attach a region to a state code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeflux.functions.lookup import region_dimension


def attach_region(df: DataFrame, state_col: str = "state", out_col: str = "region") -> DataFrame:
    """Left join with the fixed 27-row state dimension; unmatched codes get null.

    The dimension has a fixed, proven size, so it is broadcast: the fact side
    is never shuffled.
    """
    dim = region_dimension(df.sparkSession).withColumnRenamed("state", "__state").withColumnRenamed(
        "region", out_col
    )
    joined = df.join(F.broadcast(dim), F.col(state_col) == F.col("__state"), "left")
    return joined.drop("__state")
