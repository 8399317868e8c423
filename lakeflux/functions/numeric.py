"""Numeric helpers (X6, X7) and NaN handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def nan_to_null(c: Column, data_type) -> Column:
    """Float NaN counts as missing (pandas semantics); Spark sorts NaN as largest."""
    if isinstance(data_type, (DoubleType, FloatType)):
        return F.when(F.isnan(c), F.lit(None).cast(data_type)).otherwise(c)
    return c


def round_half_even(c: Column, scale: int = 4) -> Column:
    """Banker's rounding, as pandas/numpy round."""
    return F.bround(c, scale)


def standard_score(x: Column, mean: Column, std: Column) -> Column:
    """(x - mean) / std with a zero (or null) std treated as 1 (X7, trap T1)."""
    safe = F.coalesce(F.nullif(std, F.lit(0.0)), F.lit(1.0))
    return (x - mean) / safe
