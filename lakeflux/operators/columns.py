"""Projection and row-filter operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Column subset (P2); a missing column raises, as an index lookup would."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*[F.col(f"`{n}`") for n in names])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Column drop (P3); a missing column raises."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*names)


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def lower_case_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name (P5); two names that collide raise."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        raise ValueError(f"lower-casing makes duplicate names: {lowered}")
    return df.toDF(*lowered)


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows whose values are all null (P6); float NaN counts as null."""
    return df.dropna(how="all")


def add_label(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a label column."""
    return df.withColumn(name, value)
