"""JSON envelope helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Lossless mode keeps null fields and microsecond timestamps; the default
# mirrors Spark's ``to_json`` defaults (nulls dropped, milliseconds).
LOSSLESS_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def row_to_json(df: DataFrame, lossless: bool = False) -> Column:
    """Whole row as one JSON object text."""
    opts = LOSSLESS_OPTIONS if lossless else {}
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), opts)


def decode_json(value: str | Column, schema: StructType, lossless: bool = False) -> Column:
    """Inverse of :func:`row_to_json`."""
    col = F.col(value) if isinstance(value, str) else value
    opts = LOSSLESS_OPTIONS if lossless else {}
    return F.from_json(col, schema, opts)
