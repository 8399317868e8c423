"""Audit-column enrichment and the JSON message envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeflux.functions.jsonfmt import row_to_json

# --- fixed values -----------------------------------------------------------
# Audit column names, in the order they are appended.
AUDIT_COLUMNS = [
    "ingestion_time",
    "source_system",
    "user_name",
    "ingestion_type",
    "base_format",
    "rows_written",
    "schema",
]
# Literal defaults used by the original delivery job.
DEFAULT_AUDIT = {
    "source_system": "sap",
    "user_name": "airflow",
    "ingestion_type": "spark",
    "base_format": "table",
}
# ---------------------------------------------------------------------------


def row_count(df: DataFrame) -> Column:
    """Row count of ``df`` as a scalar-subquery column (A1 + J3).

    Spark runs the aggregate once (partial counts per task, one final merge)
    and inlines the result into every row; no join, no window over all rows.
    """
    return df.agg(F.count(F.lit(1)).alias("rows_written")).scalar()


def add_audit_columns(
    df: DataFrame,
    source_system: str = DEFAULT_AUDIT["source_system"],
    user_name: str = DEFAULT_AUDIT["user_name"],
    ingestion_type: str = DEFAULT_AUDIT["ingestion_type"],
    base_format: str = DEFAULT_AUDIT["base_format"],
    as_of: str | None = None,
    rows_written: int | None = None,
) -> DataFrame:
    """Append the seven audit columns.

    ``ingestion_time`` is ``current_timestamp()`` (one value per query) unless a
    fixed ``as_of`` timestamp text is given. ``rows_written`` is a bigint, counted
    here unless the caller has it from the source (``jdbc_row_count``), and
    ``schema`` is the JSON schema of the *input* frame.
    """
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumns(
        {
            "ingestion_time": ts,
            "source_system": F.lit(source_system),
            "user_name": F.lit(user_name),
            "ingestion_type": F.lit(ingestion_type),
            "base_format": F.lit(base_format),
            "rows_written": (row_count(df) if rows_written is None else F.lit(rows_written)).cast("bigint"),
            "schema": F.lit(df.schema.json()),
        }
    )


def to_envelope(df: DataFrame, lossless: bool = False) -> DataFrame:
    """One JSON text per row in column ``value`` (X8 + P7)."""
    return df.select(row_to_json(df, lossless).alias("value")).selectExpr("CAST(value AS STRING) AS value")
