"""Warehouse table sink (K4) with a load type.

``fmt="staged"`` writes files behind a commit (``staged``): a failed job leaves the table as
it was. ``fmt="jdbc"`` (or a warehouse connector format such as ``snowflake``) writes to
``<owner>.<table>`` with the given connection options; file formats (parquet,
delta) write to ``<root>/<owner>/<table>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeflux.sinks.staged import write_staged

LOAD_TYPES = ("overwrite", "append")
# JDBC writer defaults: batched inserts, and an overwrite that truncates the
# table instead of dropping it (keeps grants and column types).
JDBC_WRITE_DEFAULTS = {"batchsize": "10000", "truncate": "true"}


def write_warehouse(
    df: DataFrame,
    owner: str,
    table: str,
    load_type: str = "overwrite",
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    root: str | None = None,
    num_writers: int | None = None,
) -> str:
    """``num_writers`` caps concurrent connections for JDBC targets; a shuffle keeps
    the work before the write at its own parallelism."""
    if load_type not in LOAD_TYPES:
        raise ValueError(f"load_type must be one of {LOAD_TYPES}")
    if fmt == "staged":
        if root is None:
            raise ValueError("file formats need a root folder")
        return write_staged(df, f"{root.rstrip('/')}/{owner}/{table}", load_type, (options or {}).get("batch"))
    file_format = fmt in ("parquet", "delta", "orc")
    if num_writers and not file_format:
        df = df.repartition(num_writers)
    opts = dict(options or {})
    if fmt == "jdbc":
        opts = {**JDBC_WRITE_DEFAULTS, **opts}
    writer = df.write.format(fmt).mode(load_type).options(**opts)
    if file_format:
        if root is None:
            raise ValueError("file formats need a root folder")
        target = f"{root.rstrip('/')}/{owner}/{table}"
        writer.save(target)
        return target
    target = f"{owner}.{table}"
    writer.option("dbtable", target).save()
    return target
