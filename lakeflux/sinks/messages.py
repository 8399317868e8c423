"""Message sink (K1): one message per row, JSON text in ``value``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeflux.functions.jsonfmt import row_to_json
from lakeflux.operators.audit import to_envelope


def message_frame(
    df: DataFrame, key_cols: Sequence[str] | None = None, topic: str | None = None, lossless: bool = False
) -> DataFrame:
    """``value`` (+ optional ``key`` and ``topic``) as the Kafka writer expects.

    One key column is the key itself (a null stays null); several are a JSON object with
    their nulls, so that different rows never get one key."""
    out = to_envelope(df, lossless)
    if key_cols:
        cols = [F.col(f"`{k}`").cast("string").alias(k) for k in key_cols]
        key = cols[0] if len(cols) == 1 else F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
        out = df.select(key.alias("key"), row_to_json(df, lossless).alias("value"))
    if topic is not None:
        out = out.withColumn("topic", F.lit(topic))
    return out


def write_messages(frame: DataFrame, fmt: str = "kafka", options: dict[str, str] | None = None, path: str | None = None) -> None:
    """Batch write of the message frame.

    ``fmt="kafka"`` needs the Kafka connector on the classpath and options
    ``kafka.bootstrap.servers`` and ``topic`` (or a ``topic`` column). Any
    other format (text, parquet) writes the same frame to ``path``.
    """
    writer = frame.write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("append").save(path)
