"""Delivery job: source table -> audit columns -> JSON messages -> sink.

``build_messages`` is one plan: the source is scanned for the rows and, separately and
only for the row count, by a scalar subquery that Parquet answers from its footers.

``deliver_table`` counts rows where they are written. ``rows_written`` has to be in every
message, so it is known before: from the caller (``jdbc_row_count``), from the write of a
snapshot (``snapshot_path``, which a source that can change needs), or from a count. The
delivery's own plan then observes the rows it hands to the sink, without another scan,
and a difference stops the job: what was said in the messages is not what was sent.
The original job counted the table up to three times without a snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakeflux.operators.audit import DEFAULT_AUDIT, add_audit_columns
from lakeflux.sinks.messages import message_frame, write_messages


def build_messages(
    source: DataFrame,
    key_cols: Sequence[str] | None = None,
    topic: str | None = None,
    as_of: str | None = None,
    lossless: bool = False,
    **audit,
) -> DataFrame:
    enriched = add_audit_columns(source, as_of=as_of, **{**DEFAULT_AUDIT, **audit})
    return message_frame(enriched, key_cols=key_cols, topic=topic, lossless=lossless)


def deliver_table(
    source: DataFrame,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    snapshot_path: str | None = None,
    rows_written: int | None = None,
    **kwargs,
) -> dict[str, int]:
    """Deliver ``source`` as one JSON message per row; rows_written as the messages have it, and rows delivered.

    ``fmt="kafka"`` with ``kafka.bootstrap.servers`` and ``topic`` options
    needs the Kafka connector; any file format writes the messages to ``path``.
    Raises ``DeliveryMismatch`` if the two counts differ.
    """
    if snapshot_path is not None:
        copied, taken = _observed(source)
        copied.write.mode("overwrite").parquet(snapshot_path)
        source, rows_written = source.sparkSession.read.schema(source.schema).parquet(snapshot_path), taken.get["rows"]
    elif rows_written is None:
        rows_written = source.count()
    messages, sent = _observed(build_messages(source, rows_written=rows_written, **kwargs))
    write_messages(messages, fmt=fmt, options=options, path=path)
    delivered = sent.get["rows"]
    if delivered != rows_written:
        raise DeliveryMismatch(f"{delivered} rows were delivered, the messages say {rows_written}")
    return {"rows_written": rows_written, "delivered": delivered}


class DeliveryMismatch(RuntimeError):
    """The rows delivered are not as many as their messages say."""


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
