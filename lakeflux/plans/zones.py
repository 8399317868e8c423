"""Zone job: processing-zone record files -> per-file head -> curated CSV.

Batch form of the landing -> processing -> curated flow. Every input file
gives its own output (the original job named all files of a run alike, so they
overwrote each other; here the output folder is keyed by the input file).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakeflux.operators.columns import select_columns
from lakeflux.operators.zones import head_per_file
from lakeflux.sinks.files import write_zone_csv
from lakeflux.sources.files import FILE_COL, POS_COL, dated_prefix, read_record_arrays, relative_to

# Record layout of the business files (the original test fixture).
BUSINESS_SCHEMA = StructType(
    [
        StructField("id", LongType()),
        StructField("user_id", LongType()),
        StructField("title", StringType()),
        StructField("body", StringType()),
    ]
)
ZONE_PREFIX = "business"


def select_head(records: DataFrame, keep: Sequence[str] = ("title", "body"), n: int = 5) -> DataFrame:
    """S2 -> L1 -> P2: first ``n`` records of each file, chosen columns."""
    head = head_per_file(records, n)
    return select_columns(head, [FILE_COL, POS_COL, *keep])


def curate(
    spark: SparkSession,
    processing_root: str,
    curated_root: str,
    ds: str,
    schema: StructType = BUSINESS_SCHEMA,
    keep: Sequence[str] = ("title", "body"),
    n: int = 5,
) -> str:
    """Read ``<processing>/business/<ds>/*.json``, write one CSV folder per
    input file under ``<curated>/business/<ds>/``; return that folder."""
    records = read_record_arrays(spark, dated_prefix(processing_root, ZONE_PREFIX, ds), schema)
    head = select_head(records, keep, n)
    folder = dated_prefix(processing_root, ZONE_PREFIX, ds)
    # one shuffle by file; each file's records in order
    out = head.withColumn("source_file", relative_to(folder)).repartition("source_file").sortWithinPartitions("source_file", POS_COL)
    target = dated_prefix(curated_root, ZONE_PREFIX, ds)
    write_zone_csv(out.select("source_file", *keep), target, partition_by=["source_file"])
    return target
