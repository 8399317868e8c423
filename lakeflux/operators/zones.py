"""Zone ETL operators: landing record files, per-file head (L1)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeflux.sources.files import FILE_COL, MAX_RECORD_FILE_BYTES, POS_COL

DEFAULT_RECORDS_PER_FILE = 1000


def hash_chunk(key: Column, n_chunks: Column) -> Column:
    """Stable chunk number in [0, n_chunks) from md5 of the key (engine-neutral)."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, n_chunks.cast("bigint"))


def head_per_file(records: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` records of every file, in file order (L1).

    Positions come from ``posexplode`` at read time, so this is a plain filter:
    no sort, no shuffle, and not a global ``limit``.
    """
    return records.where(F.col(POS_COL) < n)


def write_landing_records(
    df: DataFrame,
    path: str,
    file_key: str,
    order_col: str,
    record: dict[str, Column],
    records_per_file: int = DEFAULT_RECORDS_PER_FILE,
) -> str:
    """Write ``df`` as JSON record-array files: one folder per ``file_key``,
    split into ``ceil(count / records_per_file)`` files by a hash of
    ``order_col``; records inside a file are ordered by ``order_col``.

    Each file is one group of at most about ``records_per_file`` rows, so no
    task ever holds a whole hot key; the per-key counts are a small aggregate.
    """
    counts = df.groupBy(F.col(file_key).alias("__fk")).agg(F.count(F.lit(1)).alias("__cnt"))
    # null-safe: rows without a file key form their own file instead of vanishing
    with_n = df.join(counts, df[file_key].eqNullSafe(counts["__fk"])).drop("__fk")
    chunked = with_n.withColumn(
        "chunk", hash_chunk(F.col(order_col), F.ceil(F.col("__cnt") / F.lit(float(records_per_file))))
    )
    rec = F.struct(F.col(order_col).alias("__o"), F.struct(*[c.alias(k) for k, c in record.items()]).alias("__r"))
    files = chunked.groupBy(file_key, "chunk").agg(F.array_sort(F.collect_list(rec)).alias("__recs"))
    text = files.select(file_key, "chunk", F.to_json(F.col("__recs.__r")).alias("value"))
    text.write.mode("overwrite").partitionBy(file_key, "chunk").text(path)
    return path


def apply_per_file(
    raw: DataFrame, fn: Callable[[str, str], list[tuple]], schema: str, max_bytes: int = MAX_RECORD_FILE_BYTES
) -> DataFrame:
    """A Python callable over whole files (U2): ``fn(file, text)`` gives the rows of its file.

    raw is what ``whole_files`` reads; files are the unit of parallelism, and one beyond max_bytes raises.
    """
    fine = F.when(F.col("bytes") <= max_bytes, F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit("file beyond the size limit: "), F.col(FILE_COL)))
    )
    fields = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches):
        for pdf in batches:
            for file, text in zip(pdf["file"], pdf["value"]):
                yield pd.DataFrame(fn(file, text), columns=fields)

    return raw.select(FILE_COL, fine.alias("value")).mapInPandas(run, schema)
