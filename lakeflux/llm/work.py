"""Shared steps: written intermediate tables, row keys, and a fixed-size key filter."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeflux.llm import textblocks as T
from lakeflux.session import work_dir

#: Stands for a null doc_id inside the operators; it sorts first.
NULL_ID = -(1 << 63)
#: Bits of a key filter: 1 MB, whatever the number of keys.
FILTER_BITS = 23
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write the rows as Parquet to the shared work folder and read them back.

    Cuts lineage, survives lost executors, and makes what depends on task order
    (partition numbers, ranks within a task) the same for every later reader.
    batch_rows: at most so many rows go to a Python function at once, where rows are long.
    """
    path = work_dir(df.sparkSession, name)
    conf = df.sparkSession.conf
    now = {_CLEAN_UP: "true"}  # the written table stands in for the shuffles that made it
    if batch_rows:
        most = int(conf.get(_BATCH, "10000"))
        now[_BATCH] = str(min(batch_rows, most) if most > 0 else batch_rows)
    before = {k: conf.get(k, None) for k in now}
    for k, v in now.items():
        conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def doc_key() -> Column:
    """doc_id as a long that is never null."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def text_key() -> Column:
    """Tells rows apart that share a doc_id but not their text; rows alike in both are one document."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, tkey, text) of every row; a null text is empty."""
    return docs.select(doc_key().alias("doc"), text_key().alias("tkey"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def id_back(c: str) -> Column:
    """The doc_id that doc_key made."""
    return F.when(F.col(c) != NULL_ID, F.col(c))


def attach(docs: DataFrame, found: DataFrame, how: str = "left") -> DataFrame:
    """The rows of docs with their columns of found(doc, tkey, ...); none is matched on a column of its own of that name."""
    names = {c: f"__llm_{c}" for c in found.columns}
    left = docs.withColumn("__llm_key_doc", doc_key()).withColumn("__llm_key_tkey", text_key())
    right = found.select([F.col(c).alias(n) for c, n in names.items()])
    on = (F.col("__llm_key_doc") == F.col("__llm_doc")) & (F.col("__llm_key_tkey") == F.col("__llm_tkey"))
    return left.join(right, on, how)


def key_bitmap(keys: DataFrame, column: str, hashed: bool = False) -> np.ndarray:
    """Bits of the keys' hashes, built by Spark's bitmap aggregate; always 2**FILTER_BITS bits. hashed: the keys are hashes."""
    slot = F.pmod(F.col(column) if hashed else F.xxhash64(column), F.lit(1 << FILTER_BITS)) + 1  # the aggregate counts from 1
    rows = keys.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m")).collect()
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in rows:  # at most 2**FILTER_BITS / 32768 rows
        part = np.frombuffer(r.m, np.uint8)
        out[(r.b - 1) * len(part) : r.b * len(part)] = part
    return out


def maybe_in(df: DataFrame, column: str, keys: DataFrame, key_column: str) -> DataFrame:
    """Rows whose key may be among the keys: a cheap filter before an exact join, never in its place."""
    bits = df.sparkSession.sparkContext.broadcast(key_bitmap(keys, key_column))

    @F.pandas_udf("boolean")
    def held(slot: pd.Series) -> pd.Series:
        s = slot.to_numpy()
        return pd.Series((bits.value[s >> 3] >> (s & 7).astype(np.uint8)) & 1 == 1)

    return df.where(held(F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))))


def released(run: Callable) -> Callable:
    """The task function of a mapInArrow, which hands its free memory back to the system when a task ends.

    Spark reuses Python workers, so what one task's allocators keep would add to the next one's.
    """

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            T.release_tables()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return tidy


def sorted_groups(batches, n_keys: int):
    """Record batches of the rows of one group each; rows come sorted by their first n_keys columns."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        if not table.num_rows:
            continue
        held = table.to_batches()[0]
        key = np.stack([held.column(k).to_numpy() for k in range(n_keys)])
        begin = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(0))).tolist()
        for a, b in zip(begin, begin[1:]):
            yield held.slice(a, b - a)
        held = held.slice(begin[-1])  # may go on
    if held is not None:
        yield held
