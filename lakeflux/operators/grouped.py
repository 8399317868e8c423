"""Per-group Python logic that survives hot keys.

``applyInPandas`` hands a whole group to one Python worker, which breaks
when one key holds a large share of the rows. Here the Python function sees
Arrow batches through ``mapInPandas`` and returns *partial* results per key;
Spark then merges the partials with an ordinary (partial + final) aggregate,
so a hot key is spread over every task that holds some of its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame


def grouped_partials(
    df: DataFrame,
    key: str,
    partial_fn: Callable[[pd.DataFrame], pd.DataFrame],
    partial_schema: str,
    merge: dict[str, Callable[[str], Column]],
) -> DataFrame:
    """Apply ``partial_fn`` to every Arrow batch (grouped by ``key`` inside the
    batch), then merge per key with ``merge`` (column -> aggregate builder)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield partial_fn(pdf)

    partials = df.mapInPandas(run, partial_schema)
    return partials.groupBy(key).agg(*[agg(col).alias(col) for col, agg in merge.items()])
