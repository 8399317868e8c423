"""Two tables that should have one row a key each, paired in one pass that proves it.

A join hides what does not fit: a key on one side vanishes, a repeated one multiplies rows.
Here both sides are unioned and grouped by key once. A key with one row on each side is
matched; every other one has a reason, and its rows' counts. Groups are counts and one row a
side, combined before the shuffle, so a key of very many rows is no hot group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakeflux.session import work_dir

# reasons, in the order in which they are tested
NULL_KEY, REPEATED_BOTH, REPEATED_LEFT, REPEATED_RIGHT, LEFT_ONLY, RIGHT_ONLY = (
    "null key", "repeated on both sides", "repeated on the left", "repeated on the right", "left only", "right only",
)


def classify(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, n_left, n_right, l, r, reason): one row a key; l and r are a row of each side without its key."""
    side = lambda df, name: df.select(F.col(key), F.struct(*[df[c] for c in df.columns if c != key]).alias(name))
    both = side(left, "l").withColumn("n_left", F.lit(1)).unionByName(side(right, "r").withColumn("n_right", F.lit(1)), allowMissingColumns=True)
    grouped = both.groupBy(key).agg(
        F.count("n_left").alias("n_left"), F.count("n_right").alias("n_right"), F.any_value("l", ignoreNulls=True).alias("l"), F.any_value("r", ignoreNulls=True).alias("r")
    )
    n, m = F.col("n_left"), F.col("n_right")
    reason = (
        F.when(F.col(key).isNull(), NULL_KEY)
        .when((n > 1) & (m > 1), REPEATED_BOTH)
        .when(n > 1, REPEATED_LEFT)
        .when(m > 1, REPEATED_RIGHT)
        .when(m == 0, LEFT_ONLY)
        .when(n == 0, RIGHT_ONLY)
    )
    return grouped.withColumn("reason", reason)


def _stop(key: str, what: str):
    return F.raise_error(F.concat(F.lit(f"{what}: {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(" is "), F.col("reason")))


def matched(classified: DataFrame, key: str, on_bad: str = "fail") -> DataFrame:
    """Key and both sides' columns of matched keys; any other key raises (``fail``) or is left to ``rejects`` (``reject``)."""
    if on_bad not in ("fail", "reject"):
        raise ValueError("on_bad is fail or reject")
    fine = F.col("reason").isNull()
    kept = classified.where(fine if on_bad == "reject" else F.when(fine, F.lit(True)).otherwise(_stop(key, "keys do not match").cast("boolean")))
    return kept.select(key, "l.*", "r.*")


def rejects(classified: DataFrame, key: str) -> DataFrame:
    """(key, reason, n_left, n_right) of the keys that do not match."""
    return classified.where(F.col("reason").isNotNull()).select(key, "reason", "n_left", "n_right")


def pair_checked(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Matched rows, rejects, and the number of keys of each kind; the pairing runs once and is written to the shared work folder."""
    kinds = {"matched": None, **{r.replace(" ", "_"): r for r in (NULL_KEY, REPEATED_BOTH, REPEATED_LEFT, REPEATED_RIGHT, LEFT_ONLY, RIGHT_ONLY)}}
    seen = Observation()
    counts = [F.count_if(F.col("reason").isNull() if r is None else F.col("reason") == r).alias(n) for n, r in kinds.items()]
    path = work_dir(left.sparkSession, "paired")
    classify(left, right, key).observe(seen, *counts).write.parquet(path)
    written = left.sparkSession.read.parquet(path)
    return matched(written, key, "reject"), rejects(written, key), dict(seen.get)


def full_checked(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join of two tables whose keys are unique; a repeated key raises. Rows without a key stay, each for itself."""
    has = lambda df: df.where(F.col(key).isNotNull())
    none = lambda df: df.where(F.col(key).isNull())
    rows = classify(has(left), has(right), key)
    once = F.col("reason").isNull() | F.col("reason").isin(LEFT_ONLY, RIGHT_ONLY)
    paired = rows.where(F.when(once, F.lit(True)).otherwise(_stop(key, "rows would be multiplied").cast("boolean"))).select(key, "l.*", "r.*")
    return paired.unionByName(none(left), allowMissingColumns=True).unionByName(none(right), allowMissingColumns=True)
