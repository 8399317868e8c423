"""Drift against a stored profile of the reference (D1, D2, J5, P9): the daily run scans the current side only.

A profile is a small table: for each numeric column a KLL sketch, the count, mean and sum of
squared deviations, for each categorical column the exact count of every value. It is made in
one scan, stored as a snapshot, and merged with others of the same columns (a day's profile
into a month's) without looking at the rows again.

Tests are named, as in ``drift``: ``ks_sketch`` and ``wasserstein_sketch`` for numbers, and the
categorical tests of ``drift``, which stay exact. A sketch of parameter k knows each rank to
``rank_error(k)`` (with 99 % confidence), whatever the number of rows; KS distances are
taken over ``points`` quantiles of both sides, so D is off by 2 * rank_error + 1 / points at
most. k is a parameter and never chosen by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lakeflux.functions.numeric import nan_to_null
from lakeflux.operators.drift import CATEGORICAL_TESTS, DEFAULTS, distances_of_counts, judge, ks_p_value
from lakeflux.sources import snapshot_log

SKETCH_K = 2000
POINTS = 2000
NUMERIC_SKETCH_TESTS = ("wasserstein_sketch", "ks_sketch")
PROFILE_COLUMNS = ["feature", "kind", "value", "n", "sketch", "mean", "square"]


def rank_error(k: int = SKETCH_K) -> float:
    """Normalised error of a single rank with 99 % confidence, as published for KLL sketches."""
    return 2.296 / k**0.9021


def ks_error(k: int = SKETCH_K, points: int = POINTS) -> float:
    """How far a sketched KS distance can be off."""
    return 2 * rank_error(k) + 1 / points


def profile(df: DataFrame, columns: Sequence[str] | None = None, categorical: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(feature, kind, value, n, sketch, mean, square): one row a numeric column, one a value of a categorical one.

    One scan and one shuffle of partial aggregates; NaN counts as null, and nulls are left out. A column
    without any value has no row.
    """
    columns = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    items = []
    for c in columns:
        v = nan_to_null(F.col(f"`{c}`"), types[c])
        number = isinstance(types[c], NumericType) and c not in set(categorical)
        x, text = (v.cast("double"), F.lit(None).cast("string")) if number else (F.lit(None).cast("double"), v.cast("string"))
        items.append(F.struct(F.lit(c).alias("feature"), F.lit("num" if number else "cat").alias("kind"), text.alias("value"), x.alias("x")))
    rows = df.select(F.inline(F.array(*items))).where(F.col("x").isNotNull() | F.col("value").isNotNull())
    return rows.groupBy("feature", "kind", "value").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("x", k).alias("sketch"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("x")).alias("square")
    ).select("feature", "kind", "value", "n", F.when(F.col("kind") == "num", F.col("sketch")).alias("sketch"), "mean", "square")


def merge(*profiles: DataFrame) -> DataFrame:
    """One profile of all rows behind several profiles of the same columns."""
    every = profiles[0]
    for p in profiles[1:]:
        every = every.unionByName(p)
    numbers, values = every.where(F.col("kind") == "num"), every.where(F.col("kind") == "cat")
    total = F.sum("n")
    mean = F.sum(F.col("n") * F.col("mean")) / total
    merged = numbers.groupBy("feature", "kind", "value").agg(
        total.alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"), mean.alias("mean"),
        F.greatest(F.lit(0.0), F.sum(F.col("square") + F.col("n") * F.col("mean") * F.col("mean")) - total * mean * mean).alias("square"),
    )
    none = F.lit(None)
    counted = values.groupBy("feature", "kind", "value").agg(total.alias("n")).withColumns({"sketch": none.cast("binary"), "mean": none.cast("double"), "square": none.cast("double")})
    return merged.select(*PROFILE_COLUMNS).union(counted.select(*PROFILE_COLUMNS))


def publish_profile(df: DataFrame, table: str, run, columns: Sequence[str] | None = None, categorical: Sequence[str] = (), k: int = SKETCH_K) -> int:
    """Store the profile of a run's rows; readers take the newest as of a date (``snapshot_log``)."""
    return snapshot_log.publish(profile(df, columns, categorical, k).coalesce(1), table, run)


def stored_profile(spark: SparkSession, table: str, as_of=None) -> DataFrame:
    return snapshot_log.read_as_of(spark, table, as_of)


def numeric_distances(reference: DataFrame, current: DataFrame, points: int = POINTS) -> DataFrame:
    """Per numeric column: n_ref, n_cur, ks_stat, wasserstein, ref_std, from two profiles (one row a column each).

    Each side is ``points`` quantiles of equal weight; running sums over both sides' quantiles, at most
    2 * points rows a column, give both distribution functions. Without values on one side they are null.
    """
    side = lambda p, s: p.where(F.col("kind") == "num").select("feature", F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sk_{s}"), F.col("square").alias(f"square_{s}"))
    both = side(reference, "ref").join(side(current, "cur"), "feature", "full")
    ranks = F.lit([(i + 0.5) / points for i in range(points)])
    known = both.where(F.col("sk_ref").isNotNull() & F.col("sk_cur").isNotNull())
    at = lambda s: known.select("feature", F.explode(F.kll_sketch_get_quantile_double(f"sk_{s}", ranks)).alias("x"), F.lit(int(s == "ref")).alias("ref"))
    steps = at("ref").union(at("cur")).groupBy("feature", "x").agg(F.sum("ref").alias("ref"), F.sum(1 - F.col("ref")).alias("cur"))
    order = Window.partitionBy("feature").orderBy("x")
    gap = F.abs(F.sum("ref").over(order) - F.sum("cur").over(order)) / points
    graded = steps.select("feature", gap.alias("gap"), (F.lead("x").over(order) - F.col("x")).alias("width"))
    found = graded.groupBy("feature").agg(F.max("gap").alias("ks_stat"), F.coalesce(F.sum(F.col("gap") * F.col("width")), F.lit(0.0)).alias("wasserstein"))
    return both.join(found, "feature", "left").select(
        "feature", F.coalesce("n_ref", F.lit(0)).alias("n_ref"), F.coalesce("n_cur", F.lit(0)).alias("n_cur"), "ks_stat", "wasserstein", F.sqrt(F.col("square_ref") / F.col("n_ref")).alias("ref_std")
    )


def categorical_counts(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(feature, x, c_ref, c_cur) from two profiles."""
    side = lambda p, s: p.where(F.col("kind") == "cat").select("feature", F.col("value").alias("x"), F.col("n").alias(f"c_{s}"))
    both = side(reference, "ref").join(side(current, "cur"), ["feature", "x"], "full")
    return both.select("feature", "x", F.coalesce("c_ref", F.lit(0)).alias("c_ref"), F.coalesce("c_cur", F.lit(0)).alias("c_cur"))


def drift_from_profile(reference: DataFrame, current: DataFrame, columns: Sequence[str], categorical: Sequence[str] = (), k: int = SKETCH_K, points: int = POINTS, **params) -> DataFrame:
    """``column_drift``'s rows for the current frame against a stored profile; the current frame is scanned once."""
    opts = {**DEFAULTS, "numeric_test": "wasserstein_sketch", **params}
    if opts["numeric_test"] not in NUMERIC_SKETCH_TESTS or opts["categorical_test"] not in CATEGORICAL_TESTS:
        raise ValueError(f"numeric_test is one of {NUMERIC_SKETCH_TESTS}, categorical_test one of {CATEGORICAL_TESTS}")
    columns, types = list(columns), {f.name: f.dataType for f in current.schema.fields}
    kinds = {c: "num" if isinstance(types[c], NumericType) and c not in set(categorical) else "cat" for c in columns}
    now = profile(current, columns, categorical, k).checkpoint(eager=True)  # small; read below more than once
    score = {
        "wasserstein_sketch": F.col("wasserstein") / F.greatest(F.col("ref_std"), F.lit(0.001)), "ks_sketch": ks_p_value(F.col("n_ref"), F.col("n_cur"), F.col("ks_stat")),
        "jensenshannon": F.col("js"), "chi2": F.col("chi2_p"), "z": F.col("z_p"),
    }
    scored = []
    for kind, test, found in (
        ("num", opts["numeric_test"], numeric_distances(reference, now, points)),
        ("cat", opts["categorical_test"], distances_of_counts(categorical_counts(reference, now))),
    ):
        scored.append(found.select("feature", "n_ref", "n_cur", score[test].alias("score"), F.lit(test).alias("test"), F.lit(kind).alias("kind")))
    spark = current.sparkSession
    listed = spark.createDataFrame([(i, c, kinds[c], opts["numeric_test" if kinds[c] == "num" else "categorical_test"]) for i, c in enumerate(columns)], "ordinal int, feature string, kind string, test string")
    rows = listed.join(scored[0].unionByName(scored[1]), ["feature", "kind", "test"], "left").select(
        "ordinal", "feature", "kind", "test", F.coalesce("n_ref", F.lit(0)).cast("long").alias("n_ref"), F.coalesce("n_cur", F.lit(0)).cast("long").alias("n_cur"), "score"
    )
    return judge(rows, opts)
