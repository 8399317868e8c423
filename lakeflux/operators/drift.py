"""Data drift between a reference and a current frame.

* kind: numeric columns are numeric, all others categorical; ``categorical`` names
  numeric columns that hold codes and are to be tested as categories.
* test: ``numeric_test`` and ``categorical_test`` name it, whatever the size of the
  frames or the number of distinct values:
  ``wasserstein`` (Wasserstein-1 distance normed by the reference's population std,
  floored at 0.001; drift when distance >= ``d_threshold``), ``ks`` (two-sample
  Kolmogorov-Smirnov, asymptotic p-value), ``ks_exact`` (exact p-value, for samples
  of at most ``EXACT_KS_MAX_N`` values a side; larger ones raise);
  ``jensenshannon`` (natural log, zero shares filled; drift when distance >=
  ``d_threshold``), ``chi2`` (goodness of fit of current counts against reference
  proportions), ``z`` (two-proportion z-test of the smallest category's share).
  Drift when p < ``p_threshold``.
* every requested column has a row. A column with values on one side only has
  drifted (score null); one without any value has not.
* dataset verdict: FAIL when the share of drifted columns >= ``share_threshold``.

Plan: both sides are tagged and unioned (J5), so every statistic is one grouped
aggregate over the union, never a row join. Numeric distributions are exact:
values are collapsed to ``(column, x, c_ref, c_cur)`` and range-partitioned; a
partition's running sums are taken in one pass over its sorted rows, starting
from what lies before it, which a table of one row per (column, partition) knows.
Only categorical columns are grouped as text.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lakeflux.functions.numeric import nan_to_null
from lakeflux.functions.stats import chi2_sf, kolmogorov_sf, norm_sf_two_sided

NUMERIC_TESTS = ("wasserstein", "ks", "ks_exact")
CATEGORICAL_TESTS = ("jensenshannon", "chi2", "z")
DEFAULTS = {
    "numeric_test": "wasserstein",
    "categorical_test": "jensenshannon",
    "p_threshold": 0.05,
    "d_threshold": 0.1,
    "share_threshold": 0.3,
}


def tag_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Union of both sides with an ``is_ref`` flag."""
    cols = [F.col(f"`{c}`") for c in columns]
    return reference.select(*cols, F.lit(1).alias("is_ref")).unionByName(
        current.select(*cols, F.lit(0).alias("is_ref"))
    )


def _stack(tagged: DataFrame, columns: Sequence[str], as_text: bool) -> DataFrame:
    types = {f.name: f.dataType for f in tagged.schema.fields}
    items = []
    for c in columns:
        v = nan_to_null(F.col(f"`{c}`"), types[c])
        v = v.cast("string") if as_text else v.cast("double")
        items.append(F.struct(F.lit(c).alias("feature"), v.alias("x")))
    return tagged.select("is_ref", F.inline(F.array(*items))).where(F.col("x").isNotNull())


def value_counts(tagged: DataFrame, columns: Sequence[str], as_text: bool) -> DataFrame:
    """(column, x, c_ref, c_cur): map-side partial counts, so hot values shrink
    before the shuffle."""
    return _stack(tagged, columns, as_text).groupBy("feature", "x").agg(
        F.sum("is_ref").cast("bigint").alias("c_ref"), F.sum(1 - F.col("is_ref")).cast("bigint").alias("c_cur")
    )


def numeric_distances(
    tagged: DataFrame, columns: Sequence[str], rows_per_bucket: int | None = None, buckets: int | None = None
) -> DataFrame:
    """Per numeric column with any value: n_ref, n_cur, ks_stat, wasserstein, ref_std.

    The value counts ``(feature, x, c_ref, c_cur)`` are range-partitioned on
    ``(feature, x)``, sorted inside partitions and checkpointed to the shared
    folder, which fixes each row's partition: the raw rows are scanned once. As
    partitions are ranges, there are at most columns + partitions rows
    (feature, partition); those are broadcast, and none reaches the driver. Statistics of a column without
    values on one side are null. The number of partitions is the session's for
    shuffles unless ``buckets`` or ``rows_per_bucket`` (one more pass) sets it.
    """
    counts = value_counts(tagged, columns, as_text=False)
    if rows_per_bucket:
        buckets = max(1, -(-counts.count() // rows_per_bucket))
    ranged = counts.repartitionByRange(*([buckets] if buckets else []), "feature", "x")
    vc = ranged.sortWithinPartitions("feature", "x").checkpoint(eager=True).withColumn("part", F.spark_partition_id())
    heads = vc.groupBy("feature", "part").agg(
        F.sum("c_ref").alias("ref"), F.sum("c_cur").alias("cur"), F.sum(F.col("c_ref") * F.col("x")).alias("sum_ref"), F.min("x").alias("least")
    )
    every, order = Window.partitionBy("feature"), Window.partitionBy("feature").orderBy("part")
    n_ref = F.sum("ref").over(every)
    starts = heads.select(
        "feature",
        "part",
        (F.sum("ref").over(order) - F.col("ref")).alias("before_ref"),
        (F.sum("cur").over(order) - F.col("cur")).alias("before_cur"),
        n_ref.alias("n_ref"),
        F.sum("cur").over(every).alias("n_cur"),
        F.try_divide(F.sum("sum_ref").over(every), n_ref.cast("double")).alias("mean"),
        F.lead("least").over(order).alias("next"),
    )
    # one row a column and partition; each task's rows get their own one, in the order in which they are stored
    placed = vc.join(F.broadcast(starts), ["feature", "part"]).select("feature", "x", "c_ref", "c_cur", *starts.columns[2:])

    def walk(batches):
        seen: dict[str, list] = {}  # of the partition's columns: running counts, last x and gap, results, start
        for batch in batches:
            for feature, x, c_ref, c_cur, start in _runs(batch):
                before_ref, before_cur, n_ref, n_cur, mean, _ = start
                state = seen.setdefault(feature, [before_ref, before_cur, None, 0.0, 0.0, 0.0, 0.0, start])
                ref, cur = state[0] + np.cumsum(c_ref), state[1] + np.cumsum(c_cur)
                gap = np.abs(ref / n_ref - cur / n_cur) if n_ref and n_cur else np.zeros(len(x))
                if state[2] is not None:
                    state[5] += state[3] * (x[0] - state[2])
                state[4] = max(state[4], float(gap.max()))
                state[5] += float((gap[:-1] * np.diff(x)).sum())
                state[6] += float((c_ref * (x - mean) ** 2).sum()) if n_ref else 0.0
                state[0], state[1], state[2], state[3] = ref[-1], cur[-1], float(x[-1]), float(gap[-1])
        rows = []
        for feature, (_, _, last, gap, ks, area, square, start) in seen.items():
            _, _, n_ref, n_cur, _, following = start
            if not np.isnan(following):
                area += gap * (following - last)
            rows.append((feature, int(n_ref), int(n_cur), ks, area, square))
        cols = list(zip(*rows)) or [[]] * 6
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["feature", "n_ref", "n_cur", "ks", "area", "square"])

    parts = placed.mapInArrow(walk, "feature string, n_ref long, n_cur long, ks double, area double, square double")
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    return parts.groupBy("feature", "n_ref", "n_cur").agg(
        F.when(both, F.max("ks")).alias("ks_stat"),
        F.when(both, F.sum("area")).alias("wasserstein"),
        F.when(F.col("n_ref") > 0, F.sqrt(F.sum("square") / F.col("n_ref"))).alias("ref_std"),
    )


def _runs(batch):
    """The rows of each column of a sorted batch, and what lies before them."""
    if not batch.num_rows:
        return
    feature = batch.column(0).to_pandas()
    x, c_ref, c_cur = (batch.column(k).to_numpy() for k in range(1, 4))
    starts = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4, 10)]
    begin = np.append(np.flatnonzero((feature != feature.shift()).to_numpy()), len(x))
    for a, b in zip(begin[:-1], begin[1:]):
        yield feature.iloc[a], x[a:b], c_ref[a:b], c_cur[a:b], tuple(float(s[a]) for s in starts)


def ks_p_value(n_ref, n_cur, d):
    """Asymptotic two-sample KS p-value: Q_KS(sqrt(n m / (n + m)) * D)."""
    en = F.sqrt(n_ref.cast("double") * n_cur / (n_ref + n_cur))
    return kolmogorov_sf(en * d)


#: The exact p-value of one column is one loop over m + n diagonals of m numbers.
EXACT_KS_MAX_N = 20_000


def ks_exact_sf(m: int, n: int, d: float) -> float:
    """Exact two-sided P(D >= d) for samples of sizes m and n (no ties).

    A uniformly random interleaving of the two samples is a lattice path from
    (0, 0) to (m, n); D < d exactly when the path stays inside
    |i*n - j*m| < d*m*n. ``u`` holds, along one anti-diagonal i + j = s, the
    probability that a random path to (i, j) stayed inside; each diagonal
    follows from the previous one (vectorised over i).
    """
    if m <= 0 or n <= 0:
        return float("nan")
    if max(m, n) > EXACT_KS_MAX_N:
        raise ValueError(f"ks_exact takes at most {EXACT_KS_MAX_N} values a side; use ks")
    band = round(d * m * n)
    if band <= 0:
        return 1.0
    i = np.arange(m + 1, dtype=np.float64)
    ii = np.arange(m + 1, dtype=np.int64)
    u = np.zeros(m + 1)
    u[0] = 1.0
    for s in range(1, m + n + 1):
        j = s - ii
        valid = (j >= 0) & (j <= n) & (np.abs(ii * n - j * m) < band)
        from_left = np.concatenate(([0.0], u[:-1])) * (i / s)  # step in the m-sample
        from_below = u * ((s - i) / s)  # step in the n-sample
        u = np.where(valid, from_left + from_below, 0.0)
    return float(min(1.0, max(0.0, 1.0 - u[m])))


def _ks_exact_series(m: pd.Series, n: pd.Series, d: pd.Series) -> pd.Series:
    # rows of other tests reach the UDF too (it is evaluated before the CASE
    # picks a branch); their inputs can be null
    return pd.Series(
        [
            None if pd.isna(a) or pd.isna(b) or pd.isna(c) else ks_exact_sf(int(a), int(b), float(c))
            for a, b, c in zip(m, n, d)
        ],
        dtype="float64",
    )


def categorical_distances(tagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: n_ref, n_cur, n_cat, chi2_stat, chi2_dof, chi2_p, z_p, js.

    Per-column totals (one row per column) are aggregates joined back by
    broadcast; no window spans a column's categories, so a column with very
    many categories is still spread over all tasks.
    """
    return distances_of_counts(value_counts(tagged, columns, as_text=True).checkpoint(eager=True))


def distances_of_counts(vc: DataFrame) -> DataFrame:
    """The statistics of categorical_distances from (feature, x, c_ref, c_cur)."""
    totals = vc.groupBy("feature").agg(
        F.sum("c_ref").alias("n_ref"),
        F.sum("c_cur").alias("n_cur"),
        F.min("x").alias("first_x"),
        F.min(F.when(F.col("c_ref") > 0, F.col("c_ref"))).alias("min_c_ref"),
        F.min(F.when(F.col("c_cur") > 0, F.col("c_cur"))).alias("min_c_cur"),
    )
    fill = lambda m: F.when(m <= 1e-4, m / 1e6).otherwise(F.lit(1e-4))
    totals = totals.withColumns(
        {
            "fill_p": fill(F.try_divide("min_c_ref", "n_ref")),
            "fill_q": fill(F.try_divide("min_c_cur", "n_cur")),
        }
    )
    # one row per column: bounded by the schema
    t = vc.join(F.broadcast(totals), "feature")
    p = F.try_divide("c_ref", "n_ref")
    q = F.try_divide("c_cur", "n_cur")
    t = t.withColumns(
        {
            "pf": F.when(F.col("c_ref") == 0, F.col("fill_p")).otherwise(p),
            "qf": F.when(F.col("c_cur") == 0, F.col("fill_q")).otherwise(q),
        }
    )
    sums = t.groupBy("feature").agg(F.sum("pf").alias("sum_pf"), F.sum("qf").alias("sum_qf"))
    t = t.join(F.broadcast(sums), "feature").withColumns(
        {"pn": F.col("pf") / F.col("sum_pf"), "qn": F.col("qf") / F.col("sum_qf")}
    )
    mid = (F.col("pn") + F.col("qn")) / 2
    expected = F.col("c_ref") * F.try_divide("n_cur", "n_ref")
    chi_term = F.when(expected == 0, F.lit(float("inf"))).otherwise(
        F.try_divide(F.pow(F.col("c_cur") - expected, F.lit(2)), expected)
    )
    agg = t.groupBy("feature").agg(
        F.first("n_ref").cast("bigint").alias("n_ref"),
        F.first("n_cur").cast("bigint").alias("n_cur"),
        F.count(F.lit(1)).cast("bigint").alias("n_cat"),
        F.count_if(F.col("c_ref") > 0).cast("bigint").alias("n_ref_cat"),
        F.sum(chi_term).alias("chi2_stat"),
        F.sum(F.col("pn") * F.log(F.col("pn") / mid) + F.col("qn") * F.log(F.col("qn") / mid)).alias("js_sum"),
        F.sum(F.when(F.col("x") == F.col("first_x"), F.col("c_ref")).otherwise(0)).alias("a_ref"),
        F.sum(F.when(F.col("x") == F.col("first_x"), F.col("c_cur")).otherwise(0)).alias("a_cur"),
    )
    p1 = F.try_divide("a_ref", "n_ref")
    p2 = F.try_divide("a_cur", "n_cur")
    pooled = (F.col("a_ref") + F.col("a_cur")) / (F.col("n_ref") + F.col("n_cur"))
    var = pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), "n_ref") + F.try_divide(F.lit(1.0), "n_cur"))
    z = F.try_divide(p1 - p2, F.sqrt(var))
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    dof = F.col("n_cat") - 1
    return agg.select(
        "feature",
        "n_ref",
        "n_cur",
        "n_cat",
        "n_ref_cat",
        F.when(both, F.col("chi2_stat")).alias("chi2_stat"),
        dof.alias("chi2_dof"),
        F.when(both, F.when(dof == 0, 1.0).otherwise(chi2_sf(F.col("chi2_stat"), dof))).alias("chi2_p"),
        F.when(both, F.when(var > 0, norm_sf_two_sided(z)).otherwise(F.lit(1.0))).alias("z_p"),
        F.when(both, F.sqrt(F.greatest(F.lit(0.0), F.col("js_sum") / 2))).alias("js"),
    )


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    categorical: Sequence[str] = (),
    **params,
) -> DataFrame:
    """One row per column: ordinal, feature, kind, test, n_ref, n_cur, score, threshold, drifted.

    categorical: numeric columns to be tested as categories."""
    opts = {**DEFAULTS, **params}
    if opts["numeric_test"] not in NUMERIC_TESTS or opts["categorical_test"] not in CATEGORICAL_TESTS:
        raise ValueError(f"numeric_test is one of {NUMERIC_TESTS}, categorical_test one of {CATEGORICAL_TESTS}")
    columns = list(columns or reference.columns)
    types = {f.name: f.dataType for f in reference.schema.fields}
    numeric = [c for c in columns if isinstance(types[c], NumericType) and c not in set(categorical)]
    textual = [c for c in columns if c not in numeric]
    tagged = tag_sides(reference, current, columns)
    score_of = {
        "wasserstein": F.col("wasserstein") / F.greatest(F.col("ref_std"), F.lit(0.001)),
        "ks": ks_p_value(F.col("n_ref"), F.col("n_cur"), F.col("ks_stat")),
        "jensenshannon": F.col("js"),
        "chi2": F.col("chi2_p"),
        "z": F.col("z_p"),
    }
    scored = []
    for kind, names, test, distances in (
        ("num", numeric, opts["numeric_test"], numeric_distances),
        ("cat", textual, opts["categorical_test"], categorical_distances),
    ):
        if names:
            found = distances(tagged, names)
            score = F.pandas_udf(_ks_exact_series, "double")("n_ref", "n_cur", "ks_stat") if test == "ks_exact" else score_of[test]
            wanted = F.explode(F.array(*[F.struct(F.lit(columns.index(c)).alias("ordinal"), F.lit(c).alias("feature")) for c in names]))
            listed = reference.sparkSession.range(1).select(wanted.alias("w")).select("w.ordinal", "w.feature")
            # one row per requested column, with or without values
            scored.append(
                listed.join(found.select("feature", "n_ref", "n_cur", score.alias("score")), "feature", "left").select(
                    "ordinal",
                    "feature",
                    F.lit(kind).alias("kind"),
                    F.lit(test).alias("test"),
                    F.coalesce("n_ref", F.lit(0)).alias("n_ref"),
                    F.coalesce("n_cur", F.lit(0)).alias("n_cur"),
                    "score",
                )
            )
    return judge(scored[0] if len(scored) == 1 else scored[0].unionByName(scored[1]), opts)


def judge(rows: DataFrame, opts: dict) -> DataFrame:
    """Threshold and verdict of each scored column."""
    is_p = F.col("test").isin("ks", "ks_exact", "ks_sketch", "z", "chi2")
    threshold = F.when(is_p, F.lit(opts["p_threshold"])).otherwise(F.lit(opts["d_threshold"]))
    beyond = F.when(is_p, F.col("score") < F.col("threshold")).otherwise(F.col("score") >= F.col("threshold"))
    one_sided = (F.col("n_ref") > 0) != (F.col("n_cur") > 0)
    drifted = F.when(one_sided, True).otherwise(F.coalesce(beyond, F.lit(False)))
    return rows.withColumn("threshold", threshold).withColumn("drifted", drifted.cast("int")).select(
        "ordinal", "feature", "kind", "test", "n_ref", "n_cur", "score", "threshold", "drifted"
    )


def dataset_drift(columns_drift: DataFrame, share_threshold: float = DEFAULTS["share_threshold"]) -> DataFrame:
    """One row: n_columns, n_drifted, share, status (D3)."""
    agg = columns_drift.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_columns"),
        F.sum("drifted").cast("bigint").alias("n_drifted"),
    )
    share = F.col("n_drifted") / F.col("n_columns")
    return agg.withColumn("share", share).withColumn(
        "status", F.when(F.col("share") >= share_threshold, "FAIL").otherwise("SUCCESS")
    )


def drift_report(columns_drift: DataFrame, share_threshold: float = DEFAULTS["share_threshold"]) -> DataFrame:
    """Nested report (D4): one row, ``report`` JSON with ``tests`` - the
    dataset test first, then one test per column in column order. The array
    has one element per column, so its size is bounded by the schema."""
    ds = dataset_drift(columns_drift, share_threshold)
    first = ds.select(
        F.lit(-1).alias("ordinal"),
        F.lit("share_of_drifted_columns").alias("name"),
        F.col("status"),
        F.format_string("drifted %d of %d columns (share %.4f)", "n_drifted", "n_columns", "share").alias("description"),
    )
    per_col = columns_drift.select(
        "ordinal",
        F.concat(F.lit("column_drift:"), F.col("feature")).alias("name"),
        F.when(F.col("drifted") == 1, "FAIL").otherwise("SUCCESS").alias("status"),
        F.format_string("%s test on %s: score %s, threshold %.3f", "test", "feature", F.coalesce(F.format_string("%.6f", "score"), F.lit("none")), "threshold").alias(
            "description"
        ),
    )
    tests = first.unionByName(per_col).agg(
        F.array_sort(F.collect_list(F.struct("ordinal", "name", "status", "description"))).alias("tests")
    )
    return tests.select(
        F.to_json(F.struct(F.transform("tests", lambda t: t.dropFields("ordinal")).alias("tests"))).alias("report")
    )


REPORT_SCHEMA = "struct<tests: array<struct<name: string, status: string, description: string>>>"


def drift_gate(report: DataFrame) -> DataFrame:
    """P9 + X11: ``retrain`` is true iff the first test of the report FAILs."""
    parsed = report.select(F.from_json("report", REPORT_SCHEMA).alias("r"))
    status = F.col("r.tests")[0]["status"]
    return parsed.select(status.alias("status"), (status == "FAIL").alias("retrain"))
