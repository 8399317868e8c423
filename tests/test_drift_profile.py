"""Drift against a stored profile: within its stated error of the exact tests, from one scan of the current side."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeflux.operators import drift_profile as P
from lakeflux.operators.drift import categorical_distances, column_drift, numeric_distances, tag_sides

COLUMNS = ["x", "y", "code", "word", "nothing"]


def frame(spark, n, shift=0.0, seed=1):
    return spark.range(n).select(
        (F.randn(seed) + shift).alias("x"), F.when(F.rand(seed + 1) < 0.9, F.floor(F.rand(seed + 2) * 5)).otherwise(F.lit(float("nan"))).cast("double").alias("y"),
        (F.col("id") % 3).cast("int").alias("code"), F.when(F.rand(seed + 3) < 0.8 - shift, "a").when(F.col("id") % 7 == 0, None).otherwise("b").alias("word"), F.lit(None).cast("double").alias("nothing"),
    )


@pytest.mark.parametrize("k", [200, 2000])
def test_distances_are_within_the_stated_error(spark, k):
    ref, cur = frame(spark, 40_000), frame(spark, 25_000, 0.15, 9)
    exact = {r.feature: r for r in numeric_distances(tag_sides(ref, cur, ["x", "y"]), ["x", "y"]).collect()}
    got = {r.feature: r for r in P.numeric_distances(P.profile(ref, COLUMNS, ["code"], k), P.profile(cur, COLUMNS, ["code"], k)).collect()}
    assert set(got) == set(exact)
    for c, e in exact.items():
        assert abs(got[c].ks_stat - e.ks_stat) <= P.ks_error(k) and (got[c].n_ref, got[c].n_cur) == (e.n_ref, e.n_cur)
        assert abs(got[c].ref_std - e.ref_std) < 1e-9 and abs(got[c].wasserstein - e.wasserstein) < 8 * P.ks_error(k)
    same = {r.feature: r for r in categorical_distances(tag_sides(ref, cur, ["code", "word"]), ["code", "word"]).collect()}
    now = {r.feature: r for r in P.distances_of_counts(P.categorical_counts(P.profile(ref, COLUMNS, ["code"], k), P.profile(cur, COLUMNS, ["code"], k))).collect()}
    assert {c: (r.n_ref, r.n_cur, round(r.js, 9)) for c, r in now.items()} == {c: (r.n_ref, r.n_cur, round(r.js, 9)) for c, r in same.items()}


def test_verdicts_are_those_of_the_exact_tests(spark, tmp_path):
    ref = frame(spark, 20_000)
    table = f"{tmp_path}/profile"
    P.publish_profile(ref, table, 9, COLUMNS, ["code"])
    P.publish_profile(frame(spark, 50, 5.0), table, 10, COLUMNS, ["code"])
    stored = P.stored_profile(spark, table, 9)
    for shift in (0.0, 0.3):
        cur = frame(spark, 20_000, shift, 5)
        want = column_drift(ref, cur, COLUMNS, ["code"])
        got = P.drift_from_profile(stored, cur, COLUMNS, ["code"])
        pick = lambda d: [(r.ordinal, r.feature, r.kind, r.n_ref, r.n_cur, r.drifted) for r in d.orderBy("ordinal").collect()]
        assert pick(got) == pick(want)
        assert got.where("feature = 'x'").first().drifted == int(shift > 0)


def test_merged_profiles_are_those_of_all_rows(spark):
    a, b = frame(spark, 3000), frame(spark, 2000, 1.0, 4)
    whole, merged = P.profile(a.union(b), COLUMNS, ["code"]), P.merge(P.profile(a, COLUMNS, ["code"]), P.profile(b, COLUMNS, ["code"]))
    key = lambda d: {(r.feature, r.value): (r.n, r.kind, None if r["mean"] is None else round(r["mean"], 9), None if r.square is None else round(r.square, 6)) for r in d.collect()}
    assert key(whole) == key(merged)
    ks = P.numeric_distances(merged, whole).where("feature = 'x'").first()
    assert ks.ks_stat <= P.ks_error() and ks.n_ref == 5000


def test_current_side_is_scanned_once(spark, tmp_path):
    frame(spark, 100).write.parquet(f"{tmp_path}/cur")
    plan = P.profile(spark.read.parquet(f"{tmp_path}/cur"), COLUMNS, ["code"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_one_sided_and_unknown_tests(spark):
    ref = P.profile(frame(spark, 100), ["x"])
    cur = frame(spark, 100).select("x", "nothing", F.lit("v").alias("new"))
    got = {r.feature: r for r in P.drift_from_profile(ref, cur, ["x", "nothing", "new"]).collect()}
    assert got["new"].drifted == 1 and got["new"].score is None and got["nothing"].drifted == 0 and got["x"].n_cur == 100
    with pytest.raises(ValueError):
        P.drift_from_profile(ref, cur, ["x"], numeric_test="ks")
