"""Drift: named tests at every size, columns without values, and tail functions against published values."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from lakeflux.functions.stats import chi2_sf, erfc, kolmogorov_sf, norm_sf_two_sided
from lakeflux.operators.drift import column_drift, dataset_drift, drift_report


def _one(spark, column):
    return spark.range(1).select(column.alias("p")).first().p


# published table values
ERFC = [(0.0, 1.0), (0.1, 0.8875370840), (0.5, 0.4795001222), (1.0, 0.1572992071), (2.0, 0.0046777350), (3.0, 2.209049700e-5), (4.0, 1.541725790e-8), (5.0, 1.537459794e-12)]
CHI2 = [
    (3.841458821, 1, 0.05),
    (6.634896601, 1, 0.01),
    (5.991464547, 2, 0.05),
    (18.30703805, 10, 0.05),
    (43.77297183, 30, 0.05),
    (124.3421134, 100, 0.05),
    (135.8067232, 100, 0.01),
    (77.92946517, 100, 0.95),
    (233.9942689, 200, 0.05),
    (1074.679449, 1000, 0.05),
    (927.5943633, 1000, 0.95),
]
KOLMOGOROV = [(1.2238478702, 0.1), (1.3580986393, 0.05), (1.6276236115, 0.01), (0.8275735551, 0.5)]


def test_tail_functions_against_published_values(spark):
    for z, p in ERFC:
        assert _one(spark, erfc(F.lit(z))) == pytest.approx(p, rel=1e-8)
        assert _one(spark, erfc(F.lit(-z))) == pytest.approx(2 - p, rel=1e-8)
    for x, dof, p in CHI2:
        assert _one(spark, chi2_sf(F.lit(x), F.lit(dof))) == pytest.approx(p, abs=2e-8)
    for lam, p in KOLMOGOROV:
        assert _one(spark, kolmogorov_sf(F.lit(lam))) == pytest.approx(p, abs=1e-6)
    assert _one(spark, norm_sf_two_sided(F.lit(1.959963985))) == pytest.approx(0.05, abs=1e-9)


def test_chi2_tail_at_any_degrees_of_freedom(spark):
    # the normal limit of a very large number of degrees of freedom
    for dof in (5_000_000, 4_000_000_000):
        x = dof + 1.959963985 * math.sqrt(2 * dof)
        assert _one(spark, chi2_sf(F.lit(x), F.lit(dof))) == pytest.approx(0.025, abs=1e-3)
    # both sides of the change of method agree
    for k in (150.0, 200.0, 260.0, 330.0):
        low, mid, high = (_one(spark, chi2_sf(F.lit(k), F.lit(d))) for d in (200, 201, 202))
        assert low < mid < high and mid == pytest.approx(math.sqrt(low * high), rel=0.01)


def _frames(spark, n):
    ref = spark.range(n).select((F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 3).cast("int").alias("code"), F.concat(F.lit("c"), F.col("id") % 4).alias("t"))
    return ref, ref.withColumn("x", F.col("x") + 3)


def test_same_test_at_every_size(spark):
    for n in (500, 5000):
        ref, cur = _frames(spark, n)
        got = {r.feature: (r.kind, r.test) for r in column_drift(ref, cur, categorical=["code"]).collect()}
        assert got == {"x": ("num", "wasserstein"), "code": ("cat", "jensenshannon"), "t": ("cat", "jensenshannon")}
        got = {r.feature: (r.kind, r.test) for r in column_drift(ref, cur, numeric_test="ks", categorical_test="chi2").collect()}
        assert got == {"x": ("num", "ks"), "code": ("num", "ks"), "t": ("cat", "chi2")}
    with pytest.raises(ValueError):
        column_drift(ref, cur, numeric_test="auto")


@pytest.mark.parametrize("tests", [("wasserstein", "jensenshannon"), ("ks", "chi2"), ("ks_exact", "z")])
def test_columns_without_values(spark, tests):
    schema = "a double, b double, c double, s string, t string, u string"
    ref = spark.createDataFrame([(1.0, 1.0, None, "p", "q", None), (2.0, 2.0, None, "p", "q", None)], schema)
    cur = spark.createDataFrame([(1.0, None, None, "p", None, None), (2.0, None, None, "p", None, None)], schema)
    rows = column_drift(ref, cur, numeric_test=tests[0], categorical_test=tests[1])
    got = {r.feature: (r.n_ref, r.n_cur, r.score is None, r.drifted) for r in rows.collect()}
    assert got == {
        "a": (2, 2, False, 0),
        "b": (2, 0, True, 1),
        "c": (0, 0, True, 0),
        "s": (2, 2, False, 0),
        "t": (2, 0, True, 1),
        "u": (0, 0, True, 0),
    }
    back = {r.feature: r.drifted for r in column_drift(cur, ref, numeric_test=tests[0], categorical_test=tests[1]).collect()}
    assert back == {"a": 0, "b": 1, "c": 0, "s": 0, "t": 1, "u": 0}
    verdict = dataset_drift(rows).first()
    assert (verdict.n_columns, verdict.n_drifted) == (6, 2)
    assert drift_report(rows).first().report.count("column_drift:") == 6
    assert {r.drifted for r in column_drift(ref.limit(0), cur.limit(0)).collect()} == {0}
