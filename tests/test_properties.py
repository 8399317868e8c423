"""Properties: split, evaluation, drift, dense index, head per file."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeflux.operators.drift import column_drift, numeric_distances, tag_sides
from lakeflux.operators.evaluate import accuracy, confusion_matrix, weighted_scores
from lakeflux.operators.features import expected_test_size, seeded_split
from lakeflux.operators.ordering import dense_index
from lakeflux.operators.zones import head_per_file, write_landing_records
from lakeflux.plans.zones import BUSINESS_SCHEMA, curate
from lakeflux.session import work_dir
from lakeflux.sinks.files import CSV_READ_OPTIONS
from lakeflux.sources.files import read_record_arrays


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 999, 5003])
def test_split_exact_disjoint_complete(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    out = seeded_split(df, "k", 0.2, 42)
    rows = out.collect()
    assert len(rows) == n
    assert len({r.k for r in rows}) == n
    assert sum(r.split == "test" for r in rows) == expected_test_size(n, 0.2)


def test_split_stable_under_repartitioning(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    a = {r.k: r.split for r in seeded_split(df, "k").collect()}
    b = {r.k: r.split for r in seeded_split(df.repartition(7), "k").collect()}
    assert a == b


def test_split_matches_global_rank(spark):
    import hashlib

    n = 2500
    keys = list(range(n))
    ranked = sorted(keys, key=lambda k: (hashlib.md5(f"{k}:42".encode()).hexdigest(), k))
    want = set(ranked[: expected_test_size(n)])
    df = spark.range(n).withColumnRenamed("id", "k")
    got = {r.k for r in seeded_split(df, "k", digits=1).where("split = 'test'").collect()}
    assert got == want


def test_evaluation_label_only_in_predictions(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "x"), ("c", "a")]
    df = spark.createDataFrame(rows, "target string, Predictions string")
    cm = {(r.truth, r.predicted): r.n for r in confusion_matrix(df).collect()}
    labels = {"a", "b", "c", "x"}
    assert set(cm) == {(t, p) for t in labels for p in labels}
    assert sum(cm.values()) == len(rows)
    assert cm[("x", "x")] == 0 and cm[("c", "a")] == 1
    acc = accuracy(df).first()
    assert acc.n == 5 and acc.accuracy == pytest.approx(0.4)
    w = weighted_scores(df).first()
    # per class (p, r, support): a (0.5, 0.5, 2), b (0.5, 0.5, 2), c (0, 0, 1), x (0, 0, 0)
    assert w.precision == pytest.approx(0.4)
    assert w.recall == pytest.approx(0.4)
    assert w.f1 == pytest.approx(0.4)


def _brute_ks_w1(a: np.ndarray, b: np.ndarray):
    xs = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), xs, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), xs, side="right") / len(b)
    d = np.abs(fa - fb)
    return d.max(), float(np.sum(d[:-1] * np.diff(xs)))


@pytest.mark.parametrize("buckets", [1, 4, 37])
def test_numeric_distances_match_brute_force(spark, buckets):
    rng = np.random.default_rng(7)
    a = np.round(rng.normal(0, 1, 3000), 2)
    b = np.round(rng.normal(0.2, 1.3, 2500), 2)
    b[:800] = 0.5  # a hot value holding a third of one side
    ref = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    got = numeric_distances(tag_sides(ref, cur, ["x"]), ["x"], buckets=buckets).first()
    ks, w1 = _brute_ks_w1(a, b)
    assert got.ks_stat == pytest.approx(ks, abs=1e-12)
    assert got.wasserstein == pytest.approx(w1, rel=1e-9)
    assert got.ref_std == pytest.approx(float(np.std(a)), rel=1e-9)


def test_identical_inputs_never_drift(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "value", "event_type")
    out = column_drift(df, df, ["user_id", "value", "event_type"]).collect()
    assert all(r.drifted == 0 for r in out)


def test_shifted_input_drifts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("value", "event_type")
    shifted = df.select((F.col("value") * 3 + 50).alias("value"), F.lit("view").alias("event_type"))
    out = {r.feature: r for r in column_drift(df, shifted, ["value", "event_type"]).collect()}
    assert out["value"].drifted == 1 and out["event_type"].drifted == 1


def test_dense_index_is_zero_to_n(spark):
    df = spark.range(1234).select((F.col("id") * 7 % 1234).alias("k"))
    out = dense_index(df, ["k"], num_partitions=5).collect()
    assert sorted((r.k, r.row_index) for r in out) == [(i, i) for i in range(1234)]


def test_head_per_file_with_0_5_8_records(spark):
    # three files: 0, 5 and 8 records
    rows = [("f5", i) for i in range(5)] + [("f8", i) for i in range(8)]
    df = spark.createDataFrame(rows, "src string, rid long")
    path = work_dir(spark, "head-files")
    record = {"id": F.col("rid"), "user_id": F.col("rid"), "title": F.concat(F.lit("t"), F.col("rid").cast("string")),
              "body": F.lit("b")}
    write_landing_records(df, path, "src", "rid", record)
    empty_dir = f"{path}/src=f0/chunk=0"
    spark.createDataFrame([("[]",)], "value string").write.mode("overwrite").text(empty_dir)
    recs = read_record_arrays(spark, path, BUSINESS_SCHEMA, glob=None)
    head = head_per_file(recs, 5).withColumn("src", F.regexp_extract("file", "src=([^/]+)", 1))
    counts = {r.src: r["count"] for r in head.groupBy("src").count().collect()}
    assert counts == {"f5": 5, "f8": 5}
    firsts = sorted(r.id for r in head.where("src = 'f8'").collect())
    assert firsts == [0, 1, 2, 3, 4]


def test_zone_job_writes_one_csv_per_input_file(spark):
    root = work_dir(spark, "zone-job")
    processing, curated = f"{root}/processing", f"{root}/curated"
    import json, os

    from lakeflux.session import local_path

    day = local_path(f"{processing}/business/20240101")
    os.makedirs(day, exist_ok=True)
    fixture = [
        {"id": 1, "user_id": 1, "title": "first", "body": "body with \"quotes\""},
        {"id": 2, "user_id": 1, "title": "second", "body": "line\nbreak"},
    ]
    for name, recs in (("a.json", fixture), ("b.json", fixture * 4)):
        with open(os.path.join(day, name), "w") as fh:
            json.dump(recs, fh)
    out = curate(spark, processing, curated, "20240101")
    back = spark.read.options(**CSV_READ_OPTIONS).csv(out)
    counts = {r.source_file: r["count"] for r in back.groupBy("source_file").count().collect()}
    assert counts == {"a.json": 2, "b.json": 5}
    assert set(back.columns) == {"title", "body", "source_file"}
    assert back.where("body = 'line\nbreak'").count() == 3


def test_adaptive_buckets_match_brute_force(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    ref = ev.where("ts < '2024-01-16'").select("value")
    cur = ev.where("ts >= '2024-01-16'").select("value")
    got = numeric_distances(tag_sides(ref, cur, ["value"]), ["value"], rows_per_bucket=500).first()
    a = np.array([r.value for r in ref.collect()])
    b = np.array([r.value for r in cur.collect()])
    ks, w1 = _brute_ks_w1(a, b)
    assert got.ks_stat == pytest.approx(ks, abs=1e-12)
    assert got.wasserstein == pytest.approx(w1, rel=1e-9)


def test_dense_index_hot_key_is_split(spark):
    # one key holds a third of the rows: it must not land in one partition
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), "id")
    out = dense_index(df, ["k"], num_partitions=6)
    rows = out.collect()
    assert sorted(r.row_index for r in rows) == list(range(3000))
    assert all(r.row_index < 1000 for r in rows if r.k == 0)
    assert sorted(r.row_index for r in rows if r.k > 0) == list(range(1000, 3000))


def test_split_keeps_rows_with_null_keys(spark):
    df = spark.createDataFrame([(None,)] * 3 + [(i,) for i in range(97)], "k long")
    out = seeded_split(df, "k").collect()
    assert len(out) == 100
    assert sum(r.split == "test" for r in out) == 20


def _ks_brute(m: int, n: int, d: float) -> float:
    """P(D >= d) by enumerating every interleaving of m and n values."""
    from itertools import combinations
    from math import comb

    hits = 0
    for pos in combinations(range(m + n), m):
        chosen = set(pos)
        a = b = 0
        dmax = 0.0
        for k in range(m + n):
            if k in chosen:
                a += 1
            else:
                b += 1
            dmax = max(dmax, abs(a / m - b / n))
        hits += dmax >= d - 1e-12
    return hits / comb(m + n, m)


@pytest.mark.parametrize("m,n,d", [(3, 4, 0.5), (5, 5, 0.6), (6, 4, 0.5), (7, 5, 0.4), (4, 8, 0.75), (6, 6, 1 / 6)])
def test_ks_exact_matches_enumeration(m, n, d):
    from lakeflux.operators.drift import ks_exact_sf

    assert ks_exact_sf(m, n, d) == pytest.approx(_ks_brute(m, n, d), abs=1e-12)


def test_ks_exact_near_asymptotic_for_large_samples():
    import math

    from lakeflux.operators.drift import ks_exact_sf

    m, n, d = 3000, 2500, 0.04
    lam = math.sqrt(m * n / (m + n)) * d
    asym = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 100))
    assert abs(ks_exact_sf(m, n, d) - asym) < 0.01


def test_column_drift_exact_ks_option(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ref = df.where("ts < '2024-01-16'").select("value")
    cur = df.where("ts >= '2024-01-16'").select("value")
    exact = column_drift(ref, cur, ["value"], numeric_test="ks_exact").first()
    asym = column_drift(ref, cur, ["value"], numeric_test="ks").first()
    assert exact.test == "ks_exact" and 0.0 <= exact.score <= 1.0
    assert abs(exact.score - asym.score) < 0.05


def test_split_is_stable_or_raises_for_repeated_keys(spark):
    same = spark.createDataFrame([(7, i) for i in range(400)], "k long, i long")
    with pytest.raises(ValueError):
        seeded_split(same, "k")
    # repeated keys whose rows the boundary does not cut through share a side, however the rows are dealt
    df = spark.createDataFrame([(k, i) for k in range(100) for i in range(5)], "k long, i long")
    sides = [{(r.k, r.i): r.split for r in seeded_split(df.repartition(p), "k").collect()} for p in (1, 3, 7)]
    assert sides[0] == sides[1] == sides[2] and sum(v == "test" for v in sides[0].values()) == 100


def test_null_labels_follow_one_rule(spark):
    from lakeflux.operators.evaluate import accuracy, confusion_matrix, weighted_scores

    rows = [("a", "a"), ("b", None), (None, "b"), (None, None), ("b", "b")]
    df = spark.createDataFrame(rows, "target string, Predictions string")
    acc, w = accuracy(df).first(), weighted_scores(df).first()
    assert (acc.n, acc.accuracy) == (5, 0.4) and (w.n, round(w.recall, 9)) == (5, 0.4)
    cells = confusion_matrix(df).collect()
    assert sum(c.n for c in cells) == 5 and len(cells) == 9


def test_scoring_refuses_missing_features(spark):
    from lakeflux.operators.model import feature_vector, fit_classifier, score, split_unusable

    train = spark.createDataFrame([(i, float(i % 4), "a" if i % 4 < 2 else "b") for i in range(80)], "k long, x double, y string")
    model = fit_classifier(feature_vector(train, ["x"]), "y")
    new = spark.createDataFrame([(1, 0.0), (2, None), (3, float("nan"))], "k long, x double")
    with pytest.raises(Exception):
        score(model, feature_vector(new, ["x"]), "k").collect()
    fine, bad = split_unusable(new, ["x"])
    assert [r.k for r in score(model, feature_vector(fine, ["x"]), "k").collect()] == [1] and bad.count() == 2
    arrays = spark.createDataFrame([(1, [0.0]), (2, [None]), (3, None), (4, [float("nan")])], "k long, x array<double>")
    assert split_unusable(arrays, "x")[1].count() == 3
    with pytest.raises(Exception):
        feature_vector(arrays, "x").collect()


def test_scaler_is_saved_for_new_rows(spark):
    from lakeflux.plans import modeling
    from lakeflux.session import work_dir

    df = spark.createDataFrame([(i, float(i), "a" if i < 50 else "b") for i in range(100)], "k long, x double, y string")
    path = work_dir(spark, "fs-scaler")
    modeling.prepare(df, "k", ["x"], "y", path, snapshot="20240101")
    modeling.prepare(df.withColumn("x", df.x + 1000), "k", ["x"], "y", path, snapshot="20240102")
    from lakeflux.sources.snapshot import read_latest_snapshot

    assert spark.read.parquet(path).count() == 200 and read_latest_snapshot(spark, path).count() == 100
    scaled = modeling.scale_new_rows(spark.createDataFrame([(1049.5,)], "x double"), ["x"], path).first().x
    assert abs(scaled) < 1e-12
