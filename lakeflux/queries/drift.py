"""Drift family: KS, Wasserstein, chi-square, z, Jensen-Shannon, dataset verdict
and retrain gate, on the two halves of January in ``events`` and on two groups of
nations in ``supplier``. Every query names its tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeflux.operators import drift_profile
from lakeflux.functions.stats import chi2_sf_sql, erfc_sql, kolmogorov_sf_sql
from lakeflux.operators.drift import (
    DEFAULTS,
    categorical_distances,
    column_drift,
    dataset_drift,
    distances_of_counts,
    drift_gate,
    drift_report,
    ks_p_value,
    numeric_distances,
    tag_sides,
)
from lakeflux.queries.common import DRIFT_CUT, load, r6
from lakeflux.session import work_dir

EVENT_COLUMNS = ["user_id", "value", "event_type", "props"]
EVENT_NUMERIC = ["user_id", "value"]


def _event_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = load(spark, sf_dir, "events")
    cut = F.lit(DRIFT_CUT).cast("timestamp_ntz")
    return ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)


def drift_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = _event_halves(spark, sf_dir)
    d = numeric_distances(tag_sides(ref, cur, ["value"]), ["value"])
    return d.select(
        "feature",
        "n_ref",
        "n_cur",
        F.round("ks_stat", 9).alias("ks_stat"),
        r6(ks_p_value(F.col("n_ref"), F.col("n_cur"), F.col("ks_stat"))).alias("p_value"),
    )


def drift_wasserstein(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = _event_halves(spark, sf_dir)
    d = numeric_distances(tag_sides(ref, cur, EVENT_NUMERIC), EVENT_NUMERIC)
    return d.select(
        "feature",
        r6(F.col("wasserstein")).alias("wasserstein"),
        r6(F.col("ref_std")).alias("ref_std"),
        r6(F.col("wasserstein") / F.greatest(F.col("ref_std"), F.lit(0.001))).alias("wasserstein_norm"),
    )


def _cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = _event_halves(spark, sf_dir)
    return categorical_distances(tag_sides(ref, cur, ["event_type", "props"]), ["event_type", "props"])


def drift_chi2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).select(
        "feature", "n_cat", r6(F.col("chi2_stat")).alias("chi2_stat"), "chi2_dof", r6(F.col("chi2_p")).alias("chi2_p")
    )


def drift_js(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).select("feature", "n_ref", "n_cur", r6(F.col("js")).alias("js"))


def _rounded(cd: DataFrame) -> DataFrame:
    return cd.select(
        "ordinal", "feature", "kind", "test", "n_ref", "n_cur", r6(F.col("score")).alias("score"), "threshold", "drifted"
    )


def drift_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = _event_halves(spark, sf_dir)
    return _rounded(column_drift(ref, cur, EVENT_COLUMNS, numeric_test="wasserstein", categorical_test="jensenshannon"))


def _supplier_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = load(spark, sf_dir, "supplier").select(
        "s_nationkey",
        "s_acctbal",
        F.when(F.col("s_acctbal") >= 4500, "high").otherwise("low").alias("balance_band"),
        F.concat(F.lit("g"), (F.col("s_suppkey") % 3).cast("string")).alias("supplier_group"),
    )
    return s.where(F.col("s_nationkey") < 12), s.where(F.col("s_nationkey") >= 12)


SUPPLIER_COLUMNS = ["s_acctbal", "balance_band", "supplier_group"]


def drift_small_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KS and chi-square, and the z-test for the two balance bands."""
    ref, cur = _supplier_sides(spark, sf_dir)
    tested = column_drift(ref, cur, SUPPLIER_COLUMNS, numeric_test="ks", categorical_test="chi2")
    bands = column_drift(ref, cur, ["balance_band"], categorical_test="z").withColumn("ordinal", F.lit(len(SUPPLIER_COLUMNS)))
    return _rounded(tested.unionByName(bands))


def _null_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """value and event_type without any value on one side, props on neither."""
    ref, cur = _event_halves(spark, sf_dir)
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    return (
        ref.select("user_id", "value", none(ref, "event_type"), none(ref, "props")),
        cur.select("user_id", none(cur, "value"), "event_type", none(cur, "props")),
    )


def drift_null_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = _null_sides(spark, sf_dir)
    return _rounded(column_drift(ref, cur, EVENT_COLUMNS, numeric_test="ks", categorical_test="chi2"))


def drift_gate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = _event_halves(spark, sf_dir)
    # one row per column: computed once, cut from its lineage, read twice
    cd = column_drift(ref, cur, EVENT_COLUMNS, numeric_test="wasserstein", categorical_test="jensenshannon").checkpoint(eager=True)
    gate = drift_gate(drift_report(cd))
    ds = dataset_drift(cd)
    # both sides are single rows; union as columns through a scalar subquery
    return gate.select(
        "status",
        F.col("retrain").cast("int").alias("retrain"),
        ds.select("n_columns").scalar().alias("n_columns"),
        ds.select("n_drifted").scalar().alias("n_drifted"),
        F.round(ds.select("share").scalar(), 6).alias("share"),
    )


def drift_from_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current half against the stored profile of the reference half, merged from two parts: exact statistics, and
    whether the profile's are within their stated error of them (categorical ones have none)."""
    ref, cur = _event_halves(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-08 00:00:00").cast("timestamp_ntz")
    table = work_dir(spark, "drift-profile")
    parts = [drift_profile.profile(ref.where(w), EVENT_COLUMNS) for w in (early, ~early)]
    drift_profile.snapshot_log.publish(drift_profile.merge(*parts).coalesce(1), table, "2024-01-15")
    stored = drift_profile.stored_profile(spark, table, "2024-01-31")
    now = drift_profile.profile(cur, EVENT_COLUMNS).checkpoint(eager=True)
    exact = numeric_distances(tag_sides(ref, cur, EVENT_NUMERIC), EVENT_NUMERIC).select("feature", F.col("ks_stat").alias("exact"))
    near = drift_profile.numeric_distances(stored, now).join(exact, "feature")
    off = F.abs(F.col("ks_stat") - F.col("exact")) <= drift_profile.ks_error()
    numbers = near.select("feature", "n_ref", "n_cur", r6(F.col("exact")).alias("stat"), off.cast("int").alias("within"))
    values = distances_of_counts(drift_profile.categorical_counts(stored, now))
    return numbers.unionByName(values.select("feature", "n_ref", "n_cur", r6(F.col("js")).alias("stat"), F.lit(1).alias("within")))


# ---------------------------------------------------------------- oracle SQL
EVENTS_SIDES = f"(SELECT *, CASE WHEN ts < TIMESTAMP '{DRIFT_CUT}' THEN 1 ELSE 0 END AS is_ref FROM events)"
SUPPLIER_SIDES = (
    "(SELECT s_acctbal, CASE WHEN s_acctbal >= 4500 THEN 'high' ELSE 'low' END AS balance_band, "
    "'g' || CAST(s_suppkey % 3 AS VARCHAR) AS supplier_group, "
    "CASE WHEN s_nationkey < 12 THEN 1 ELSE 0 END AS is_ref FROM supplier)"
)


def _num_ctes(src: str, c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return f"""
vc_{c} AS (SELECT x, sum(is_ref) AS c_ref, sum(1 - is_ref) AS c_cur
           FROM (SELECT {x} AS x, is_ref FROM {src} s WHERE {c} IS NOT NULL AND NOT isnan({x})) GROUP BY x),
cdf_{c} AS (SELECT x, sum(c_ref) OVER w / sum(c_ref) OVER () AS fr, sum(c_cur) OVER w / sum(c_cur) OVER () AS fc,
                   lead(x) OVER (ORDER BY x) AS nx, sum(c_ref) OVER () AS nr, sum(c_cur) OVER () AS nc
            FROM vc_{c} WINDOW w AS (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
num_{c} AS (SELECT '{c}' AS feature, CAST(any_value(nr) AS BIGINT) AS n_ref, CAST(any_value(nc) AS BIGINT) AS n_cur,
                   max(abs(fr - fc)) AS ks_stat, sum(coalesce(abs(fr - fc) * (nx - x), 0)) AS wasserstein,
                   (SELECT stddev_pop({x}) FROM {src} s WHERE is_ref = 1 AND {c} IS NOT NULL AND NOT isnan({x})) AS ref_std
            FROM cdf_{c})"""


def _cat_ctes(src: str, c: str) -> str:
    fill = lambda m: f"(CASE WHEN {m} <= 1e-4 THEN {m} / 1e6 ELSE 1e-4 END)"
    return f"""
vk_{c} AS (SELECT CAST({c} AS VARCHAR) AS x, sum(is_ref) AS c_ref, sum(1 - is_ref) AS c_cur FROM {src} s
           WHERE {c} IS NOT NULL GROUP BY 1),
t_{c} AS (SELECT *, c_ref / n_ref AS p, c_cur / n_cur AS q FROM
           (SELECT *, sum(c_ref) OVER () AS n_ref, sum(c_cur) OVER () AS n_cur, min(x) OVER () AS first_x FROM vk_{c})),
f_{c} AS (SELECT *, CASE WHEN p = 0 THEN {fill('min(p) FILTER (WHERE p > 0) OVER ()')} ELSE p END AS pf,
                    CASE WHEN q = 0 THEN {fill('min(q) FILTER (WHERE q > 0) OVER ()')} ELSE q END AS qf FROM t_{c}),
n_{c} AS (SELECT *, pf / sum(pf) OVER () AS pn, qf / sum(qf) OVER () AS qn FROM f_{c}),
cat_{c} AS (SELECT '{c}' AS feature, CAST(any_value(n_ref) AS BIGINT) AS n_ref, CAST(any_value(n_cur) AS BIGINT) AS n_cur,
                   count(*)::BIGINT AS n_cat, count(*) FILTER (WHERE c_ref > 0)::BIGINT AS n_ref_cat,
                   sum(CASE WHEN c_ref * (n_cur / n_ref) = 0 THEN 'inf'::DOUBLE
                            ELSE pow(c_cur - c_ref * (n_cur / n_ref), 2) / (c_ref * (n_cur / n_ref)) END) AS chi2_stat,
                   sum(pn * ln(pn / ((pn + qn) / 2)) + qn * ln(qn / ((pn + qn) / 2))) AS js_sum,
                   sum(CASE WHEN x = first_x THEN c_ref ELSE 0 END) AS a_ref,
                   sum(CASE WHEN x = first_x THEN c_cur ELSE 0 END) AS a_cur
            FROM n_{c})"""


def _cat_select(c: str) -> str:
    pooled = "((a_ref + a_cur) / (n_ref + n_cur))"
    var = f"({pooled} * (1 - {pooled}) * (1.0 / n_ref + 1.0 / n_cur))"
    z = f"((a_ref / n_ref - a_cur / n_cur) / sqrt({var}))"
    return (
        f"SELECT feature, n_ref, n_cur, n_cat, n_ref_cat, chi2_stat, CAST(n_cat - 1 AS BIGINT) AS chi2_dof, "
        f"{chi2_sf_sql('chi2_stat', 'n_cat - 1')} AS chi2_p, "
        f"CASE WHEN {var} > 0 THEN {erfc_sql(f'abs({z}) / sqrt(2.0)')} ELSE 1.0 END AS z_p, "
        f"sqrt(greatest(0.0, js_sum / 2)) AS js FROM cat_{c}"
    )


def _drift_sql(src: str, columns: list[str], numeric: list[str], tests: list[tuple[str, str]]) -> str:
    """CTEs up to cd, the rows of column_drift; tests: (column, test) in order."""
    ctes = [_cat_ctes(src, c) for c in columns if c not in numeric] + [_num_ctes(src, c) for c in numeric]
    o = DEFAULTS
    lam = "(sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) * ks_stat)"
    score = {
        "ks": kolmogorov_sf_sql(lam),
        "z": "z_p",
        "chi2": "chi2_p",
        "wasserstein": "wasserstein / greatest(ref_std, 0.001)",
        "jensenshannon": "js",
    }
    rows = []
    for i, (c, test) in enumerate(tests):
        source = f"num_{c}" if c in numeric else f"({_cat_select(c)})"
        rows.append(
            f"SELECT {i}::INTEGER AS ordinal, '{c}' AS feature, '{'num' if c in numeric else 'cat'}' AS kind, '{test}' AS test, "
            f"n_ref, n_cur, {score[test]} AS score, "
            f"CAST({o['p_threshold'] if test in ('ks', 'z', 'chi2') else o['d_threshold']} AS DOUBLE) AS threshold FROM {source} s"
        )
    return f"""
WITH {','.join(ctes)},
sc AS ({' UNION ALL '.join(rows)}),
cd AS (SELECT ordinal, feature, kind, test, n_ref, n_cur, score, threshold,
              CAST(CASE WHEN test IN ('ks', 'z', 'chi2') THEN score < threshold ELSE score >= threshold END AS INTEGER) AS drifted
       FROM sc)
"""


def _cd_select() -> str:
    return "SELECT ordinal, feature, kind, test, n_ref, n_cur, round(score, 6) AS score, threshold, drifted FROM cd"


EVENT_TESTS = [(c, "wasserstein" if c in EVENT_NUMERIC else "jensenshannon") for c in EVENT_COLUMNS]
SUPPLIER_TESTS = [("s_acctbal", "ks"), ("balance_band", "chi2"), ("supplier_group", "chi2"), ("balance_band", "z")]
SQL = {
    "drift_ks": "WITH "
    + _num_ctes(EVENTS_SIDES, "value")
    + f"""
SELECT feature, n_ref, n_cur, round(ks_stat, 9) AS ks_stat,
       round({kolmogorov_sf_sql('(sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) * ks_stat)')}, 6) AS p_value
FROM num_value""",
    "drift_wasserstein": "WITH "
    + ",".join(_num_ctes(EVENTS_SIDES, c) for c in EVENT_NUMERIC)
    + " "
    + " UNION ALL ".join(
        f"SELECT feature, round(wasserstein, 6) AS wasserstein, round(ref_std, 6) AS ref_std, "
        f"round(wasserstein / greatest(ref_std, 0.001), 6) AS wasserstein_norm FROM num_{c}"
        for c in EVENT_NUMERIC
    ),
    "drift_chi2": "WITH "
    + ",".join(_cat_ctes(EVENTS_SIDES, c) for c in ["event_type", "props"])
    + ", cats AS ("
    + " UNION ALL ".join(_cat_select(c) for c in ["event_type", "props"])
    + ") SELECT feature, n_cat, round(chi2_stat, 6) AS chi2_stat, chi2_dof, round(chi2_p, 6) AS chi2_p FROM cats",
    "drift_js": "WITH "
    + ",".join(_cat_ctes(EVENTS_SIDES, c) for c in ["event_type", "props"])
    + ", cats AS ("
    + " UNION ALL ".join(_cat_select(c) for c in ["event_type", "props"])
    + ") SELECT feature, n_ref, n_cur, round(js, 6) AS js FROM cats",
    "drift_from_profile": "WITH "
    + ",".join([_num_ctes(EVENTS_SIDES, c) for c in EVENT_NUMERIC] + [_cat_ctes(EVENTS_SIDES, c) for c in ["event_type", "props"]])
    + " "
    + " UNION ALL ".join(
        [f"SELECT feature, n_ref, n_cur, round(ks_stat, 6) AS stat, 1::INTEGER AS within FROM num_{c}" for c in EVENT_NUMERIC]
        + [f"SELECT feature, n_ref, n_cur, round(js, 6), 1 FROM ({_cat_select(c)})" for c in ["event_type", "props"]]
    ),
    "drift_dataset": _drift_sql(EVENTS_SIDES, EVENT_COLUMNS, EVENT_NUMERIC, EVENT_TESTS) + _cd_select(),
    "drift_small_sample": _drift_sql(SUPPLIER_SIDES, SUPPLIER_COLUMNS, ["s_acctbal"], SUPPLIER_TESTS) + _cd_select(),
    "drift_null_column": f"""
WITH s AS {EVENTS_SIDES},
ks AS (SELECT CAST(sum(is_ref) AS BIGINT) AS r, CAST(sum(1 - is_ref) AS BIGINT) AS c FROM s WHERE value IS NOT NULL AND NOT isnan(value)),
ty AS (SELECT CAST(sum(1 - is_ref) AS BIGINT) AS c FROM s WHERE event_type IS NOT NULL),
"""
    + _num_ctes("s", "user_id").replace("FROM s s", "FROM s")
    + f"""
SELECT 0::INTEGER AS ordinal, 'user_id' AS feature, 'num' AS kind, 'ks' AS test, n_ref, n_cur, round(p, 6) AS score,
       CAST({DEFAULTS['p_threshold']} AS DOUBLE) AS threshold, CAST(p < {DEFAULTS['p_threshold']} AS INTEGER) AS drifted
FROM (SELECT *, {kolmogorov_sf_sql('(sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) * ks_stat)')} AS p FROM num_user_id)
UNION ALL SELECT 1, 'value', 'num', 'ks', r, 0, NULL, {DEFAULTS['p_threshold']}, 1 FROM ks
UNION ALL SELECT 2, 'event_type', 'cat', 'chi2', 0, c, NULL, {DEFAULTS['p_threshold']}, 1 FROM ty
UNION ALL SELECT 3, 'props', 'cat', 'chi2', 0, 0, NULL, {DEFAULTS['p_threshold']}, 0""",
    "drift_gate": _drift_sql(EVENTS_SIDES, EVENT_COLUMNS, EVENT_NUMERIC, EVENT_TESTS)
    + f"""
, ds AS (SELECT count(*)::BIGINT AS n_columns, sum(drifted)::BIGINT AS n_drifted FROM cd)
SELECT CASE WHEN n_drifted / n_columns >= {DEFAULTS['share_threshold']} THEN 'FAIL' ELSE 'SUCCESS' END AS status,
       CAST(n_drifted / n_columns >= {DEFAULTS['share_threshold']} AS INTEGER) AS retrain,
       n_columns, n_drifted, round(n_drifted / n_columns, 6) AS share
FROM ds""",
}

QUERIES = {
    "drift_ks": drift_ks,
    "drift_wasserstein": drift_wasserstein,
    "drift_chi2": drift_chi2,
    "drift_js": drift_js,
    "drift_dataset": drift_dataset,
    "drift_small_sample": drift_small_sample,
    "drift_null_column": drift_null_column,
    "drift_gate": drift_gate_query,
    "drift_from_profile": drift_from_profile,
}
