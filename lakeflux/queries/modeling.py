"""Feature / model family: stats, scaling, split, label join, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeflux.operators.evaluate import (
    accuracy,
    align,
    confusion_matrix,
    confusion_wide,
    metrics_long,
    weighted_scores,
)
from lakeflux.operators.features import attach_label, feature_stats, seeded_split, standardize
from lakeflux.operators.keyed import pair_checked
from lakeflux.queries.common import RUN_ID, load, r6
from lakeflux.session import work_dir
from lakeflux.sinks.metrics_log import compact, metrics_latest, upsert_metrics

LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return feature_stats(li, LINEITEM_FEATURES).select(
        "ordinal", "feature", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std")
    )


def q_feature_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", *LINEITEM_FEATURES, F.col("l_returnflag").alias("target")
    )
    scaled = standardize(li, LINEITEM_FEATURES)
    return scaled.select("l_orderkey", "l_linenumber", *[r6(F.col(c)).alias(c) for c in LINEITEM_FEATURES], "target")


def q_feature_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    return seeded_split(orders, "o_orderkey", 0.2, 42).select("o_orderkey", "split")


def q_feature_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    x = orders.where(F.col("o_orderstatus").isin("O", "F")).select("o_orderkey", "o_totalprice", "o_custkey")
    y = orders.where(F.col("o_orderpriority") != "5-LOW").select("o_orderkey", F.col("o_orderstatus").alias("target"))
    return attach_label(x, y, "o_orderkey")


# Rule-based scorer standing in for a model: never predicts 'P', and predicts
# 'U', a class the truth never has.
def _predictions(orders: DataFrame) -> DataFrame:
    pred = (
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "F")
        .when(F.col("o_totalprice") >= 250000, "O")
        .otherwise("U")
    )
    return orders.select("o_orderkey", pred.alias("Predictions"))


def _aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    truth = orders.select("o_orderkey", F.col("o_orderstatus").alias("target"))
    return align(truth, _predictions(orders), "o_orderkey")


def q_eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accuracy(_aligned(spark, sf_dir)).select("n", r6(F.col("accuracy")).alias("accuracy"))


def q_eval_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = weighted_scores(_aligned(spark, sf_dir))
    return w.select("n", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


def q_eval_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(_aligned(spark, sf_dir))


def q_eval_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = _aligned(spark, sf_dir)
    acc = accuracy(aligned).select("accuracy")
    w = weighted_scores(aligned).select("precision", "recall", "f1")
    # both are one-row aggregates; union them as long rows instead of joining
    long = metrics_long(acc, RUN_ID).unionByName(metrics_long(w, RUN_ID))
    return long.select("run_id", "metric", r6(F.col("value")).alias("value"))


def q_pred_vs_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aligned(spark, sf_dir).select("o_orderkey", "target", "Predictions")


def q_eval_null_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The confusion matrix where some truths and some predictions are null, with accuracy and weighted recall beside it."""
    a = _aligned(spark, sf_dir).select(
        F.when(F.col("o_orderkey") % 7 != 0, F.col("target")).alias("target"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("Predictions")).alias("Predictions"),
    )
    acc = accuracy(a)
    return confusion_matrix(a).select(
        "truth",
        "predicted",
        "n",
        r6(acc.select("accuracy").scalar()).alias("accuracy"),
        r6(weighted_scores(a).select("recall").scalar()).alias("recall"),
    )


def q_eval_confusion_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a true label, a column a predicted one."""
    return confusion_wide(_aligned(spark, sf_dir), ["F", "O", "P", "U"])


def _loose_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Truths and predictions of which some are missing, some repeated and some without a key."""
    orders = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    truth = orders.select(F.when(k % 19 != 0, k).alias("o_orderkey"), F.col("o_orderstatus").alias("target")).where(F.coalesce(F.col("o_orderkey") % 11 != 0, F.lit(True)))
    pred = _predictions(orders)
    return truth.union(truth.where(k % 13 == 0)), pred.where(k % 7 != 0).union(pred.where(k % 17 == 0))


def q_align_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and rows by what keeps them from being paired, beside the counts that the pairing observed."""
    rows, bad, seen = pair_checked(*_loose_sides(spark, sf_dir), "o_orderkey")
    observed = F.create_map(*[F.lit(x) for k, v in seen.items() for x in (k, v)])
    fine = rows.agg(F.lit("matched").alias("reason"), F.count(F.lit(1)).alias("n_keys"), F.count(F.lit(1)).alias("n_left"), F.count(F.lit(1)).alias("n_right"))
    by = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
    return fine.unionByName(by).withColumn("observed", F.element_at(observed, F.translate("reason", " ", "_")))


def q_metrics_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean order price by status logged by two runs, one of them retried with other values: one row a key, the newest."""
    orders = load(spark, sf_dir, "orders")
    table = work_dir(spark, "metrics-orders")
    totals = orders.groupBy("o_orderstatus").agg(F.avg("o_totalprice").alias("value"))
    at = lambda run, value: totals.select(F.lit(run).alias("run_id"), F.concat(F.lit("mean_"), "o_orderstatus").alias("metric"), value.alias("value"))
    upsert_metrics(at("run-1", F.col("value") * 2), table)
    upsert_metrics(at("run-2", F.col("value") * 3), table)
    compact(spark, table)
    upsert_metrics(at("run-1", F.col("value")).where("metric <> 'mean_P'"), table)
    return metrics_latest(spark, table).select("run_id", "metric", r6(F.col("value")).alias("value"))


PRED_SQL = """CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'F'
     WHEN o_totalprice >= 250000 THEN 'O' ELSE 'U' END"""
ALIGNED_SQL = f"SELECT o_orderkey, o_orderstatus AS target, {PRED_SQL} AS Predictions FROM orders"
PER_CLASS_SQL = f"""
WITH a AS ({ALIGNED_SQL}),
c AS (SELECT target AS truth, Predictions AS predicted, count(*) AS n FROM a GROUP BY ALL),
pc AS (SELECT label, sum(support) AS support, sum(pn) AS pn, sum(tp) AS tp FROM (
         SELECT truth AS label, n AS support, 0 AS pn, CASE WHEN truth = predicted THEN n ELSE 0 END AS tp FROM c
         UNION ALL SELECT predicted, 0, n, 0 FROM c) u GROUP BY label),
s AS (SELECT support, coalesce(tp / nullif(pn, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r FROM pc),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM s),
w AS (SELECT sum(support)::BIGINT AS n, sum(support * p) / sum(support) AS precision,
             sum(support * r) / sum(support) AS recall, sum(support * f) / sum(support) AS f1 FROM f)
"""

SQL = {
    "feature_stats": """
SELECT 0 AS ordinal, 'l_quantity' AS feature, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std FROM lineitem
UNION ALL SELECT 1, 'l_extendedprice', round(avg(l_extendedprice), 6), round(stddev_pop(l_extendedprice), 6) FROM lineitem
UNION ALL SELECT 2, 'l_discount', round(avg(l_discount), 6), round(stddev_pop(l_discount), 6) FROM lineitem
UNION ALL SELECT 3, 'l_tax', round(avg(l_tax), 6), round(stddev_pop(l_tax), 6) FROM lineitem
""",
    "feature_scale": """
WITH s AS (SELECT avg(l_quantity) mq, coalesce(nullif(stddev_pop(l_quantity), 0), 1) sq,
                  avg(l_extendedprice) me, coalesce(nullif(stddev_pop(l_extendedprice), 0), 1) se,
                  avg(l_discount) md, coalesce(nullif(stddev_pop(l_discount), 0), 1) sd,
                  avg(l_tax) mt, coalesce(nullif(stddev_pop(l_tax), 0), 1) st FROM lineitem)
SELECT l_orderkey, l_linenumber,
       round((l_quantity - mq) / sq, 6) AS l_quantity,
       round((l_extendedprice - me) / se, 6) AS l_extendedprice,
       round((l_discount - md) / sd, 6) AS l_discount,
       round((l_tax - mt) / st, 6) AS l_tax,
       l_returnflag AS target
FROM lineitem, s
""",
    "feature_split": """
WITH r AS (SELECT o_orderkey,
                  row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey) AS rn,
                  count(*) OVER () AS n
           FROM orders)
SELECT o_orderkey, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM r
""",
    "feature_label_join": """
SELECT * FROM (SELECT o_orderkey, o_totalprice, o_custkey FROM orders WHERE o_orderstatus IN ('O','F')) x
FULL JOIN (SELECT o_orderkey, o_orderstatus AS target FROM orders WHERE o_orderpriority <> '5-LOW') y
USING (o_orderkey)
""",
    "eval_accuracy": f"""
SELECT count(*)::BIGINT AS n, round(avg(CASE WHEN target = Predictions THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM ({ALIGNED_SQL}) a
""",
    "eval_weighted": PER_CLASS_SQL
    + "SELECT n, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM w",
    "eval_confusion": f"""
WITH a AS ({ALIGNED_SQL}),
l AS (SELECT target AS label FROM a UNION SELECT Predictions FROM a),
c AS (SELECT target AS truth, Predictions AS predicted, count(*) AS n FROM a GROUP BY ALL)
SELECT t.label AS truth, p.label AS predicted, coalesce(c.n, 0)::BIGINT AS n
FROM l t, l p LEFT JOIN c ON c.truth = t.label AND c.predicted = p.label
""",
    "eval_null_labels": f"""
WITH a AS (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN target END AS target,
                  CASE WHEN o_orderkey % 5 <> 0 THEN Predictions END AS Predictions FROM ({ALIGNED_SQL}) x),
l AS (SELECT target AS label FROM a UNION SELECT Predictions FROM a),
c AS (SELECT target AS truth, Predictions AS predicted, count(*) AS n FROM a GROUP BY ALL),
h AS (SELECT round(avg(CASE WHEN target = Predictions THEN 1.0 ELSE 0.0 END), 6) AS r FROM a)
SELECT t.label AS truth, p.label AS predicted, coalesce(c.n, 0)::BIGINT AS n, h.r AS accuracy, h.r AS recall
FROM l t, h, l p LEFT JOIN c ON c.truth IS NOT DISTINCT FROM t.label AND c.predicted IS NOT DISTINCT FROM p.label
""",
    "eval_metrics_long": PER_CLASS_SQL
    + f""",
acc AS (SELECT avg(CASE WHEN target = Predictions THEN 1.0 ELSE 0.0 END) AS accuracy FROM ({ALIGNED_SQL}) a)
SELECT '{RUN_ID}' AS run_id, 'accuracy' AS metric, round(accuracy, 6) AS value FROM acc
UNION ALL SELECT '{RUN_ID}', 'precision', round(precision, 6) FROM w
UNION ALL SELECT '{RUN_ID}', 'recall', round(recall, 6) FROM w
UNION ALL SELECT '{RUN_ID}', 'f1', round(f1, 6) FROM w
""",
    "pred_vs_true": ALIGNED_SQL,
    "eval_confusion_wide": f"""
WITH a AS ({ALIGNED_SQL})
SELECT t.truth, count(*) FILTER (WHERE Predictions = 'F')::BIGINT AS F, count(*) FILTER (WHERE Predictions = 'O')::BIGINT AS O,
       count(*) FILTER (WHERE Predictions = 'P')::BIGINT AS P, count(*) FILTER (WHERE Predictions = 'U')::BIGINT AS U
FROM (VALUES ('F'), ('O'), ('P'), ('U')) t(truth) LEFT JOIN a ON a.target = t.truth GROUP BY t.truth
""",
    "align_rejects": """
WITH t0 AS (SELECT * FROM (SELECT CASE WHEN o_orderkey % 19 <> 0 THEN o_orderkey END AS k FROM orders) x WHERE coalesce(k % 11 <> 0, true)),
t AS (SELECT k FROM t0 UNION ALL SELECT k FROM t0 WHERE k % 13 = 0),
p AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 7 <> 0 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 17 = 0),
n AS (SELECT k, sum(l) AS l, sum(r) AS r FROM (SELECT k, 1 AS l, 0 AS r FROM t UNION ALL SELECT k, 0, 1 FROM p) u GROUP BY k),
c AS (SELECT *, CASE WHEN k IS NULL THEN 'null key' WHEN l > 1 AND r > 1 THEN 'repeated on both sides' WHEN l > 1 THEN 'repeated on the left'
                     WHEN r > 1 THEN 'repeated on the right' WHEN r = 0 THEN 'left only' WHEN l = 0 THEN 'right only' ELSE 'matched' END AS reason FROM n)
SELECT reason, count(*)::BIGINT AS n_keys, sum(l)::BIGINT AS n_left, sum(r)::BIGINT AS n_right, count(*)::BIGINT AS observed FROM c GROUP BY reason
""",
    "metrics_latest": """
WITH s AS (SELECT o_orderstatus AS st, avg(o_totalprice) AS v FROM orders GROUP BY 1)
SELECT 'run-1' AS run_id, 'mean_' || st AS metric, round(CASE WHEN st = 'P' THEN v * 2 ELSE v END, 6) AS value FROM s
UNION ALL SELECT 'run-2', 'mean_' || st, round(v * 3, 6) FROM s
""",
}

QUERIES = {
    "feature_stats": q_feature_stats,
    "feature_scale": q_feature_scale,
    "feature_split": q_feature_split,
    "feature_label_join": q_feature_label_join,
    "eval_accuracy": q_eval_accuracy,
    "eval_weighted": q_eval_weighted,
    "eval_confusion": q_eval_confusion,
    "eval_null_labels": q_eval_null_labels,
    "eval_metrics_long": q_eval_metrics_long,
    "pred_vs_true": q_pred_vs_true,
    "eval_confusion_wide": q_eval_confusion_wide,
    "align_rejects": q_align_rejects,
    "metrics_latest": q_metrics_latest,
}
