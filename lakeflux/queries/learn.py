"""Model family: split, fit, save, load, score, on labels that the features decide."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeflux.operators.evaluate import accuracy, align, per_class, pair_counts
from lakeflux.operators.features import seeded_split
from lakeflux.operators.model import feature_vector, fit_classifier, load_model, save_model, score
from lakeflux.plans import modeling
from lakeflux.queries.common import RUN_ID, load, r6
from lakeflux.session import work_dir
from lakeflux.sinks.files import publish_feature_set
from lakeflux.sinks.metrics_log import metrics_latest
from lakeflux.sources.snapshot import read_latest_snapshot


def _summary(aligned: DataFrame, least: float) -> DataFrame:
    """Support of each true class in the test set, its size, and whether enough of it is right."""
    size = accuracy(aligned)
    return per_class(pair_counts(aligned)).where("support > 0").select(
        F.col("label").alias("target"),
        "support",
        size.select("n").scalar().alias("n_test"),
        (size.select("accuracy").scalar() >= least).cast("int").alias("accurate"),
    )


def model_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings: a class by the sign of the first component of the whole vector, all rows; seeded split on vec_id,
    fit on train, save and reload the model, score the test rows, of which 0.9 at least are right."""
    first = F.col("embedding")[0]
    emb = load(spark, sf_dir, "embeddings")
    rows = emb.select("vec_id", F.when(first > 0, "plus").otherwise("minus").alias("target"), "embedding")
    # publish the feature set (K7) and train from the written table: the
    # split's lineage is cut before the iterative fit reads it
    features_path = publish_feature_set(seeded_split(rows, "vec_id", 0.2, 42), work_dir(spark, "feature-set-embeddings"))
    data = feature_vector(read_latest_snapshot(spark, features_path), "embedding")
    test = data.where(F.col("split") == "test")
    model = fit_classifier(data.where(F.col("split") == "train"), "target", c=1000.0)
    path = save_model(model, work_dir(spark, "model-embeddings") + "/v1")
    predictions = score(load_model(path), test, "vec_id")
    return _summary(align(test.select("vec_id", "target"), predictions, "vec_id"), 0.9)


def model_chain_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders through the whole chain: scale, split, publish, fit, save, load, score,
    evaluate, append metrics. The class is the price band. Returns the metrics log:
    feature means as they are, scores as "is at least 0.99"."""
    orders = load(spark, sf_dir, "orders")
    rows = orders.select(
        "o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey"),
        F.when(F.col("o_totalprice") >= 250000, "high").otherwise("low").alias("band"),
    )
    features = ["o_totalprice", "o_custkey"]
    root = work_dir(spark, "chain-orders")
    features_path = modeling.prepare(rows, "o_orderkey", features, "band", f"{root}/features", snapshot="20240201")
    model_path = modeling.train(spark, features_path, features, "band", f"{root}/model/v1")
    modeling.score_and_evaluate(
        spark, features_path, features, "o_orderkey", "band", model_path, RUN_ID, f"{root}/metrics", f"{root}/predictions"
    )
    predictions = read_latest_snapshot(spark, f"{root}/predictions")
    n = predictions.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit(RUN_ID).alias("run_id"), F.lit("n_test").alias("metric"), "value")
    log = metrics_latest(spark, f"{root}/metrics").unionByName(n)
    is_score = F.col("metric").isin("accuracy", "precision", "recall", "f1")
    return log.select("run_id", "metric", F.when(is_score, (F.col("value") >= 0.99).cast("double")).otherwise(r6(F.col("value"))).alias("value"))


QUERIES = {"model_fit_score": model_fit_score, "model_chain_metrics": model_chain_metrics}
SQL = {
    "model_fit_score": """
WITH e AS (SELECT vec_id, CASE WHEN embedding[1] > 0 THEN 'plus' ELSE 'minus' END AS target FROM embeddings),
r AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42')) AS rn, count(*) OVER () AS n FROM e),
t AS (SELECT * FROM r WHERE rn <= ceil(0.2 * n))
SELECT target, count(*)::BIGINT AS support, (SELECT count(*) FROM t)::BIGINT AS n_test, 1::INTEGER AS accurate FROM t GROUP BY target
""",
    "model_chain_metrics": f"""
SELECT '{RUN_ID}' AS run_id, 'mean_o_totalprice' AS metric, round(avg(o_totalprice), 6) AS value FROM orders
UNION ALL SELECT '{RUN_ID}', 'mean_o_custkey', round(avg(CAST(o_custkey AS DOUBLE)), 6) FROM orders
UNION ALL SELECT '{RUN_ID}', 'n_test', CAST(ceil(0.2 * count(*)) AS DOUBLE) FROM orders
UNION ALL SELECT '{RUN_ID}', m, CAST(1 AS DOUBLE) FROM (VALUES ('accuracy'), ('precision'), ('recall'), ('f1')) v(m)
""",
}
