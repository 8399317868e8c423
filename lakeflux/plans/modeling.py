"""Feature -> train -> score -> evaluate chain, one table per step boundary.

1. ``prepare``: standardise features on all rows (F1), seeded split (F2),
   publish the feature set by snapshot and split (K7), save the scaler (F5).
2. ``train``: fit on the newest snapshot's train partition (F3), save the artefact (F5).
3. ``score_and_evaluate``: load, score the newest test partition (F4), publish the
   predictions by snapshot (K3, S7), align by key (J2), accuracy and weighted scores
   (A8, A9), confusion matrix (A10), metric rows and per-feature means in the
   metrics log, where a run that is retried replaces its own (K6).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeflux.operators.evaluate import accuracy, align, confusion_matrix, metrics_long, weighted_scores
from lakeflux.operators.features import SPLIT_COL, fit_scaler, seeded_split, standardize
from lakeflux.operators.model import feature_vector, fit_classifier, load_model, load_scaler, save_model, save_scaler, score
from lakeflux.sinks.files import publish_feature_set
from lakeflux.sinks.metrics_log import upsert_metrics
from lakeflux.sources.snapshot import SNAPSHOT_COL, latest_snapshot, publish_snapshot, read_latest_snapshot


def scaler_path(feature_set: str) -> str:
    """Where ``prepare`` keeps the scaler of a feature set; a name that no reader takes for a partition."""
    return f"{feature_set.rstrip('/')}/_scaler"


def prepare(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    path: str,
    test_fraction: float = 0.2,
    seed: int = 42,
    snapshot: str = "00000000",
) -> str:
    rows = df.select(key, *features, label)
    scaler = fit_scaler(rows, features)
    split = seeded_split(rows, key, test_fraction, seed)
    publish_feature_set(standardize(split, features, scaler=scaler), path, SPLIT_COL, snapshot)
    save_scaler(df.sparkSession, scaler, scaler_path(path))
    return path


def scale_new_rows(df: DataFrame, features: Sequence[str], feature_set: str) -> DataFrame:
    """New rows as the model expects them, with the saved scaler."""
    return standardize(df, features, scaler=load_scaler(df.sparkSession, scaler_path(feature_set)))


def train(spark: SparkSession, feature_set: str, features: Sequence[str] | str, label: str, model_path: str) -> str:
    data = feature_vector(read_latest_snapshot(spark, feature_set).where(F.col(SPLIT_COL) == "train"), features)
    return save_model(fit_classifier(data, label), model_path)


def score_and_evaluate(
    spark: SparkSession,
    feature_set: str,
    features: Sequence[str] | str,
    key: str,
    label: str,
    model_path: str,
    run_id: str,
    metrics_path: str | None = None,
    predictions_path: str | None = None,
) -> dict[str, DataFrame]:
    test = read_latest_snapshot(spark, feature_set).where(F.col(SPLIT_COL) == "test")
    predictions = score(load_model(model_path), feature_vector(test, features), key)
    if predictions_path is not None:
        # publish the predictions (K3) and evaluate from the written table, so
        # the model runs once however many metrics read its output
        publish_snapshot(predictions, predictions_path, latest_snapshot(spark, feature_set))
        predictions = read_latest_snapshot(spark, predictions_path).drop(SNAPSHOT_COL)
    aligned = align(test.select(key, F.col(label).alias("target")), predictions, key)
    acc = accuracy(aligned).select("accuracy")
    scores = weighted_scores(aligned).select("precision", "recall", "f1")
    metrics = metrics_long(acc, run_id).unionByName(metrics_long(scores, run_id))
    if metrics_path is not None:
        logged = metrics
        if not isinstance(features, str):
            means = [(run_id, f"mean_{k}", m) for k, (m, _) in load_scaler(spark, scaler_path(feature_set)).items()]
            logged = metrics.unionByName(spark.createDataFrame(means, "run_id string, metric string, value double"))
        upsert_metrics(logged, metrics_path)
    return {"predictions": aligned, "metrics": metrics, "confusion": confusion_matrix(aligned)}
