"""Model fit, artefacts and batch scoring (F3, F4, F5) with Spark ML.

The classifier is a multinomial logistic regression with an L2 penalty,
inverse strength ``C`` = 1 and 100 iterations by default. The penalty of an
objective written as ``0.5 * |w|^2 + C * sum(loss)`` equals Spark's
``regParam * 0.5 * |w|^2 + mean(loss)`` with ``regParam = 1 / (C * n)``.
Features are expected already standardised (F1), so Spark's own
standardisation is off. Training runs distributed (tree aggregation of
gradients); scoring is a map-only projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeflux.operators.evaluate import MAX_CLASSES

PRED_COL = "Predictions"


def _usable(features: Sequence[str] | str):
    """True where no feature is null or NaN."""
    if isinstance(features, str):
        return F.coalesce(F.forall(features, lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(False))
    ok = F.lit(True)
    for c in features:
        x = F.col(c).cast("double")
        ok = ok & x.isNotNull() & ~F.isnan(x)
    return ok


def split_unusable(df: DataFrame, features: Sequence[str] | str) -> tuple[DataFrame, DataFrame]:
    """Rows that can be fitted or scored, and the others (a null or NaN feature)."""
    return df.where(_usable(features)), df.where(~_usable(features))


def feature_vector(df: DataFrame, features: Sequence[str] | str, out: str = "features") -> DataFrame:
    """Numeric columns, or one array column, as an ML vector column. A null or
    NaN feature raises; ``split_unusable`` sets such rows aside before."""
    if isinstance(features, str):
        checked = F.when(_usable(features), F.col(features)).otherwise(F.raise_error(F.lit(f"null or NaN in {features}")))
        return df.withColumn(out, array_to_vector(checked))
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def fit_classifier(train: DataFrame, label: str, c: float = 1.0, max_iter: int = 100, features_col: str = "features") -> PipelineModel:
    """Fit label indexing + logistic regression + label decoding.

    One small aggregate (count per label: at most #classes rows) gives both
    the label vocabulary and n for the penalty, so no separate indexer fit
    or count pass runs before the optimiser.
    """
    counts = train.groupBy(F.col(label).cast("string").alias("l")).count().limit(MAX_CLASSES + 2).collect()
    if len(counts) > MAX_CLASSES + 1:
        raise ValueError(f"{label!r} has more than {MAX_CLASSES} values: not a class label")
    labels = sorted(r["l"] for r in counts if r["l"] is not None)
    n = sum(r["count"] for r in counts if r["l"] is not None)
    if not labels:
        raise ValueError("no labelled rows to train on")
    indexer = StringIndexerModel.from_labels(labels, inputCol=label, outputCol="__label_idx", handleInvalid="error")
    lr = LogisticRegression(
        featuresCol=features_col,
        labelCol="__label_idx",
        predictionCol="__pred_idx",
        family="multinomial",
        regParam=1.0 / (c * max(n, 1)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-4,
    )
    decoder = IndexToString(inputCol="__pred_idx", outputCol=PRED_COL, labels=labels)
    return Pipeline(stages=[indexer, lr, decoder]).fit(train.where(F.col(label).isNotNull()))


def save_model(model: PipelineModel, path: str) -> str:
    """Versioned artefact folder (F5); overwrite an existing version."""
    model.write().overwrite().save(path)
    return path


def save_scaler(spark, scaler: dict[str, tuple[float, float]], path: str) -> str:
    """The fitted means and stds beside the model (F5), one row a feature."""
    rows = [(k, float(m), float(s)) for k, (m, s) in scaler.items()]
    spark.createDataFrame(rows, "feature string, mean double, std double").coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_scaler(spark, path: str) -> dict[str, tuple[float, float]]:
    """What save_scaler wrote: one row a feature."""
    return {r["feature"]: (r["mean"], r["std"]) for r in spark.read.parquet(path).collect()}


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """``key, Predictions`` for every row."""
    return model.transform(df).select(key, PRED_COL)
