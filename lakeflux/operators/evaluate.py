"""Classifier evaluation (J2, A8, A9, A10, F6, K6 shape).

All metrics start from one small aggregate: counts per (truth, prediction)
pair, which has at most (number of classes)^2 rows however large the scored
table is. Everything after it runs on that small table.

A null truth or prediction is a class of its own that is never right, in every
metric: it counts in n, lowers accuracy and recall, and has its row or column in
the confusion matrix, which therefore sums to n.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeflux.operators.keyed import classify, matched, rejects

TRUTH = "target"
PRED = "Predictions"
#: More classes than this are a wrong column, not a classification.
MAX_CLASSES = 1000


def align(truth: DataFrame, predictions: DataFrame, key: str, on_bad: str = "fail") -> DataFrame:
    """Pair truth and prediction by key (J2); position is not a Spark notion.

    A truth without a prediction, a prediction without a truth, and a key that is null or repeated raise; with
    ``on_bad="reject"`` they are left out, and ``align_rejects`` has them.
    """
    return matched(classify(truth, predictions, key), key, on_bad)


def align_rejects(truth: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """(key, reason, n_left, n_right): what ``align`` cannot pair; left is the truth."""
    return rejects(classify(truth, predictions, key), key)


def pair_counts(aligned: DataFrame, truth: str = TRUTH, pred: str = PRED) -> DataFrame:
    """(truth, predicted, n): partial counts per task, one shuffle of tiny rows."""
    return aligned.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n")
    )


def accuracy(aligned: DataFrame, truth: str = TRUTH, pred: str = PRED) -> DataFrame:
    """One row: n and accuracy."""
    hit = F.coalesce(F.col(truth) == F.col(pred), F.lit(False)).cast("double")
    return aligned.agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.avg(hit).alias("accuracy"))


def per_class(counts: DataFrame) -> DataFrame:
    """label, support (true count), predicted (count), tp over the label union."""
    as_truth = counts.select(
        F.col("truth").alias("label"),
        F.col("n").alias("support"),
        F.lit(0).cast("bigint").alias("predicted_n"),
        F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).cast("bigint").alias("tp"),
    )
    as_pred = counts.select(
        F.col("predicted").alias("label"),
        F.lit(0).cast("bigint").alias("support"),
        F.col("n").alias("predicted_n"),
        F.lit(0).cast("bigint").alias("tp"),
    )
    return (
        as_truth.unionByName(as_pred)
        .groupBy("label")
        .agg(
            F.sum("support").cast("bigint").alias("support"),
            F.sum("predicted_n").cast("bigint").alias("predicted_n"),
            F.sum("tp").cast("bigint").alias("tp"),
        )
    )


def weighted_scores(aligned: DataFrame, truth: str = TRUTH, pred: str = PRED) -> DataFrame:
    """Support-weighted precision, recall and F1 (A9); 0 where undefined."""
    pc = per_class(pair_counts(aligned, truth, pred))
    precision = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.nullif(F.col("predicted_n"), F.lit(0))), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.nullif(F.col("support"), F.lit(0))), F.lit(0.0))
    scored = pc.select(
        "support",
        precision.alias("p"),
        recall.alias("r"),
    ).withColumn(
        "f",
        F.coalesce(F.try_divide(2.0 * F.col("p") * F.col("r"), F.nullif(F.col("p") + F.col("r"), F.lit(0.0))), F.lit(0.0)),
    )
    total = F.sum("support").cast("double")
    return scored.agg(
        F.sum("support").cast("bigint").alias("n"),
        (F.sum(F.col("support") * F.col("p")) / total).alias("precision"),
        (F.sum(F.col("support") * F.col("r")) / total).alias("recall"),
        (F.sum(F.col("support") * F.col("f")) / total).alias("f1"),
    )


def confusion_matrix(aligned: DataFrame, truth: str = TRUTH, pred: str = PRED) -> DataFrame:
    """Dense confusion matrix in long form (A10): one row per (truth,
    predicted) over the union of labels, zero cells included.

    The label set comes from the pair counts (classes^2 rows at most), so the
    dense grid is built from that small table, never from the scored rows. More
    than ``MAX_CLASSES`` labels raise an error.
    """
    counts = pair_counts(aligned, truth, pred)
    # structs keep null labels, which a set of plain values drops
    every = F.array_union(F.collect_set(F.struct(F.col("truth").alias("l"))), F.collect_set(F.struct(F.col("predicted").alias("l"))))
    labels = counts.agg(every.alias("labels")).select(
        F.when(F.size("labels") <= MAX_CLASSES, F.col("labels")).otherwise(F.raise_error(F.lit(f"more than {MAX_CLASSES} classes"))).alias("labels")
    )
    grid = labels.select(F.explode("labels").alias("t"), "labels").select(
        F.col("t.l").alias("truth"), F.explode("labels").alias("p")
    ).select("truth", F.col("p.l").alias("predicted"))
    c = counts.select(F.col("truth").alias("__t"), F.col("predicted").alias("__p"), "n")
    same = F.col("truth").eqNullSafe(F.col("__t")) & F.col("predicted").eqNullSafe(F.col("__p"))
    return grid.join(c, same, "left").select("truth", "predicted", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def confusion_wide(aligned: DataFrame, labels: list, truth: str = TRUTH, pred: str = PRED) -> DataFrame:
    """The confusion matrix with a column a predicted label and a row a true one, for named labels; a label that no
    row has counts zero, and rows of labels that are not named are in no cell."""
    spark = aligned.sparkSession
    kind = aligned.schema[truth].dataType.simpleString()
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], f"ordinal int, truth {kind}")
    wide = pair_counts(aligned, truth, pred).groupBy(F.col("truth").alias("__t")).pivot("predicted", labels).agg(F.sum("n"))
    return rows.join(wide, F.col("truth") == F.col("__t"), "left").select("truth", *[F.coalesce(F.col(f"`{x}`"), F.lit(0)).cast("bigint").alias(str(x)) for x in labels])


def metrics_long(metrics_row: DataFrame, run_id: str) -> DataFrame:
    """Wide one-row metrics -> (run_id, metric, value) rows (K6)."""
    cols = [c for c in metrics_row.columns]
    casted = metrics_row.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return casted.unpivot([], cols, "metric", "value").select(
        F.lit(run_id).alias("run_id"), "metric", "value"
    )
