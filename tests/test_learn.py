"""The model queries: what reaches the fit."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeflux.queries import learn
from lakeflux.queries.common import load
from tests.conftest import SF_SMALL


def test_model_fit_score_takes_the_whole_vector(spark, monkeypatch):
    seen, bounds = [], []
    fit, summary = learn.fit_classifier, learn._summary

    def fit_seen(train, *a, **k):
        seen.extend(r.n for r in train.select(F.size("embedding").alias("n")).distinct().collect())
        return fit(train, *a, **k)

    def summary_seen(aligned, least):
        bounds.append(least)
        return summary(aligned, least)

    monkeypatch.setattr(learn, "fit_classifier", fit_seen)
    monkeypatch.setattr(learn, "_summary", summary_seen)
    rows = learn.model_fit_score(spark, SF_SMALL).collect()
    whole = load(spark, SF_SMALL, "embeddings").select(F.size("embedding").alias("n")).distinct().collect()
    assert seen == [r.n for r in whole] and bounds == [0.9]
    assert rows and all(r.accurate == 1 for r in rows)
