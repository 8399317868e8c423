"""Monitoring job: reference vs current drift -> report -> retrain gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lakeflux.operators.columns import lower_case_names
from lakeflux.operators.drift import DEFAULTS, column_drift, drift_gate, drift_report


def monitor(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, **params
) -> dict[str, DataFrame]:
    """Column names are lower-cased on both sides (as the original loader
    did); the per-column result is checkpointed once and feeds the report and
    the gate."""
    ref, cur = lower_case_names(reference), lower_case_names(current)
    cols = [c.lower() for c in columns] if columns else None
    params["categorical"] = [c.lower() for c in params.get("categorical", ())]
    per_column = column_drift(ref, cur, cols, **params).checkpoint(eager=True)
    report = drift_report(per_column, params.get("share_threshold", DEFAULTS["share_threshold"]))
    return {"columns": per_column, "report": report, "gate": drift_gate(report)}
