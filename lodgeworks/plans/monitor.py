"""Scheduled check of a prediction log against a reference snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lodgeworks.operators.drift import monitor_rows, retrain_decision
from lodgeworks.sources.files import append_log


def monitor(
    reference: DataFrame, current: DataFrame, run_ts: str, log_path: str | None = None,
    columns: Sequence[str] | None = None, **names: str,
) -> DataFrame:
    """Compute the three metrics once, log them if a path is given, and decide on retraining."""
    rows = monitor_rows(reference, current, run_ts, columns=columns, **names)
    if log_path is not None:
        # A dozen values: fixed here so that the log and the decision see the same numbers.
        rows = rows.sparkSession.createDataFrame(rows.collect(), rows.schema)
        append_log(rows, log_path)
    return retrain_decision(rows)
