"""Readers, writers, the generated cohort and the views derived from the test tables."""

from riskflow.sources.readers import (
    read_encounters_csv, read_label_log, read_prediction_log, read_request_lines, read_split, read_splits,
)
from riskflow.sources.sinks import (
    append_alerts, append_log, append_snapshot, write_report, write_splits, write_table_csv,
)

__all__ = [
    "append_alerts", "append_log", "append_snapshot", "read_encounters_csv", "read_label_log",
    "read_prediction_log", "read_request_lines", "read_split", "read_splits", "write_report",
    "write_splits", "write_table_csv",
]
