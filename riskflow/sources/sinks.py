"""Batch writers. Tables are written to a path of their own; a path being read is never overwritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_splits(df: DataFrame, path: str) -> str:
    """A labelled table as Parquet, one directory per split. ``path`` must be new (one per data version)."""
    df.write.mode("errorifexists").partitionBy("split").parquet(path)
    return path


#: Records of a log repeat their field names, so that even a fast codec makes them several times smaller. Compressed files can't
#: be split among readers, hence the limit on what one file holds.
LOG_CODEC = "snappy"
LOG_FILE_RECORDS = 500_000


def append_log(df: DataFrame, path: str) -> None:
    """Prediction, label or request records as JSON lines, compressed."""
    writer = df.write.mode("append").option("ignoreNullFields", False).option("maxRecordsPerFile", LOG_FILE_RECORDS)
    writer.option("compression", LOG_CODEC).json(path)


def write_request_lines(df: DataFrame, path: str, line: str = "line") -> None:
    """Requests as they came, one on a line, compressed."""
    writer = df.select(line).write.mode("append").option("maxRecordsPerFile", LOG_FILE_RECORDS)
    writer.option("compression", LOG_CODEC).text(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report of a few rows, as one JSON-lines file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_table_csv(df: DataFrame, path: str) -> None:
    """A comparison table of a few rows, as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_snapshot(snapshot: DataFrame, path: str) -> None:
    """Monitoring history; the per-feature PSI stays in the current report only."""
    snapshot.drop("feature_psi").coalesce(1).write.mode("append").parquet(path)


def alert_rows(df: DataFrame, title: str, time: Column) -> DataFrame:
    """Turn rows into alert events; all their columns become the payload."""
    payload = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return df.select(time.alias("time"), F.lit(title).alias("title"), payload.alias("payload"))


def append_alerts(alerts: DataFrame, path: str) -> None:
    alerts.write.mode("append").json(path)
