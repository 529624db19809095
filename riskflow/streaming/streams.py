"""Request checking, scoring, late labels, telemetry and monitoring as streams.

Every job takes a checkpoint folder, which on a cluster belongs in shared storage. Where a batch goes
to more than one place, each micro-batch overwrites a folder named after its number, so a repeated
batch replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery
from pyspark.sql.types import StructType

from riskflow import contract as C
from riskflow.operators import quality, scoring
from riskflow.operators.telemetry import LATENCY_EDGES, bucket_flags, flag, flag_alerts, interpolate
from riskflow.sources.sinks import LOG_CODEC, alert_rows
from riskflow.streaming.windows import COMPACT_EVERY, window_writer

# A label later than this after its prediction, or earlier than this before it, is not joined in the stream; batch jobs that
# read the logs still use it.
LABEL_RANGE = "60 days"
# How far the records of a log may arrive out of order.
LATE_RECORDS = "1 day"
LATE_EVENTS = "10 minutes"


def _reader(spark: SparkSession, max_files: int | None) -> DataStreamReader:
    """``max_files`` bounds what one micro-batch takes in, for instance when a stream starts on years of logs."""
    return spark.readStream if max_files is None else spark.readStream.option("maxFilesPerTrigger", max_files)


def stream_json(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    return _reader(spark, max_files).schema(schema).json(path)


def stream_requests(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return _reader(spark, max_files).text(path).withColumnRenamed("value", "line")


def stream_predictions(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return stream_json(spark, path, C.PREDICTION_LOG_SCHEMA, max_files)


def stream_labels(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return stream_json(spark, path, C.LABEL_LOG_SCHEMA, max_files)


def _start(writer, checkpoint: str, available_now: bool, every: str = "1 minute") -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def log_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append records as compressed JSON lines, each exactly once. Read it back with ``spark.read`` on the folder."""
    writer = df.writeStream.format("json").option("path", path).outputMode("append").option("compression", LOG_CODEC)
    return _start(writer.option("ignoreNullFields", False), checkpoint, available_now)


def validate_stream(
    lines: DataFrame, accepted_path: str, quarantine_path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Route requests: valid ones typed to ``accepted_path``, the others with reasons to ``quarantine_path``."""
    def route(batch: DataFrame, batch_id: int) -> None:
        parsed = quality.parse_requests(batch).persist()
        try:
            for rows, path in ((quality.accepted(parsed), accepted_path), (quality.quarantined(parsed), quarantine_path)):
                rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            parsed.unpersist()

    return _start(lines.writeStream.foreachBatch(route), checkpoint, available_now)


def score_stream(
    lines: DataFrame, model: Transformer, threshold: float, version: str, log_path: str, checkpoint: str,
    now: Column | None = None, available_now: bool = True,
) -> StreamingQuery:
    """Check, score and log requests. The model is fixed for the run; a new version is a new start."""
    requests = quality.accepted(quality.parse_requests(lines))
    stamp = F.current_timestamp() if now is None else now
    return log_sink(scoring.log_rows(requests, model, threshold, version, stamp), log_path, checkpoint, available_now)


def label_intake(labels: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep every valid label. Which one is the last is decided on reading (``latest_labels``): a
    streaming de-duplication would keep the first."""
    return log_sink(quality.valid_labels(labels), path, checkpoint, available_now)


def join_labels(
    predictions: DataFrame, labels: DataFrame, how: str = "inner", within: str = LABEL_RANGE, early: str = LABEL_RANGE,
    late: str = LATE_RECORDS,
) -> DataFrame:
    """Predictions with the labels from ``early`` before to ``within`` after them, one row per label.

    Both logs may be out of order by ``late``. State is bounded on both sides: a prediction waits ``within`` plus ``late`` for
    labels, a label ``early`` plus ``late`` for predictions, as a corrected prediction may follow the outcome.
    ``how="left_outer"`` also lists predictions still unlabelled once the range has passed; records without a time or
    encounter are never joined.
    """
    p = predictions.select(
        "request_id", F.col("ts").alias("predicted_at"), F.col("features.encounter_id").alias("encounter_id"),
        "score", "model_version",
    ).withWatermark("predicted_at", late)
    labelled = labels.select(
        F.col("encounter_id").alias("label_id"), F.col("ts").alias("labelled_at"), "readmitted_30d"
    ).withWatermark("labelled_at", late)
    condition = (
        (F.col("encounter_id") == F.col("label_id"))
        & (F.col("labelled_at") >= F.col("predicted_at") - F.expr(f"INTERVAL {early}"))
        & (F.col("labelled_at") <= F.col("predicted_at") + F.expr(f"INTERVAL {within}"))
    )
    return p.join(labelled, condition, how).drop("label_id")


def unlabelled(joined: DataFrame) -> DataFrame:
    """Of a ``left_outer`` join's output, the predictions whose range passed without a label."""
    return joined.where(F.col("labelled_at").isNull()).select("request_id", "encounter_id", "predicted_at", "score", "model_version")


def last_label(joined: DataFrame) -> DataFrame:
    """Batch step over the joined output: the last label of each prediction."""
    last = F.max_by(F.struct("encounter_id", "score", "model_version", "readmitted_30d"),
                    F.struct("labelled_at", "readmitted_30d"))
    # An unknown outcome never hides a known one.
    last = F.coalesce(F.max_by(F.when(F.col("readmitted_30d").isNotNull(), F.struct("encounter_id", "score", "model_version", "readmitted_30d")),
                               F.when(F.col("readmitted_30d").isNotNull(), F.struct("labelled_at", "readmitted_30d"))), last)
    return joined.groupBy("request_id").agg(last.alias("r")).select("request_id", "r.*")


def telemetry(log: DataFrame, size: str = "5 minutes", step: str = "1 minute", late: str = LATE_EVENTS) -> DataFrame:
    """Requests, errors, rejected requests and latency quantiles per sliding window and endpoint."""
    sums = {"errors": flag(F.col("status") >= 500), "invalid": flag(F.col("status") == 422),
            **bucket_flags("latency_s", LATENCY_EDGES)}
    grouped = log.withWatermark("ts", late).groupBy(F.window("ts", size, step), "endpoint").agg(
        F.count("*").alias("requests"), *[F.sum(c.cast("bigint")).alias(k) for k, c in sums.items()]
    )
    cumulative = F.array(*[F.col(f"_b{i}") for i in range(len(LATENCY_EDGES))])
    return grouped.select(
        F.unix_seconds("window.start").alias("w_start"), "endpoint", "requests", "errors", "invalid",
        interpolate(cumulative, F.col("n"), LATENCY_EDGES, 0.5).alias("p50"),
        interpolate(cumulative, F.col("n"), LATENCY_EDGES, 0.95).alias("p95"),
    )


def telemetry_sink(
    windows: DataFrame, path: str, checkpoint: str, available_now: bool = True, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Write changed windows of each micro-batch; ``latest_windows`` reads the current state."""
    write = window_writer(path, every=compact_every)
    return _start(windows.writeStream.outputMode("update").foreachBatch(write), checkpoint, available_now)


def monitor_stream(
    predictions: DataFrame, run_monitor: Callable[[SparkSession], DataFrame], history_path: str, checkpoint: str,
    every: str = "5 minutes", available_now: bool = True,
) -> StreamingQuery:
    """A monitoring snapshot whenever predictions have arrived, at most once per ``every``.

    ``run_monitor`` reads the logs and a stored reference profile, so the reference is not rescanned.
    """
    def snapshot(batch: DataFrame, batch_id: int) -> None:
        row = run_monitor(batch.sparkSession).drop("feature_psi")
        row.coalesce(1).write.mode("overwrite").parquet(f"{history_path}/batch_id={batch_id}")

    arrived = predictions.select("ts")
    return _start(arrived.writeStream.foreachBatch(snapshot), checkpoint, available_now, every)


def alert_stream(gauges: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append an alert for every drift flag that is up in newly arrived gauge rows."""
    alerts = alert_rows(flag_alerts(gauges), "DRIFT FLAG UP", F.col("snapshot_ts"))
    return log_sink(alerts, path, checkpoint, available_now)

