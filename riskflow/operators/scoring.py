"""Batch scoring, the follow-up decision and the prediction log."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.contract import INPUT_COLS, REQUEST_RULES
from riskflow.operators.evaluation import score_threshold
from riskflow.operators.ranking import value_counts
from riskflow.params import Params
from riskflow.session import stage
from riskflow.sources.sinks import append_log


def score(df: DataFrame, model: Transformer, keep: tuple[str, ...] = ("encounter_id",)) -> DataFrame:
    """(keep..., score) from raw encounter columns, with the transformation used in training."""
    # The features replace some input columns, so what the caller wants back travels in a struct.
    inputs = [F.col(f"`{c}`") for c in INPUT_COLS if c in df.columns]
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_kept"), *inputs)
    return model.transform(packed).select("_kept.*", "score")


def fit_threshold(scores: DataFrame, k_frac: float = Params().top_k_frac) -> DataFrame:
    """One row: the score that flags the top share, 6 decimals."""
    counts = stage(value_counts(scores, "score"))
    return score_threshold(counts, k_frac).select(F.round("threshold", 6).alias("threshold"))


def decide(scored: DataFrame, threshold: float | Column, version: str) -> DataFrame:
    """The response: (encounter_id, risk_score, follow_up, model_version)."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return scored.select(
        "encounter_id", F.round("score", 5).alias("risk_score"), (F.col("score") >= limit).alias("follow_up"),
        F.lit(version).alias("model_version"),
    )


def log_rows(df: DataFrame, model: Transformer, threshold: float, version: str, now: Column) -> DataFrame:
    """Prediction-log records: response fields plus the request they answer."""
    fields = [r.name for r in REQUEST_RULES]
    scored = score(df, model, keep=tuple(fields))
    return scored.select(
        now.alias("ts"), F.uuid().alias("request_id"), F.lit(version).alias("model_version"), "score",
        (F.col("score") >= F.lit(float(threshold))).alias("follow_up"),
        F.struct(*[F.col(f"`{c}`") for c in fields]).alias("features"),
    )


def score_and_log(
    df: DataFrame, model: Transformer, threshold: float, version: str, now: Column, log_path: str | None = None
) -> DataFrame:
    """Score accepted requests, append them to the log, and return the responses."""
    rows = stage(log_rows(df, model, threshold, version, now))
    if log_path is not None:
        append_log(rows, log_path)
    return decide(rows.select("features.encounter_id", "score"), threshold, version)
