"""The quality gate: metrics compared with limits, with a baseline and with the current champion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.params import Params

RULE_SCHEMA = "check string, metric string, op string, limit double, against string, required boolean"


def gate_rules(spark: SparkSession, params: Params = Params()) -> DataFrame:
    """One row per check. ``against`` names the model whose value is added to the limit.

    A check that is not required is skipped when its metric or its reference model is absent.
    """
    rows = [
        ("pr_auc_min", "pr_auc", ">=", params.min_pr_auc, None, True),
        ("beats_baseline", "pr_auc", ">=", params.min_gain_over_baseline, "baseline", True),
        ("brier_max", "brier", "<=", params.max_brier, None, True),
        ("fairness_gap_max", "fairness_gap", "<=", params.max_fairness_gap, None, True),
        ("not_worse_than_champion", "pr_auc", ">=", -params.max_regression_vs_champion, "champion", False),
        ("size_max", "model_size_mb", "<=", params.max_model_size_mb, None, False),
        ("score_time_max", "score_seconds_per_million_rows", "<=",
         params.max_score_seconds_per_million_rows, None, False),
    ]
    rows = [(check, metric, op, float(limit), *rest) for check, metric, op, limit, *rest in rows]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def evaluate_gate(metrics: DataFrame, rules: DataFrame, candidate: str = "candidate") -> DataFrame:
    """(check, metric, value, limit, passed) per check.

    ``metrics`` is (model, metric, value) for the candidate, the baseline and, if any, the champion.
    """
    own = metrics.where(F.col("model") == candidate).select("metric", "value")
    other = metrics.select(F.col("model").alias("against"), "metric", F.col("value").alias("other"))
    joined = rules.join(own, "metric", "left").join(other, ["metric", "against"], "left")
    present = F.col("value").isNotNull() & (F.col("against").isNull() | F.col("other").isNotNull())
    limit = F.col("limit") + F.coalesce("other", F.lit(0.0))
    ok = F.when(F.col("op") == ">=", F.col("value") >= limit).otherwise(F.col("value") <= limit)
    return joined.where(F.col("required") | present).select(
        "check", "metric", "value", limit.alias("limit"), F.coalesce(ok & present, F.lit(False)).alias("passed")
    )


def verdict(checks: DataFrame) -> DataFrame:
    return checks.agg(F.coalesce(F.bool_and("passed"), F.lit(False)).alias("passed"))


def result(
    checks: DataFrame, metrics: DataFrame, fairness: DataFrame, version: str, candidate: str = "candidate"
) -> DataFrame:
    """One row: version, status, checks, the candidate's metrics and the recall of each group."""
    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name))

    own = metrics.where(F.col("model") == candidate).select("metric", "value")
    parts = [packed(checks, "checks"), packed(own, "metrics"), packed(fairness, "fairness")]
    # Three one-row summaries side by side, as scalar subqueries of the verdict.
    row = verdict(checks)
    for part in parts:
        name = part.columns[0]
        row = row.withColumn(name, part.select(name).scalar())
    return row.select(
        F.lit(version).alias("version"),
        F.when(F.col("passed"), "approved").otherwise("rejected").alias("status"),
        "passed", "checks", "metrics", "fairness",
    )

