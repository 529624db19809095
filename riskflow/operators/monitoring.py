"""Live predictions joined with late outcomes, and the monitoring snapshot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators import drift
from riskflow.operators.evaluation import curve_metrics, pr_curve, score_counts
from riskflow.operators.features import clean, profile
from riskflow.operators.joins import HOT_ROWS, join_unique
from riskflow.operators.ranking import value_counts
from riskflow.params import Params
from riskflow.session import stage

GAUGES = [
    "data_drift", "drift_share", "prediction_psi", "prediction_drift", "concept_drift", "label_shift",
    "live_pr_auc", "ref_pr_auc", "live_roc_auc", "ref_roc_auc", "n_labeled", "max_feature_psi",
]


def flatten_predictions(log: DataFrame) -> DataFrame:
    """The request fields as columns, with request id, time, score and model version."""
    return log.select(
        "request_id", "ts", "features.*", "score", F.col("model_version").cast("string").alias("model_version")
    )


def recent(log: DataFrame, window: int | None = Params().window_size) -> DataFrame:
    """The last ``window`` predictions by arrival; each task keeps its own top rows first."""
    if window is None:
        return log
    return log.orderBy(F.col("ts").desc(), F.col("request_id").desc()).limit(window)


def latest_labels(labels: DataFrame) -> DataFrame:
    """The last outcome per encounter: (encounter_id, ts, readmitted_30d).

    Time and outcome are packed into one number so that the maximum per encounter stays a hash
    aggregation, combined before the shuffle. Of two outcomes at the same instant true wins; a label
    without an outcome says nothing and is left out.
    """
    known = labels.where(F.col("encounter_id").isNotNull() & F.col("ts").isNotNull() & F.col("readmitted_30d").isNotNull())
    packed = F.unix_micros("ts") * 2 + F.col("readmitted_30d").cast("bigint")
    last = known.groupBy("encounter_id").agg(F.max(packed).alias("p"))
    return last.select(
        "encounter_id", F.timestamp_micros(F.floor(F.col("p") / 2)).alias("ts"),
        (F.pmod("p", F.lit(2)) == 1).alias("readmitted_30d"),
    )


def attach_labels(predictions: DataFrame, labels: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Predictions with their latest outcome; repeated predictions of an encounter all stay."""
    outcome = latest_labels(labels).select("encounter_id", "readmitted_30d")
    return join_unique(predictions, outcome, "encounter_id", F.col("request_id"), hot_rows=hot_rows)


@dataclass
class Reference:
    """What monitoring compares with, as value counts: ``profile`` of the training features (feature, num, cat, n) and
    ``scores`` of the reference rows (value, n, pos). Both add up, so a new part of the reference needs no rescan."""

    profile: DataFrame
    scores: DataFrame

    def plus(self, other: Reference) -> Reference:
        profile_ = self.profile.unionByName(other.profile).groupBy("feature", "num", "cat").agg(F.sum("n").alias("n"))
        scores = self.scores.unionByName(other.scores).groupBy("value").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
        return Reference(profile_, scores)


def reference_of(train: DataFrame, scored: DataFrame) -> Reference:
    """The reference of training rows and of reference rows with ``score`` and ``target``."""
    return Reference(profile(clean(train)), score_counts(scored))


def prediction_drift(ref_scores: DataFrame, live: DataFrame, params: Params = Params()) -> DataFrame:
    """One row (prediction_psi, prediction_drift) from two tables with a ``score`` column."""
    return prediction_drift_of_counts(value_counts(ref_scores, "score"), live, params)


def prediction_drift_of_counts(ref_counts: DataFrame, live: DataFrame, params: Params = Params()) -> DataFrame:
    psi = drift.psi_of_counts(ref_counts, value_counts(live, "score"))
    return psi.select(
        F.col("psi").alias("prediction_psi"), (F.col("psi") >= params.pred_psi_threshold).alias("prediction_drift")
    )


def performance(scored: DataFrame) -> DataFrame:
    """One row of metrics of (score, target): n_rows, n_pos, pr_auc, roc_auc, pos_rate."""
    m = curve_metrics(pr_curve(stage(score_counts(scored))))
    return m.select(
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_pos", F.lit(0)).alias("n_pos"),
        "pr_auc", "roc_auc", F.try_divide("n_pos", "n_rows").alias("pos_rate"),
    )


def _drop(ref: Column, live: Column, usable: Column, limit: float) -> Column:
    return F.coalesce(usable & (ref - live >= limit), F.lit(False))


def concept_drift(reference: DataFrame, labelled: DataFrame, params: Params = Params()) -> DataFrame:
    """Reference against live performance, in one row.

    ``reference`` is (score, target), ``labelled`` is (score, readmitted_30d). The live side counts
    only with enough labels and both outcomes among them.
    """
    return concept_drift_of_counts(score_counts(reference), labelled, params)


def concept_drift_of_counts(reference: DataFrame, labelled: DataFrame, params: Params = Params()) -> DataFrame:
    """``concept_drift`` with the reference as (value, n, pos)."""
    live = score_counts(labelled.select("score", F.col("readmitted_30d").cast("int").alias("target")))
    both = reference.select(F.lit("ref").alias("model"), "value", "n", "pos").unionAll(
        live.select(F.lit("live").alias("model"), "value", "n", "pos")
    )
    by = ("model",)
    m = curve_metrics(pr_curve(stage(both), by), by)

    def of(model: str, value: Column) -> Column:
        return F.max(F.when(F.col("model") == model, value))

    rate = F.try_divide("n_pos", "n_rows")
    row = m.agg(
        *[of(s, F.col(c)).alias(f"{s}_{c}") for s in ("ref", "live") for c in ("pr_auc", "roc_auc", "n_rows", "n_pos")],
        of("ref", rate).alias("ref_pos_rate"), of("live", rate).alias("live_pos_rate"),
    )
    n = F.coalesce("live_n_rows", F.lit(0))
    usable = (n >= params.min_labels) & (F.col("live_n_pos") > 0) & (F.col("live_n_pos") < F.col("live_n_rows"))
    usable = F.coalesce(usable, F.lit(False))
    shift = F.abs(F.col("live_pos_rate") - F.col("ref_pos_rate")) >= params.label_shift_threshold
    return row.select(
        n.alias("n_labeled"), "ref_pr_auc", "ref_roc_auc", "ref_pos_rate",
        *[F.when(usable, F.col(c)).alias(c) for c in ("live_pr_auc", "live_roc_auc", "live_pos_rate")],
        _drop(F.col("ref_roc_auc"), F.col("live_roc_auc"), usable, params.perf_drop_threshold).alias("concept_drift"),
        F.coalesce(usable & shift, F.lit(False)).alias("label_shift"),
    )


def snapshot(
    psi: DataFrame, predictions: DataFrame, performance_row: DataFrame, time: Column,
    n_production: Column, version: str | None = None, params: Params = Params(),
) -> DataFrame:
    """The monitoring report as one row, put together from one-row results and the PSI table."""
    one = drift.summary(psi, params)
    table = psi.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature", "psi")))).alias("feature_psi"))
    hits = psi.where(F.col("psi") >= params.psi_threshold).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature", "psi")))).alias("drifted_features")
    )
    # Every part has exactly one row, so it enters as a scalar subquery; nothing is joined.
    parts = [(predictions, predictions.columns), (performance_row, performance_row.columns),
             (table, table.columns), (hits, hits.columns)]
    for i, (part, names) in enumerate(parts):
        packed = part.select(F.struct(*names).alias("s")).scalar()
        one = one.withColumn(f"_p{i}", packed)
    one = one.select("*", "_p0.*", "_p1.*", "_p2.*", "_p3.*")
    reason = F.when(F.col("concept_drift"), "concept_drift").when(F.col("data_drift"), "data_drift")
    return one.select(
        time.alias("time"), F.lit("ok").alias("status"), n_production.cast("bigint").alias("n_production"),
        F.lit(version).cast("string").alias("champion_version"),
        "data_drift", "drift_share", "drifted_features", "max_feature_psi", "prediction_drift", "prediction_psi",
        "concept_drift", "label_shift", "n_labeled", "ref_roc_auc", "live_roc_auc", "ref_pr_auc", "live_pr_auc",
        "ref_pos_rate", "live_pos_rate", "feature_psi",
        (F.col("concept_drift") | F.col("data_drift")).alias("retrain_recommended"), reason.alias("reason"),
    )


def gauges(snap: DataFrame) -> DataFrame:
    """(snapshot_ts, metric, value) for the 12 gauges; -1 where live performance is unknown."""
    values = [
        (F.coalesce(F.col(g), F.lit(-1.0)) if g.startswith("live_") else F.col(g).cast("double")).cast("double").alias(g)
        for g in GAUGES
    ]
    return snap.select(F.col("time").alias("snapshot_ts"), *values).unpivot(
        ["snapshot_ts"], GAUGES, "metric", "value"
    )


def alerts(snap: DataFrame) -> DataFrame:
    """Up to four alert events of a snapshot."""
    kinds = [
        ("data_drift", "DATA DRIFT DETECTED", ["drift_share", "drifted_features"]),
        ("prediction_drift", "PREDICTION DRIFT DETECTED", ["prediction_psi"]),
        ("concept_drift", "CONCEPT DRIFT DETECTED", ["ref_roc_auc", "live_roc_auc"]),
        ("label_shift", "LABEL SHIFT", ["ref_pos_rate", "live_pos_rate"]),
    ]
    events = F.array(*[
        F.when(F.col(flag), F.struct(
            F.col("time"), F.lit(title).alias("title"), F.to_json(F.struct(*cols)).alias("payload")
        ))
        for flag, title, cols in kinds
    ])
    return snap.select(F.inline(F.filter(events, lambda e: e.isNotNull())))


def monitor(
    train: DataFrame | None, reference_scored: DataFrame | None, log: DataFrame, labels: DataFrame, time: Column,
    version: str | None = None, params: Params = Params(), reference: Reference | None = None,
) -> DataFrame:
    """Snapshot of the recent predictions against the training features and the reference scores, or a stored ``reference``.

    With fewer than ``min_predictions`` predictions the snapshot says so and holds nothing else.
    """
    return monitor_recent(recent(log, params.window_size), labels, time, reference or reference_of(train, reference_scored), version, params)


def monitor_recent(
    rows: DataFrame, labels: DataFrame, time: Column, reference: Reference, version: str | None = None, params: Params = Params(),
) -> DataFrame:
    """``monitor`` for the log rows of one window."""
    preds = stage(flatten_predictions(rows))
    n = preds.count()
    if n < params.min_predictions:
        return insufficient(rows.sparkSession, time, n)
    psi = stage(drift.psi_of_profiles(reference.profile, profile(clean(preds))).withColumn("psi", F.round("psi", 4)))
    scores = stage(reference.scores)
    labelled = attach_labels(preds, labels)
    return snapshot(
        psi, prediction_drift_of_counts(scores, preds, params),
        concept_drift_of_counts(scores, labelled, params), time, F.lit(n), version, params,
    )


def insufficient(spark: SparkSession, time: Column, n: int) -> DataFrame:
    return spark.range(1).select(
        time.alias("time"), F.lit("insufficient_data").alias("status"), F.lit(n).cast("bigint").alias("n_production"),
        F.lit(False).alias("retrain_recommended"),
    )

