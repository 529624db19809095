"""Whole jobs: prepare, train, gate, score, monitor, retrain. Each is one call over tables or paths."""

from __future__ import annotations

import time as clock
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow import contract as C
from riskflow.contract import TARGET
from riskflow.operators import cohort, evaluation, gate, models, monitoring, quality, retrain, scoring
from riskflow.params import Params
from riskflow.session import keep, stage
from riskflow.sources import daily, sinks, versions

FAIRNESS_COLS = ["gender", "race", "age"]


def check_table(
    raw: DataFrame, now: Column | None = None, params: Params = Params(), min_rows: int | None = None,
    report_path: str | None = None, alert_path: str | None = None,
) -> quality.ValidationReport:
    """Check a table; write the report, then an alert where there are issues, and only then raise."""
    report = quality.validate(raw, params, min_rows, raise_on_error=False)
    if report_path is not None:
        sinks.write_report(quality.report_rows(report), report_path)
    if report.passed:
        return report
    if alert_path is not None:
        sinks.append_alerts(sinks.alert_rows(quality.report_rows(report), "DATA VALIDATION FAILED", now if now is not None else F.current_timestamp()), alert_path)
    raise quality.DataValidationError(f"{report.n_issues} data issue(s): {quality.describe(report.issues)}")


def prepare(
    raw: DataFrame, root: str, params: Params = Params(), now: Column | None = None,
    report_path: str | None = None, alert_path: str | None = None,
) -> dict:
    """Check, label and split the raw table and publish it under ``root``; returns the manifest with its lineage."""
    check_table(raw, now, params, None, report_path, alert_path)
    table = cohort.with_split(cohort.make_target(raw, params.exclude_discharge_ids), params)
    return versions.publish(table, root, params, raw)


@dataclass
class Training:
    best: str
    model: PipelineModel
    threshold: float
    comparison: DataFrame
    metrics: DataFrame
    fairness: DataFrame
    models: dict[str, PipelineModel] = field(default_factory=dict)


def scored_with(model, name: str, rows: DataFrame) -> DataFrame:
    """(model, encounter_id, score, target, demographic columns) of one model over labelled rows."""
    return scoring.score(rows, model, keep=("encounter_id", TARGET, *FAIRNESS_COLS)).select(
        F.lit(name).alias("model"), "*"
    )


def train(splits: dict[str, DataFrame], params: Params = Params(), report_dir: str | None = None) -> Training:
    """Fit all experiments, choose by validation PR-AUC, measure the choice once on the test split.

    The feature transformation is fitted once, and its rows are stored for all fits. All models'
    validation scores are then evaluated together. ``report_dir`` receives the comparison as CSV and the choice's summary.
    """
    fitted = models.fit_all(params.experiments, models.fit_features(splits["train"]), params)
    candidates = {"baseline_lace": models.LaceModel(), **fitted}
    scores = None
    for name, model in candidates.items():
        one = scored_with(model, name, splits["val"])
        scores = one if scores is None else scores.unionByName(one)
    scores = stage(scores)
    order = F.create_map(*[x for i, n in enumerate(candidates) for x in (F.lit(n), F.lit(i))])
    comparison = stage(
        evaluation.evaluate_wide(scores, ("model",), params).withColumn("seq", F.element_at(order, F.col("model")))
    )
    best = evaluation.select_best(comparison.where(F.col("model") != "baseline_lace")).first()["model"]
    threshold = scoring.fit_threshold(scores.where(F.col("model") == best), params.top_k_frac).first()["threshold"]
    test = stage(
        scored_with(fitted[best], "candidate", splits["test"])
        .unionByName(scored_with(candidates["baseline_lace"], "baseline", splits["test"]))
    )
    metrics = stage(evaluation.evaluate(test, ("model",), params))
    fairness = evaluation.group_recall(test.where(F.col("model") == "candidate"), params.top_k_frac, params=params)
    if report_dir is not None:
        sinks.write_table_csv(comparison.orderBy("seq").drop("seq"), f"{report_dir}/experiments")
        summary = metrics.withColumns({"best": F.lit(best), "threshold": F.lit(threshold)})
        sinks.write_report(summary, f"{report_dir}/train_summary")
    return Training(best, fitted[best], threshold, comparison, metrics, fairness, fitted)


def operational_metrics(spark: SparkSession, model: PipelineModel, rows: DataFrame, path: str) -> DataFrame:
    """Saved size and scoring time of the candidate, as metric rows. ``path`` receives the model."""
    model.write().overwrite().save(path)
    n = rows.count()
    start = clock.perf_counter()
    scoring.score(rows, model).write.format("noop").mode("overwrite").save()
    seconds = (clock.perf_counter() - start) / max(n, 1) * 1e6
    values = [("candidate", "model_size_mb", models.model_size_mb(spark, path)),
              ("candidate", "score_seconds_per_million_rows", seconds)]
    return spark.createDataFrame(values, "model string, metric string, value double")


def gate_model(
    training: Training, test: DataFrame, version: str, now: Column, champion=None, params: Params = Params(),
    operational: DataFrame | None = None, alert_path: str | None = None,
) -> DataFrame:
    """The gate's result row. The champion is scored again on the current test rows before comparing."""
    spark = test.sparkSession
    metrics = training.metrics
    if champion is not None:
        metrics = metrics.unionByName(evaluation.evaluate(stage(scored_with(champion, "champion", test)), ("model",), params))
    if operational is not None:
        metrics = metrics.unionByName(operational)
    checks = stage(gate.evaluate_gate(metrics, gate.gate_rules(spark, params)))
    result = stage(gate.result(checks, metrics, training.fairness, version))
    if alert_path is not None:
        rejected = result.where(~F.col("passed"))
        sinks.append_alerts(sinks.alert_rows(rejected, f"MODEL {version} REJECTED BY GATE", now), alert_path)
    return result


def store_reference(train_rows: DataFrame, reference_scored: DataFrame, path: str) -> None:
    """Value counts of the training features and of the reference scores, which monitoring compares with."""
    found = monitoring.reference_of(train_rows, reference_scored)
    found.profile.write.mode("errorifexists").parquet(f"{path}/profile")
    found.scores.write.mode("errorifexists").parquet(f"{path}/scores")


def read_reference(spark: SparkSession, path: str) -> monitoring.Reference:
    return monitoring.Reference(spark.read.parquet(f"{path}/profile"), spark.read.parquet(f"{path}/scores"))


def record(snap: DataFrame, history_path: str | None, alert_path: str | None) -> DataFrame:
    """A snapshot, appended to history with its alerts, if it has anything to say."""
    snap = stage(snap)
    enough = "data_drift" in snap.columns
    if enough and history_path is not None:
        sinks.append_snapshot(snap, history_path)
    if enough and alert_path is not None:
        sinks.append_alerts(monitoring.alerts(snap), alert_path)
    return snap


def monitor(
    train_rows: DataFrame | None, reference_scored: DataFrame | None, log: DataFrame, labels: DataFrame, now: Column,
    version: str | None = None, params: Params = Params(), reference: monitoring.Reference | None = None,
    history_path: str | None = None, alert_path: str | None = None,
) -> DataFrame:
    """One monitoring cycle over whole logs: the snapshot row, appended to history, with its alerts."""
    snap = monitoring.monitor(train_rows, reference_scored, log, labels, now, version, params, reference)
    return record(snap, history_path, alert_path)


#: Labels are looked for from so many days before the first prediction of the window on.
LABEL_LEAD_DAYS = 60


def monitor_daily(
    spark: SparkSession, log_path: str, label_path: str, reference: monitoring.Reference, now: Column, version: str | None = None,
    params: Params = Params(), history_path: str | None = None, alert_path: str | None = None,
) -> DataFrame:
    """One monitoring cycle over logs by day (``sources.daily``): reads the newest days that hold the window and their labels."""
    first = daily.first_day_of_last(spark, log_path, C.PREDICTION_LOG_SCHEMA, params.window_size)
    log = daily.read_daily(spark, log_path, C.PREDICTION_LOG_SCHEMA, first)
    labels = daily.read_around(spark, label_path, C.LABEL_LOG_SCHEMA, first, LABEL_LEAD_DAYS)
    snap = monitoring.monitor_recent(monitoring.recent(log, params.window_size), labels, now, reference, version, params)
    return record(snap, history_path, alert_path)


@dataclass
class RetrainDecision:
    retrained: bool
    reason: str | None
    version: dict | None = None
    training: Training | None = None
    gate: DataFrame | None = None


def retrain_model(
    snap: DataFrame, root: str, log: DataFrame, labels: DataFrame, now: Column, params: Params = Params(), force: bool = False,
    alert_path: str | None = None, patients: DataFrame | None = None, champion=None, report_dir: str | None = None,
) -> RetrainDecision:
    """Retrain when the snapshot asks for it (or ``force``) and enough labels have come in.

    The labelled log joins the newest version under ``root``, the result is published as the next one with that as its
    parent, models are fitted on what was published, and the best goes through the gate (against ``champion``, scored
    again on the new test rows). Without enough labels the run is postponed and an alert written. A run that is repeated
    finds its version published and goes on from there.
    """
    spark = snap.sparkSession
    row = snap.select("retrain_recommended", *(["reason"] if "reason" in snap.columns else [])).first()
    if not force and not row["retrain_recommended"]:
        return RetrainDecision(False, None)
    reason = "forced" if force else row["reason"]
    labelled = keep(monitoring.attach_labels(monitoring.flatten_predictions(log), labels), "labelled")
    if labelled.count() < params.min_labels:
        if alert_path is not None:
            waiting = spark.range(1).select(F.lit(reason).alias("reason"))
            sinks.append_alerts(sinks.alert_rows(waiting, "RETRAIN POSTPONED", now), alert_path)
        return RetrainDecision(False, "awaiting_labels")
    old = versions.read(spark, root)
    merged = retrain.build_dataset_version(old, labelled, params, patients=patients)
    version = versions.publish(merged.select(*[F.col(f"`{c}`") for c in old.columns]), root, params)
    parts = versions.splits(spark, root, version["data_version"])
    training = train(parts, params, report_dir)
    result = gate_model(training, parts["test"], version["data_version"], now, champion, params, alert_path=alert_path)
    return RetrainDecision(True, reason, version, training, result)
