"""Queries over the test tables: every operator, on whole tables, with comparable output columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow import contract as C
from riskflow.functions import (
    age_mid, charlson, hash_bucket, icd9_group, lace_flag, lace_risk, n_med_changes, n_meds_active,
    register_sql_functions, specialty_group, total_visits, with_lace,
)
from riskflow.operators import boosting, cohort, drift, evaluation, features, gate, models, monitoring, quality
from riskflow.operators import retrain, scoring, telemetry
from riskflow.operators.isotonic import isotonic_pools
from riskflow.operators.joins import sorted_side
from riskflow.operators.ranking import exact_quantiles, histogram, value_counts
from riskflow.params import Params
from riskflow.plans import jobs
from riskflow.session import keep, shared_dir, stage
from riskflow.sources import daily, datagen, derived, read_prediction_log, sinks, versions
from riskflow.streaming import streams
from riskflow.streaming.windows import latest_windows

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
PARAMS = Params()
SNAPSHOT_TIME = "2002-01-01 00:00:00"


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def r6(c: Column | str) -> Column:
    """Six decimals, with no negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


def _big(c: str) -> Column:
    return F.col(c).cast("bigint").alias(c)


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return cohort.with_split(cohort.make_target(derived.encounters(spark, d)), PARAMS)


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """(encounter, model, score, target) for the rule index and for near-unique scores."""
    return keep(evaluation.with_models(derived.scored_encounters(spark, d), {"lace": "lace", "blend": "blend"}), "scored")


def _period(df: DataFrame, current: bool) -> DataFrame:
    cut = F.lit(derived.PERIOD_CUT).cast("timestamp")
    return df.where(F.col("discharge_ts") >= cut if current else F.col("discharge_ts") < cut)


def _profiles(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Profiles of the two periods, from one scan of the encounters."""
    flag = (F.col("discharge_ts") >= F.lit(derived.PERIOD_CUT).cast("timestamp")).alias("current")
    rows = derived.encounters(spark, d).select("*", flag)
    both = stage(features.profile(features.clean(rows, keep=["current"]), by=("current",)))
    return both.where(~F.col("current")).drop("current"), both.where("current").drop("current")


# ---- cohort ------------------------------------------------------------------------------------

@query
def risk_by_split_and_diagnosis(spark, d):
    """The flagship: validated cohort, patient split, rule index and outcome per diagnosis group."""
    rows = with_lace(_labelled(spark, d)).withColumn("diagnosis", icd9_group("diag_1"))
    return rows.groupBy("split", "diagnosis").agg(
        F.count("*").alias("rows"), F.sum("target").alias("positives"),
        r6(F.avg("lace")).alias("mean_lace"),
    )


@query
def cohort_split_summary(spark, d):
    return cohort.split_summary(_labelled(spark, d))


@query
def cohort_target(spark, d):
    rows = cohort.make_target(derived.encounters(spark, d))
    return rows.select("encounter_id", "discharge_disposition_id", _big("target"))


@query
def patient_split(spark, d):
    rows = cohort.with_split(derived.encounters(spark, d), PARAMS)
    return rows.select("encounter_id", F.round(hash_bucket("patient_nbr", PARAMS.seed), 9).alias("bucket"), "split")


@query
def split_disjoint(spark, d):
    rows = _labelled(spark, d)
    shared = cohort.shared_patients(rows).agg(F.count("*").alias("n"))
    return rows.groupBy("split").agg(F.count_distinct("patient_nbr").alias("patients")).withColumn(
        "shared_patients", shared.scalar()
    )


def _lineage_rows(lineage: DataFrame, *keep: str) -> DataFrame:
    """One row for each split of each version."""
    rows = lineage.select(*keep, "data_version", F.inline("splits"))
    return rows.select(*keep, "data_version", "split", "rows", "pos_rate", "sha256")


@query
def data_version(spark, d):
    """Splits, their content hashes, the hash of the raw table and the version that follows from them."""
    lineage = cohort.lineage(_labelled(spark, d), PARAMS, raw=derived.encounters(spark, d))
    return _lineage_rows(lineage, "raw_sha256")


# ---- data quality ------------------------------------------------------------------------------

@query
def missing_rates(spark, d):
    return _rounded(quality.missing_rates(derived.faulty_encounters(spark, d)), "missing_rate")


@query
def label_rate(spark, d):
    return _rounded(quality.label_rate(derived.faulty_encounters(spark, d)), "label_rate")


@query
def violation_report(spark, d):
    report = quality.violation_report(derived.faulty_encounters(spark, d))
    return report.withColumn("examples", F.array_join("examples", "|"))


@query
def dq_report(spark, d):
    """The validation report and the alert as written before the error that stops a run; both read back."""
    run = _run_dir(spark)
    try:
        jobs.check_table(derived.faulty_encounters(spark, d), F.lit(SNAPSHOT_TIME).cast("timestamp"), PARAMS, report_path=f"{run}/report", alert_path=f"{run}/alerts")
        raise RuntimeError("a table with faults has passed")
    except quality.DataValidationError:
        report = spark.read.schema(quality.REPORT_SCHEMA).json(f"{run}/report")
    alerts = spark.read.json(f"{run}/alerts").agg(F.count("*").alias("n")).scalar()
    rows = report.select("n_rows", "n_issues", "passed", F.inline("issues"))
    return rows.select("n_rows", "n_issues", "passed", "type", "column", "check", "n_failures", r6("value").alias("value"), alerts.alias("alerts"))


@query
def duplicate_ids(spark, d):
    return quality.duplicate_values(derived.faulty_encounters(spark, d), "encounter_id")


@query
def dataset_checks(spark, d):
    return _rounded(quality.dataset_checks(derived.faulty_encounters(spark, d), PARAMS), "value")


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    lines = derived.request_lines(spark, d).withColumnRenamed("encounter_id", "source_id")
    return quality.parse_requests(lines)


@query
def quarantine(spark, d):
    reasons = F.transform("violations", lambda v: F.concat_ws(":", v["column"], v["check"], v["value"]))
    return quality.quarantined(_parsed(spark, d)).select(
        "source_id", _size("violations"), F.array_join(F.sort_array(reasons), "|").alias("reasons")
    )


def _size(c: str) -> Column:
    return F.size(c).cast("bigint").alias(f"n_{c}")


@query
def accepted_requests(spark, d):
    rows = quality.accepted(_parsed(spark, d))
    return rows.select(
        "encounter_id", "time_in_hospital", "num_medications", "age", "diag_1", "max_glu_serum", "metformin",
        "insulin", F.col("`glyburide-metformin`").alias("glyburide_metformin"),
    )


# ---- scalar functions --------------------------------------------------------------------------

@query
def icd9_groups(spark, d):
    rows = derived.faulty_encounters(spark, d)
    return rows.select("patient_nbr", "encounter_id", *[icd9_group(f"diag_{i}").alias(f"diag_{i}_grp") for i in (1, 2, 3)])


@query
def charlson_scores(spark, d):
    rows = derived.encounters(spark, d)
    return rows.select("encounter_id", charlson("diag_1", "diag_2", "diag_3").cast("bigint").alias("charlson"))


@query
def lace_scores(spark, d):
    return with_lace(derived.encounters(spark, d)).select("encounter_id", "lace")


@query
def lace_flags(spark, d):
    rows = with_lace(derived.encounters(spark, d))
    return rows.select("encounter_id", r6(lace_risk("lace")).alias("risk"), lace_flag("lace").cast("bigint").alias("flag"))


@query
def med_counts(spark, d):
    rows = derived.faulty_encounters(spark, d)
    return rows.select(
        "patient_nbr", n_med_changes().cast("bigint").alias("n_med_changes"),
        n_meds_active().cast("bigint").alias("n_meds_active"), total_visits().alias("total_visits"),
        age_mid().alias("age_num"),
    )


@query
def specialty_groups(spark, d):
    rows = derived.encounters(spark, d)
    return rows.groupBy(specialty_group().alias("specialty")).agg(F.count("*").alias("n"))


@query
def sql_functions(spark, d):
    """The SQL surface: the same functions called from SQL text."""
    register_sql_functions(spark)
    derived.encounters(spark, d).createOrReplaceTempView("riskflow_encounters")
    return spark.sql("""
        SELECT encounter_id, icd9_group(diag_1) AS diagnosis,
               lace_score(time_in_hospital, cast(admission_type_id AS int),
                          charlson_weight(diag_1) + charlson_weight(diag_2) + charlson_weight(diag_3),
                          number_emergency) AS lace
        FROM riskflow_encounters""")


# ---- features ----------------------------------------------------------------------------------

@query
def clean_features(spark, d):
    rows = derived.faulty_encounters(spark, d).withColumnsRenamed({"encounter_id": "id"})
    return features.clean(rows, keep=["id", "patient_nbr"])


def _train_profile(spark: SparkSession, d: str) -> DataFrame:
    return stage(features.profile(features.clean(derived.faulty_encounters(spark, d))))


def _fitted(df: DataFrame) -> dict:
    return {r["feature"]: tuple(r)[1:] for r in df.collect()}


@query
def impute_medians(spark, d):
    return _rounded(features.medians(_train_profile(spark, d)), "median")


def _filled(prof: DataFrame) -> DataFrame:
    return stage(features.imputed(prof, {f: r[0] for f, r in _fitted(features.medians(prof)).items()}))


@query
def clip_bounds(spark, d):
    return _rounded(features.clip_bounds(_filled(_train_profile(spark, d))), "low", "high")


@query
def scale_stats(spark, d):
    filled = _filled(_train_profile(spark, d))
    bounds = _fitted(features.clip_bounds(filled))
    stats = features.scale_stats(filled, {f: b[0] for f, b in bounds.items()}, {f: b[1] for f, b in bounds.items()})
    return _rounded(stats, "mean", "std")


@query
def onehot_vocab(spark, d):
    return features.vocabulary(_train_profile(spark, d))


def _fitted_on_train(spark: SparkSession, d: str) -> tuple[dict, DataFrame]:
    rows = stage(features.clean(_labelled(spark, d), keep=["encounter_id", "split"]))
    return features.fit_state(features.profile(rows.where(F.col("split") == "train"))), rows


@query
def scaled_features(spark, d):
    """Every encounter through the numbers fitted on the training split."""
    state, rows = _fitted_on_train(spark, d)
    return _rounded(features.scaled(rows, state, keep=["encounter_id"]), *C.NUM_COLS)


@query
def onehot_totals(spark, d):
    """How many test encounters each indicator column marks; unseen and rare values share one."""
    state, rows = _fitted_on_train(spark, d)
    flags = features.onehot_columns(state)
    sums = rows.where(F.col("split") == "test").agg(
        *[F.sum(flag).cast("bigint").alias(f"f{i}") for i, (_, flag) in enumerate(flags)]
    )
    names = F.create_map(*[x for i, (name, _) in enumerate(flags) for x in (F.lit(f"f{i}"), F.lit(name))])
    long = sums.unpivot([], [f"f{i}" for i in range(len(flags))], "f", "n")
    return long.select(F.element_at(names, F.col("f")).alias("indicator"), "n")


# ---- evaluation, fairness, gate ----------------------------------------------------------------

@query
def score_quantiles_exact(spark, d):
    q = exact_quantiles(_scored(spark, d), "score", [0.0, 0.25, 0.5, 0.9, 1.0], ("model",))
    return q.select("model", *[r6(F.col("q")[i]).alias(n) for i, n in enumerate(("q0", "q25", "q50", "q90", "q100"))])


@query
def decision_threshold(spark, d):
    return scoring.fit_threshold(derived.scored_encounters(spark, d).withColumnRenamed("blend", "score"), PARAMS.top_k_frac)


@query
def decisions(spark, d):
    """Batch decisions at the fitted threshold; the threshold enters as a scalar subquery."""
    rows = stage(derived.scored_encounters(spark, d).select("encounter_id", F.col("blend").alias("score")))
    limit = scoring.fit_threshold(rows, PARAMS.top_k_frac)
    return scoring.decide(rows, limit.scalar(), "v1")


@query
def score_histogram(spark, d):
    h = histogram(_scored(spark, d), "score", telemetry.SCORE_EDGES, ("model",))
    return h.select("model", _big("bin"), "n")


@query
def brier_score(spark, d):
    return _rounded(evaluation.brier(_scored(spark, d), ("model",)), "brier")


@query
def average_precision(spark, d):
    return _rounded(evaluation.average_precision(_scored(spark, d), ("model",)), "pr_auc")


@query
def roc_auc(spark, d):
    return _rounded(evaluation.roc_auc(_scored(spark, d), ("model",)), "roc_auc")


@query
def pr_curve(spark, d):
    curve = evaluation.pr_curve(stage(evaluation.score_counts(_scored(spark, d), ("model",))), ("model",))
    return curve.select("model", r6("value").alias("score"), "n", "pos", "cum_n", "cum_pos")


@query
def recall_at_k(spark, d):
    out = evaluation.recall_precision_at_k(_scored(spark, d), PARAMS.top_k_frac, ("model",))
    return _rounded(out, "recall_at_k", "precision_at_k")


@query
def group_recall(spark, d):
    return _rounded(evaluation.group_recall(_scored(spark, d), PARAMS.top_k_frac, ("model",), PARAMS), "recall")


@query
def fairness_gap(spark, d):
    groups = evaluation.group_recall(_scored(spark, d), PARAMS.top_k_frac, ("model",), PARAMS)
    return _rounded(evaluation.fairness_gap(groups, ("model",)), "gender", "race", "age60", "max")


@query
def model_comparison(spark, d):
    """All metrics of two models on the same rows."""
    return evaluation.evaluate(_scored(spark, d), ("model",), PARAMS)


@query
def best_experiment(spark, d):
    wide = evaluation.evaluate_wide(_scored(spark, d), ("model",), PARAMS)
    ranked = wide.withColumn("seq", F.when(F.col("model") == "lace", 0).otherwise(1))
    return evaluation.select_best(ranked).select("model", "pr_auc")


def _gate_metrics(spark: SparkSession, d: str) -> DataFrame:
    roles = F.when(F.col("model") == "lace", "baseline").otherwise("candidate")
    metrics = stage(evaluation.evaluate(_scored(spark, d), ("model",), PARAMS).withColumn("model", roles))
    champion = metrics.where(F.col("model") == "baseline").withColumn("model", F.lit("champion"))
    return metrics.unionAll(champion)


@query
def gate_checks(spark, d):
    checks = gate.evaluate_gate(_gate_metrics(spark, d), gate.gate_rules(spark, PARAMS))
    return _rounded(checks, "value", "limit")


@query
def gate_verdict(spark, d):
    checks = gate.evaluate_gate(_gate_metrics(spark, d), gate.gate_rules(spark, PARAMS))
    return gate.verdict(checks)


# ---- drift and monitoring ----------------------------------------------------------------------

@query
def psi_numeric(spark, d):
    ref, cur = _profiles(spark, d)
    psi = drift.psi_of_profiles(ref, cur).where(F.col("kind") == "numeric")
    return psi.select("feature", _big("bins"), r6("psi").alias("psi"))


@query
def psi_categorical(spark, d):
    ref, cur = _profiles(spark, d)
    psi = drift.psi_of_profiles(ref, cur).where(F.col("kind") == "categorical")
    return psi.select("feature", _big("bins"), r6("psi").alias("psi"))


@query
def feature_drift(spark, d):
    ref, cur = _profiles(spark, d)
    psi = drift.psi_of_profiles(ref, cur)
    return psi.select("feature", F.round("psi", 4).alias("psi"), drift.band(F.round("psi", 4)).alias("band"))


@query
def drift_summary(spark, d):
    ref, cur = _profiles(spark, d)
    psi = drift.psi_of_profiles(ref, cur).withColumn("psi", F.round("psi", 4))
    return _rounded(drift.summary(psi, PARAMS), "max_feature_psi", "drift_share")


@query
def shifted_cohort(spark, d):
    rows = datagen.shift_cohort(derived.encounters(spark, d), "data_drift", seed=7)
    return rows.select("encounter_id", "age", "num_medications", "number_inpatient", "admission_type_id", "time_in_hospital")


@query
def shifted_drift(spark, d):
    """The drift detectors on a cohort shifted on purpose."""
    rows = derived.encounters(spark, d)
    both = features.clean(rows).select(F.lit("ref").alias("side"), "*").unionByName(
        features.clean(datagen.shift_cohort(rows, "data_drift", seed=7)).select(F.lit("cur").alias("side"), "*")
    )
    prof = stage(features.profile(both, by=("side",)))
    psi = drift.psi_of_profiles(
        prof.where(F.col("side") == "ref").drop("side"), prof.where(F.col("side") == "cur").drop("side")
    ).withColumn("psi", F.round("psi", 4))
    return _rounded(drift.summary(psi, PARAMS), "max_feature_psi", "drift_share")


@query
def shifted_labels(spark, d):
    rows = datagen.shift_cohort(cohort.with_target(derived.encounters(spark, d)), "concept_drift", seed=7)
    return rows.select("encounter_id", _big("target"))


@query
def prediction_drift(spark, d):
    rows = stage(derived.scored_encounters(spark, d).select("discharge_ts", F.col("blend").alias("score")))
    out = monitoring.prediction_drift(_period(rows, False), _period(rows, True), PARAMS)
    return _rounded(out, "prediction_psi")


def _reference_scored(spark: SparkSession, d: str) -> DataFrame:
    rows = _period(derived.scored_encounters(spark, d), False)
    return stage(rows.select(F.col("blend").alias("score"), "target"))


def _live(spark: SparkSession, d: str) -> DataFrame:
    preds = stage(monitoring.flatten_predictions(derived.prediction_log(spark, d)).select(
        "request_id", "ts", "encounter_id", "score", "model_version"
    ))
    return monitoring.attach_labels(preds, derived.label_log(spark, d))


@query
def concept_drift(spark, d):
    out = monitoring.concept_drift(_reference_scored(spark, d), _live(spark, d), PARAMS)
    return _rounded(out.drop("label_shift"), *[c for c in out.columns if c.startswith(("ref_", "live_"))])


@query
def label_shift(spark, d):
    out = monitoring.concept_drift(_reference_scored(spark, d), _live(spark, d), PARAMS)
    return _rounded(out.select("ref_pos_rate", "live_pos_rate", "label_shift"), "ref_pos_rate", "live_pos_rate")


def _snapshot(spark: SparkSession, d: str) -> DataFrame:
    train = _period(derived.encounters(spark, d), False)
    return monitoring.monitor(
        train, _reference_scored(spark, d), derived.prediction_log(spark, d), derived.label_log(spark, d),
        F.lit(SNAPSHOT_TIME).cast("timestamp"), "v2", PARAMS,
    )


@query
def monitor_snapshot(spark, d):
    return monitoring.gauges(_snapshot(spark, d)).select("metric", r6("value").alias("value"))


@query
def monitor_decision(spark, d):
    snap = _snapshot(spark, d)
    return snap.select(
        "status", "n_production", "data_drift", "prediction_drift", "concept_drift", "label_shift",
        "retrain_recommended", "reason", F.size("drifted_features").cast("bigint").alias("n_drifted"),
    )


@query
def flag_alerts(spark, d):
    rows = telemetry.flag_alerts(monitoring.gauges(_snapshot(spark, d)))
    return rows.select("metric", "value")


@query
def latest_labels(spark, d):
    rows = monitoring.latest_labels(derived.label_log(spark, d))
    return rows.select("encounter_id", F.unix_seconds("ts").alias("ts"), "readmitted_30d")


@query
def recent_predictions(spark, d):
    rows = monitoring.flatten_predictions(monitoring.recent(derived.prediction_log(spark, d), PARAMS.window_size))
    return rows.select("request_id", "encounter_id", F.unix_seconds("ts").alias("ts"), r6("score").alias("score"), "model_version")


@query
def label_join(spark, d):
    rows = _live(spark, d)
    return rows.select("request_id", "encounter_id", r6("score").alias("score"), "model_version", "readmitted_30d")


# ---- retraining --------------------------------------------------------------------------------

def _old_splits(spark: SparkSession, d: str) -> DataFrame:
    cut = F.lit(derived.RETRAIN_CUT).cast("timestamp")
    return _labelled(spark, d).where(F.col("discharge_ts") < cut).drop("discharge_ts")


def _new_labelled(spark: SparkSession, d: str) -> DataFrame:
    log = derived.prediction_log(spark, d)
    return monitoring.attach_labels(monitoring.flatten_predictions(log), derived.label_log(spark, d))


def _patients(spark: SparkSession, d: str) -> DataFrame:
    return derived.encounters(spark, d).select("encounter_id", "patient_nbr")


def _merged(spark: SparkSession, d: str, check: bool = False) -> DataFrame:
    return retrain.build_dataset_version(_old_splits(spark, d), _new_labelled(spark, d), PARAMS, check, _patients(spark, d))


@query
def raw_form(spark, d):
    rows = retrain.to_raw_form(retrain.last_per_encounter(retrain.labeled_rows(_new_labelled(spark, d))))
    return rows.select("encounter_id", "patient_nbr", "readmitted", "age", "time_in_hospital")


@query
def retrain_dataset(spark, d):
    merged = _merged(spark, d, check=True)
    return merged.select("split", "encounter_id", "patient_nbr", _big("target"), "age", "time_in_hospital", "insulin")


@query
def retrain_summary(spark, d):
    return cohort.split_summary(_merged(spark, d))


@query
def retrain_disjoint(spark, d):
    """No patient of the encounter table is in two splits, whatever the requests say about patients."""
    return retrain.shared_between_splits(_merged(spark, d))


@query
def retrain_lineage(spark, d):
    """Two published versions, the second from the first and the labelled log; publishing it twice changes nothing."""
    root = _run_dir(spark)
    versions.publish(_old_splits(spark, d), root, PARAMS)
    for _ in range(2):
        old = versions.read(spark, root)
        merged = retrain.build_dataset_version(old, _new_labelled(spark, d), PARAMS, patients=_patients(spark, d))
        versions.publish(merged.select(old.columns), root, PARAMS)
    return _lineage_rows(versions.history(spark, root), "number", "parent_data_version")


# ---- telemetry ---------------------------------------------------------------------------------

@query
def request_rate(spark, d):
    return _rounded(telemetry.request_rate(derived.request_log(spark, d), "endpoint"), "per_second")


@query
def status_rate(spark, d):
    out = telemetry.request_rate(derived.request_log(spark, d), "status")
    return _rounded(out.withColumn("status", F.col("status").cast("bigint")), "per_second")


@query
def latency_quantiles(spark, d):
    return _rounded(telemetry.latency_quantiles(derived.request_log(spark, d), 300, 60), "p50", "p95")


@query
def error_rate(spark, d):
    return _rounded(telemetry.error_rate(derived.request_log(spark, d), 300, 60), "error_rate")


@query
def invalid_rate(spark, d):
    return _rounded(telemetry.invalid_rate(derived.request_log(spark, d), 300, 60), "invalid_rate")


@query
def score_quantiles(spark, d):
    return _rounded(telemetry.score_quantiles(derived.request_log(spark, d)), "p50", "p90")


@query
def follow_up_rate(spark, d):
    return _rounded(telemetry.follow_up_rate(derived.request_log(spark, d)), "follow_up_rate")


@query
def model_in_use(spark, d):
    return telemetry.model_in_use(derived.request_log(spark, d))


@query
def label_counts(spark, d):
    out = telemetry.label_counts(derived.label_log(spark, d))
    return out.select(_big("label"), "w_start", "n")


@query
def sustained_alerts(spark, d):
    return telemetry.sustained_alerts(derived.request_log(spark, d))


@query
def slo_report(spark, d):
    return telemetry.slo_report(derived.request_log(spark, d), PARAMS)


# ---- models ------------------------------------------------------------------------------------

def _parts(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    rows = stage(_labelled(spark, d))
    return {s: rows.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")}


_TRAININGS: dict[tuple[str, str], tuple[dict[str, DataFrame], jobs.Training]] = {}


def _trained(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], jobs.Training]:
    """One training run for each session and source, which the queries on models share."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _TRAININGS:
        parts = _parts(spark, d)
        _TRAININGS[key] = (parts, jobs.train(parts, PARAMS))
    return _TRAININGS[key]


@query
def experiments(spark, d):
    """Rule baseline and the four default experiments on the validation split."""
    return _trained(spark, d)[1].comparison.drop("seq")


@query
def batch_scores(spark, d):
    """Score every test encounter with the best of the default experiments, decide at the validation threshold."""
    parts, training = _trained(spark, d)
    return scoring.decide(scoring.score(parts["test"], training.model), F.lit(training.threshold), "v1")


@query
def scored_rows(spark, d):
    """Of every experiment: how many test encounters it scores, how many of them twice, and scores outside 0 to 1."""
    parts, training = _trained(spark, d)
    scored = [jobs.scored_with(model, name, parts["test"]) for name, model in training.models.items()]
    rows = reduce(DataFrame.unionByName, scored)
    return rows.groupBy("model").agg(
        F.count("*").alias("n"), F.count_distinct("encounter_id").alias("encounters"),
        F.count_if(~F.col("score").between(0, 1)).alias("outside"), F.sum(F.col("target").cast("bigint")).alias("positives"),
    )


def _prepared(spark: SparkSession, d: str) -> models.Prepared:
    return models.fit_features(_parts(spark, d)["train"])


@query
def logistic_optimum(spark, d):
    """Derivatives of the penalised loss at the fitted coefficients: zero for every feature at the optimum."""
    options = {"C": 1.0, "balanced": True, "max_iter": 2000, "tol": 1e-10}
    prepared = _prepared(spark, d)
    model = models.fit_logistic(prepared.vectors, options)
    gradient = models.logistic_gradient(model, prepared.vectors, options)
    rows = list(zip(prepared.features.feature_names(), gradient.tolist()))
    return _rounded(spark.createDataFrame(rows, "feature string, gradient double"), "gradient").withColumn("gradient", F.round("gradient", 3) + 0.0)


@query
def first_split_gains(spark, d):
    """The best gain of each feature at the root of the first tree of the default boosted model."""
    prepared = _prepared(spark, d)
    gains = boosting.root_gains(prepared.coded, prepared.codes, boosting.Boosting(step=0.1, rounds=1, leaves=31), True, PARAMS.seed)
    rows = spark.createDataFrame(gains, "feature string, n_codes bigint, gain double")
    return rows.withColumn("gain", F.round("gain", 4) + 0.0)


@query
def isotonic_rates(spark, d):
    """Calibration pools of the rule index and of a score with 200 levels."""
    levels = F.when(F.col("model") == "lace", F.col("score")).otherwise(F.floor(F.col("score") * 200) / 200)
    rows = _scored(spark, d).withColumns({"score": levels, "by": F.when(F.col("model") == "lace", 0).otherwise(1)})
    pools = isotonic_pools(value_counts(rows, "score", ("by",), pos=F.col("target").cast("bigint")))
    return pools.select(F.col("by").cast("bigint").alias("curve"), r6("low").alias("low"), r6("high").alias("high"), "n", "pos", r6(F.col("pos") / F.col("n")).alias("rate"))


# ---- streams -----------------------------------------------------------------------------------

def _run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/riskflow-stream-{uuid.uuid4().hex}"


@query
def stream_label_join(spark, d):
    """The logs written as JSON, joined as two streams, then reduced to the last label."""
    run = _run_dir(spark)
    sinks.append_log(derived.prediction_log(spark, d), f"{run}/predictions")
    sinks.append_log(derived.label_log(spark, d), f"{run}/labels")
    joined = streams.join_labels(
        streams.stream_predictions(spark, f"{run}/predictions"), streams.stream_labels(spark, f"{run}/labels")
    )
    writer = joined.writeStream.format("parquet").option("path", f"{run}/joined")
    writer.option("checkpointLocation", f"{run}/check").trigger(availableNow=True).start().awaitTermination()
    rows = streams.last_label(spark.read.parquet(f"{run}/joined"))
    return rows.select("request_id", "encounter_id", r6("score").alias("score"), "model_version", "readmitted_30d")


@query
def stream_unlabelled(spark, d):
    """Predictions whose 60 days passed without an outcome: nobody sends one for encounters that ended in death or hospice."""
    run = _run_dir(spark)
    log = derived.prediction_log(spark, d)
    closed = log.where(F.col("features.discharge_disposition_id").cast("int").isin(*PARAMS.exclude_discharge_ids))
    known = derived.label_log(spark, d).join(sorted_side(closed.select("features.encounter_id").distinct()), "encounter_id", "left_anti")
    sinks.append_log(log, f"{run}/predictions")
    sinks.append_log(known, f"{run}/labels")
    joined = streams.join_labels(
        streams.stream_predictions(spark, f"{run}/predictions"), streams.stream_labels(spark, f"{run}/labels"), "left_outer"
    )
    writer = streams.unlabelled(joined).writeStream.format("parquet").option("path", f"{run}/unlabelled")
    writer.option("checkpointLocation", f"{run}/check").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{run}/unlabelled").select("request_id", "encounter_id", r6("score").alias("score"), "model_version")


@query
def monitor_stream(spark, d):
    """Logs by month and a stored reference; a stream of arriving predictions triggers the snapshot, read back from history."""
    run = _run_dir(spark)
    daily.append_daily(derived.prediction_log(spark, d), f"{run}/predictions", "month")
    daily.append_daily(derived.label_log(spark, d), f"{run}/labels", "month")
    jobs.store_reference(_period(derived.encounters(spark, d), False), _reference_scored(spark, d), f"{run}/reference")

    def cycle(session: SparkSession) -> DataFrame:
        reference = jobs.read_reference(session, f"{run}/reference")
        return jobs.monitor_daily(session, f"{run}/predictions", f"{run}/labels", reference, F.lit(SNAPSHOT_TIME).cast("timestamp"), "v2", PARAMS)

    arriving = streams.stream_predictions(spark, f"{run}/predictions")
    streams.monitor_stream(arriving, cycle, f"{run}/history", f"{run}/check").awaitTermination()
    return monitoring.gauges(spark.read.parquet(f"{run}/history")).select("metric", r6("value").alias("value"))


@query
def stream_quarantine(spark, d):
    """Requests as a text stream, routed to accepted and quarantined tables."""
    run = _run_dir(spark)
    sinks.write_request_lines(derived.request_lines(spark, d), f"{run}/requests")
    streams.validate_stream(
        streams.stream_requests(spark, f"{run}/requests"), f"{run}/accepted", f"{run}/rejected", f"{run}/check"
    ).awaitTermination()
    reasons = F.explode(F.transform("violations", lambda v: F.concat_ws(":", v["column"], v["check"], v["value"])))
    rejected = spark.read.parquet(f"{run}/rejected").select(reasons.alias("reason")).groupBy("reason").count()
    accepted = spark.read.parquet(f"{run}/accepted").agg(F.count("*").alias("count"))
    return rejected.unionByName(accepted.withColumn("reason", F.lit("accepted"))).withColumnRenamed("count", "n")


@query
def stream_scores(spark, d):
    """Requests checked, scored by the rule index and logged by one stream; the log read back."""
    run = _run_dir(spark)
    sinks.write_request_lines(derived.request_lines(spark, d), f"{run}/requests")
    streams.score_stream(
        streams.stream_requests(spark, f"{run}/requests"), models.LaceModel(), 10 / 19, "lace", f"{run}/log",
        f"{run}/check", now=F.lit(SNAPSHOT_TIME).cast("timestamp"),
    ).awaitTermination()
    rows = monitoring.flatten_predictions(read_prediction_log(spark, f"{run}/log"))
    return rows.select("encounter_id", r6("score").alias("score"), "model_version")


@query
def stream_telemetry(spark, d):
    """Sliding windows over the request log as a stream, in update mode."""
    run = _run_dir(spark)
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    windows = streams.telemetry(derived.request_log_of(events))
    streams.telemetry_sink(windows, f"{run}/windows", f"{run}/check").awaitTermination()
    return _rounded(latest_windows(spark, f"{run}/windows"), "p50", "p95")
