"""Functions, feature fitting, models, jobs and streams."""

import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskflow import contract as C
from riskflow.functions import charlson, icd9_group, lace_score, register_sql_functions, with_lace
from riskflow.operators import cohort, drift, evaluation, features, gate, models, monitoring, quality, scoring
from riskflow.operators import telemetry
from riskflow.params import DEFAULT_EXPERIMENTS, Experiment, Params
from riskflow.plans import catalog, jobs
from riskflow.session import stage
from riskflow.sources import datagen, read_label_log, read_prediction_log, versions
from riskflow.sources.sinks import append_log
from riskflow.streaming import streams

LOGREG = Experiment("logreg", "logreg", {"C": 1.0, "balanced": True, "max_iter": 50})
CALIBRATED = Experiment("calibrated", "gbt", {"step": 0.1, "max_iter": 20, "leaves": 8, "calibrate": True})


def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")



@pytest.mark.parametrize("code,group", [
    ("428", "circulatory"), ("250.83", "diabetes"), ("V57", "other"), ("E9", "other"), ("?", "missing"),
    (None, "missing"), ("", "missing"), ("459.81", "other"), ("459", "circulatory"), ("785.4", "other"),
    ("785", "circulatory"), ("v57", "other"), ("4d", "other"), ("nan", "other"), ("inf", "other"),
    ("786", "respiratory"), ("787", "digestive"), ("788", "genitourinary"), ("999", "injury"), ("999.5", "other"),
    ("739", "musculoskeletal"), ("140", "neoplasms"), (" 486 ", "respiratory"),
])
def test_icd9_group(spark, code, group):
    df = spark.createDataFrame([(code,)], "c string")
    register_sql_functions(spark)
    assert df.select(icd9_group("c")).first()[0] == group
    assert df.selectExpr("icd9_group(c)").first()[0] == group


def test_lace(spark, cohort_table):
    low, high = cohort_table.select(lace_score().alias("l")).agg(F.min("l"), F.max("l")).first()
    assert 0 <= low and high <= 19
    df = spark.createDataFrame([
        (None, 1, "428", "428", "?", 9), (1, 2, "196", "V1", "250.4", 1), (13, 1, "42", None, "x", None),
    ], "time_in_hospital int, admission_type_id int, diag_1 string, diag_2 string, diag_3 string, number_emergency int")
    assert [r[0] for r in df.select(charlson("diag_1", "diag_2", "diag_3")).collect()] == [2, 8, 6]
    assert [r["lace"] for r in with_lace(df).collect()] == [7 + 3 + 2 + 4, 1 + 0 + 5 + 1, None]
    assert [r[0] for r in df.select(lace_score()).collect()] == [16, 7, None]


def test_clean_columns_and_values(cohort_table):
    out = features.clean(cohort_table)
    assert out.columns == C.NUM_COLS + C.CAT_COLS
    assert out.where(" OR ".join(f"`{c}` = '?'" for c in C.CAT_COLS)).count() == 0
    assert out.where(~F.col("age_num").between(5, 95)).count() == 0


def test_clean_tolerates_missing_fields(spark):
    out = features.clean(spark.createDataFrame([("[70-80)", 3)], "age string, time_in_hospital int")).first()
    assert out["age_num"] == 75 and out["time_in_hospital"] == 3 and out["total_visits"] == 0
    assert out["medical_specialty"] == "Other" and out["diag_1_grp"] == "missing" and out["race"] is None


def test_fitted_numbers_equal_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 60, 500).astype(float)
    x[:50] = np.nan
    rows = [(None if np.isnan(v) else int(v), "a" if i % 50 else "rare") for i, v in enumerate(x)]
    df = features.clean(spark.createDataFrame(rows, "num_medications int, race string"))
    state = features.fit_state(features.profile(df))
    med = np.nanmedian(x)
    filled = np.where(np.isnan(x), med, x)
    lo, hi = np.quantile(filled, 0.005), np.quantile(filled, 0.995)
    clipped = np.clip(filled, lo, hi)
    got = [state[k]["num_medications"] for k in ("median", "low", "high", "mean", "std")]
    assert got == pytest.approx([med, lo, hi, clipped.mean(), clipped.std()])
    assert state["categories"]["race"] == ["a"] and state["infrequent"]["race"]
    assert not state["infrequent"]["gender"] and state["categories"]["gender"] == ["missing"]


def test_joined_vocabularies_equal_columns(spark, cohort_table, monkeypatch):
    """Values outside the vocabulary and nulls included; other columns and repeated rows pass through."""
    rows = features.clean(cohort_table.where("encounter_id % 16 = 0"), keep=["encounter_id"])
    rows = rows.union(rows.where("encounter_id % 128 = 0")).withColumn("diag_1_grp", F.when(F.col("encounter_id") % 7 == 0, F.lit("unseen")).otherwise(F.col("diag_1_grp")))
    state = features.fit_state(features.profile(features.clean(cohort_table)), min_frequency=500)
    assert any(state["infrequent"].values()) and not all(state["infrequent"].values())
    model = features.FeatureModel(state=json.dumps(state))
    read = lambda: sorted((r["encounter_id"], r["features"].toArray().tolist()) for r in model.transform(rows).collect())
    want = read()
    monkeypatch.setattr(features, "JOINED_CATEGORIES", 0)
    assert read() == want and len(want) == rows.count() > 300 and len(want[0][1]) == len(model.feature_names())


def test_a_hundred_thousand_categories_train_and_score(spark):
    n = 100_000
    rows = spark.range(2 * n).select(
        F.col("id").alias("encounter_id"), (F.col("id") % 2).cast("int").alias(C.TARGET),
        *[F.lit(1.0).alias(c) for c in C.NUM_COLS], *[F.lit("a").alias(c) for c in C.CAT_COLS if c != "race"],
        F.format_string("c%06d", F.col("id") % n).alias("race"),
    )
    rows = stage(rows.select("encounter_id", C.TARGET, *C.NUM_COLS, *C.CAT_COLS))
    state = features.fit_state(features.profile(rows), min_frequency=2)
    model = features.FeatureModel(state=json.dumps(state))
    names, vectors = model.feature_names(), stage(model.transform(rows))
    place = names.index("race=c000000")
    assert len(names) == len(C.NUM_COLS) + len(C.CAT_COLS) - 1 + n and names[place + n - 1] == f"race=c{n - 1:06d}"
    at = {r["encounter_id"]: r["features"] for r in vectors.where("encounter_id IN (0, 77777, 177777)").collect()}
    assert all(v.size == len(names) and v[place + k % n] == 1.0 and v.numNonzeros() == len(C.CAT_COLS) for k, v in at.items())
    fitted = models.fit_logistic(vectors, {"max_iter": 3})
    scored = models.ScoreColumn().transform(fitted.transform(vectors))
    # Odd ids are positive and so are odd categories.
    by = {r["t"]: r["s"] for r in scored.groupBy(F.col(C.TARGET).alias("t")).agg(F.avg("score").alias("s")).collect()}
    assert fitted.numFeatures == len(names) and by[1] > by[0]


@pytest.fixture(scope="module")
def splits(cohort_table):
    table = stage(cohort.with_split(cohort.make_target(cohort_table)))
    return {s: table.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")}


@pytest.fixture(scope="module")
def training(splits):
    return jobs.train(splits, Params(experiments=(LOGREG, CALIBRATED)))


def test_catalogue_runs_the_default_experiments(spark, sf_dir, monkeypatch):
    class Asked(Exception):
        pass

    def train(splits, params=Params()):
        raise Asked(params.experiments)

    monkeypatch.setattr(jobs, "train", train)
    for query in (catalog.experiments, catalog.batch_scores):
        with pytest.raises(Asked) as asked:
            query(spark, sf_dir)
        assert asked.value.args == (DEFAULT_EXPERIMENTS,)


def test_models_beat_the_rule(training):
    pr = {r["model"]: r["pr_auc"] for r in training.comparison.collect()}
    assert pr["logreg"] > pr["baseline_lace"] and training.best in ("logreg", "calibrated")
    brier = {r["model"]: r["brier"] for r in training.comparison.collect()}
    assert brier["calibrated"] < brier["logreg"]


def test_unknown_model_kind():
    with pytest.raises(ValueError):
        models.fit(Experiment("other", "svm"), None)


def test_no_train_serve_skew_and_saved_model(spark, training, splits, tmp_path):
    model = training.models["logreg"]
    rows = splits["test"].limit(50)
    rows = stage(rows)
    direct = {r["encounter_id"]: r["score"] for r in scoring.score(rows, model).collect()}
    fields = [F.col(f"`{r.name}`") for r in C.REQUEST_RULES]
    lines = rows.select(F.to_json(F.struct(*fields)).alias("line"))
    served = quality.accepted(quality.parse_requests(lines))
    via_json = {r["encounter_id"]: r["score"] for r in scoring.score(served, model).collect()}
    path = str(tmp_path / "model")
    model.write().save(path)
    loaded = {r["encounter_id"]: r["score"] for r in scoring.score(rows, PipelineModel.load(path)).collect()}
    assert direct.keys() == via_json.keys()
    for k, v in direct.items():
        assert via_json[k] == pytest.approx(v, rel=1e-9) and loaded[k] == pytest.approx(v, rel=1e-12)
    assert 0 < models.model_size_mb(spark, path) < 50


def test_gate(spark, training, splits, tmp_path):
    alerts = str(tmp_path / "alerts")
    ops = jobs.operational_metrics(spark, training.model, splits["test"], str(tmp_path / "m"))
    result = jobs.gate_model(training, splits["test"], "v1", now(), champion=training.model,
                             # 900 rows: the time is all start-up, so its limit is not under test here.
                             params=Params(min_pr_auc=0.01, min_gain_over_baseline=-1, max_fairness_gap=1.0,
                                           max_score_seconds_per_million_rows=1e6),
                             operational=ops, alert_path=alerts).first()
    checks = {c["check"]: c["passed"] for c in result["checks"]}
    assert result["status"] == "approved" and len(checks) == 7 and all(checks.values())
    strict = jobs.gate_model(training, splits["test"], "v2", now(), params=Params(min_pr_auc=0.99), alert_path=alerts).first()
    assert strict["status"] == "rejected" and "not_worse_than_champion" not in {c["check"] for c in strict["checks"]}
    assert spark.read.json(alerts).select("title").first()[0] == "MODEL v2 REJECTED BY GATE"


def test_gate_fails_without_a_required_metric(spark):
    metrics = spark.createDataFrame([("candidate", "pr_auc", 0.9)], "model string, metric string, value double")
    checks = {r["check"]: r["passed"] for r in gate.evaluate_gate(metrics, gate.gate_rules(spark)).collect()}
    assert checks["pr_auc_min"] and not checks["brier_max"] and not checks["beats_baseline"]


def production(spark, rows, model, tmp_path, name):
    """Logs of a cohort scored by a model, with labels 30 days later."""
    log, labels = str(tmp_path / f"{name}-pred"), str(tmp_path / f"{name}-labels")
    scoring.score_and_log(rows, model, 0.5, "v1", now(), log)
    append_log(rows.select((now() + F.expr("interval 30 days")).alias("ts"), "encounter_id",
                           (F.col(C.TARGET) == 1).alias("readmitted_30d")), labels)
    return read_prediction_log(spark, log), read_label_log(spark, labels)


def test_monitoring_and_retraining(spark, training, splits, tmp_path):
    model = training.models["logreg"]
    train_rows = splits["train"]
    reference = stage(scoring.score(splits["test"], model, keep=("encounter_id", C.TARGET)))
    history, alerts = str(tmp_path / "history"), str(tmp_path / "alerts")
    jobs.store_reference(train_rows, reference, str(tmp_path / "reference"))
    counts = jobs.read_reference(spark, str(tmp_path / "reference"))

    def run(name):
        rows = stage(datagen.shift_cohort(datagen.resample(splits["test"], 1.5, 7), name, 7))
        log, labels = production(spark, rows, model, tmp_path, name)
        snap = jobs.monitor(None, None, log, labels, now(), "v1", history_path=history, alert_path=alerts, reference=counts)
        return log, labels, snap

    snaps = {}
    for name in ("normal", "data_drift", "concept_drift"):
        log, labels, snap = run(name)
        snaps[name] = snap.first()
    assert not snaps["normal"]["retrain_recommended"]
    assert snaps["data_drift"]["data_drift"] and "age_num" in snaps["data_drift"]["drifted_features"]
    assert snaps["concept_drift"]["concept_drift"] and not snaps["concept_drift"]["data_drift"]
    assert snaps["concept_drift"]["reason"] == "concept_drift"
    stored = spark.read.parquet(history)
    assert stored.count() == 3 and "feature_psi" not in stored.columns
    assert telemetry.gauge_history(stored).count() == 36
    titles = {r["title"] for r in spark.read.json(alerts).collect()}
    assert {"DATA DRIFT DETECTED", "CONCEPT DRIFT DETECTED"} <= titles

    table = None
    for name, part in splits.items():
        one = part.withColumn("split", F.lit(name))
        table = one if table is None else table.unionByName(one)
    root = str(tmp_path / "versions")
    first = versions.publish(table, root)
    few = Params(experiments=(LOGREG,), min_labels=10**9)
    waiting = jobs.retrain_model(snap, root, log, labels, now(), few, alert_path=alerts)
    assert (waiting.retrained, waiting.reason) == (False, "awaiting_labels")
    one = Params(experiments=(LOGREG,))
    done = jobs.retrain_model(snap, root, log, labels, now(), one, alert_path=alerts, champion=model, report_dir=str(tmp_path / "reports"))
    assert done.retrained and done.reason == "concept_drift"
    assert done.version["parent_data_version"] == first["data_version"] and done.version["number"] == 2
    assert versions.read(spark, root).count() == table.count() + log.count()
    gate_row = done.gate.first()
    assert gate_row["status"] in ("approved", "rejected") and "not_worse_than_champion" in {c["check"] for c in gate_row["checks"]}
    assert versions.history(spark, root).count() == 2
    written = spark.read.option("header", True).csv(str(tmp_path / "reports" / "experiments"))
    assert [r["model"] for r in written.collect()] == ["baseline_lace", "logreg"]
    assert {r["best"] for r in spark.read.json(str(tmp_path / "reports" / "train_summary")).collect()} == {"logreg"}
    calm = spark.range(1).select(F.lit(False).alias("retrain_recommended"))
    assert not jobs.retrain_model(calm, root, log, labels, now()).retrained


def test_too_few_predictions(spark, training, splits, tmp_path):
    log, labels = production(spark, splits["test"].limit(20), training.models["logreg"], tmp_path, "few")
    reference = scoring.score(splits["test"], training.models["logreg"], keep=("encounter_id", C.TARGET))
    snap = jobs.monitor(splits["train"], reference, log, labels, now()).first()
    assert snap["status"] == "insufficient_data" and not snap["retrain_recommended"]


def test_drift_bands(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.19,), (0.2,)], "p double")
    assert [r[0] for r in df.select(drift.band(F.col("p"))).collect()] == ["stable", "moderate", "moderate", "major"]


def test_latest_label_wins(spark):
    rows = [("2024-01-01", 1, True), ("2024-01-02", 1, False), ("2024-01-01", 2, False), ("2024-01-01", 2, True)]
    df = spark.createDataFrame(rows, "t string, encounter_id bigint, readmitted_30d boolean").withColumn("ts", F.col("t").cast("timestamp"))
    got = {r["encounter_id"]: r["readmitted_30d"] for r in monitoring.latest_labels(df).collect()}
    assert got == {1: False, 2: True}


def test_select_best_first_wins_a_tie(spark):
    df = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 0.5), ("c", 2, 0.4)], "model string, seq int, pr_auc double")
    assert evaluation.select_best(df).first()["model"] == "a"


def test_score_stream_equals_batch(spark, training, splits, tmp_path):
    model = training.models["logreg"]
    rows = stage(splits["test"].limit(80))
    fields = [F.col(f"`{r.name}`") for r in C.REQUEST_RULES]
    requests = str(tmp_path / "requests")
    rows.select(F.to_json(F.struct(*fields)).alias("line")).write.text(requests)
    (tmp_path / "requests" / "bad.txt").write_text(json.dumps({"encounter_id": 1}) + "\n")
    log = str(tmp_path / "log")
    streams.score_stream(streams.stream_requests(spark, requests), model, 0.5, "v1", log, str(tmp_path / "c1")).awaitTermination()
    streamed = {r["encounter_id"]: r["score"] for r in monitoring.flatten_predictions(read_prediction_log(spark, log)).collect()}
    batch = {r["encounter_id"]: r["score"] for r in scoring.score(rows, model).collect()}
    assert streamed.keys() == batch.keys() and all(streamed[k] == pytest.approx(batch[k]) for k in batch)

    labels = str(tmp_path / "labels")
    append_log(rows.select(F.current_timestamp().alias("ts"), "encounter_id", F.lit(True).alias("readmitted_30d")), labels)
    kept = str(tmp_path / "kept")
    streams.label_intake(streams.stream_labels(spark, labels), kept, str(tmp_path / "c2")).awaitTermination()
    assert read_label_log(spark, kept).count() == 80

    history = str(tmp_path / "history")
    def snapshot(s):
        return s.range(1).select(F.lit(1).alias("x"), F.lit("a").alias("feature_psi"))
    streams.monitor_stream(streams.stream_predictions(spark, log), snapshot, history, str(tmp_path / "c3")).awaitTermination()
    assert spark.read.parquet(history).columns == ["x", "batch_id"]


def test_sustained_needs_consecutive_windows(spark):
    starts = [0, 60, 120, 240, 300, 600]
    df = spark.createDataFrame([(s, True) for s in starts] + [(180, False)], "w_start bigint, hot boolean")
    out = telemetry.sustained(df, F.col("hot"), 60, 120)
    assert [(r["start"], r["end"], r["duration"]) for r in out.collect()] == [(0, 120, 120)]


def test_silences_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    times = np.unique(np.concatenate([rng.integers(0, 4 * 86400, 300), rng.integers(10 * 86400, 10 * 86400 + 2000, 300), [86399, 86400, 5 * 86400 - 1]]))
    log = spark.createDataFrame([(int(t),) for t in rng.permutation(times)] + [(None,), (86400,)], "sec bigint").select(F.timestamp_seconds("sec").alias("ts"))

    def brute(t, seconds):
        return sorted((a, b, b - a, a + seconds) for a, b in zip(t, t[1:]) if b - a >= seconds)

    def read(*args, **edges):
        return sorted(map(tuple, telemetry.silences(*args, **{k: F.timestamp_seconds(F.lit(v)) for k, v in edges.items()}).collect()))

    for seconds in (1, 30, 61, 7000):
        assert read(log, seconds) == brute(times.tolist(), seconds)
    inside = [1000, *[int(t) for t in times if 1000 < t < 900_000], 900_000]
    assert read(log, 30, since=1000, until=900_000) == brute(inside, 30)
    none = log.where("false")
    assert read(none, 30) == [] and read(none, 30, since=5, until=95) == [(5, 95, 90, 35)]


def test_histogram_quantile_edges(spark):
    df = spark.createDataFrame([(0, 4.0), (1, 9.0)], "sec bigint, v double").withColumn("ts", F.timestamp_seconds("sec"))
    r = telemetry.histogram_quantile(df, "v", [1.0, 5.0], {"p25": 0.25, "p50": 0.5, "p99": 0.99}, 60).first()
    assert (r["p25"], r["p50"], r["p99"]) == (3.0, 5.0, 5.0)


def test_resample_and_unknown_scenario(cohort_table):
    a = datagen.resample(cohort_table, 0.5, 1)
    assert a.count() == datagen.resample(cohort_table.repartition(3), 0.5, 1).count()
    assert a.select("encounter_id").distinct().count() == a.count()
    with pytest.raises(ValueError):
        datagen.shift_cohort(cohort_table, "other")
