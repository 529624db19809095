"""Ranking primitives against NumPy, on the ordinary and on the bucketed path."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.operators import drift, evaluation, ranking
from riskflow.operators.joins import join_unique
from riskflow.operators.history import visit_sequence
from riskflow.session import stage


def brute_metrics(y, p):
    order = np.argsort(-p, kind="stable")
    y, p = y[order], p[order]
    last = np.append(p[1:] != p[:-1], True)
    tp, n = np.cumsum(y)[last], np.flatnonzero(last) + 1
    ap = float(np.sum(np.diff(np.append(0, tp)) * tp / n) / y.sum())
    pos, neg = p[y == 1], p[y == 0]
    auc = float(np.mean([(a > neg).mean() + 0.5 * (a == neg).mean() for a in pos]))
    return ap, auc, float(np.mean((p - y) ** 2))


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    rows = []
    for model, digits in (("fine", 6), ("ties", 1)):
        p = np.round(rng.random(3000), digits)
        y = (rng.random(3000) < p * 0.5).astype(int)
        # A third of all rows share one score.
        p[:1000] = 0.4
        rows += [(model, i, float(a), int(b)) for i, (a, b) in enumerate(zip(p, y))]
    return stage(spark.createDataFrame(rows, "model string, encounter_id bigint, score double, target int")), rows


def arrays(rows, model):
    part = [r for r in rows if r[0] == model]
    return np.array([r[3] for r in part]), np.array([r[2] for r in part])


def test_metrics_match_brute_force(scored):
    df, rows = scored
    for r in evaluation.ranking_metrics(df, ("model",)).collect():
        y, p = arrays(rows, r["model"])
        assert (r["pr_auc"], r["roc_auc"], r["brier"]) == pytest.approx(brute_metrics(y, p), rel=1e-12)


@pytest.mark.parametrize("by", [("model",), ()])
@pytest.mark.parametrize("descending", [True, False])
def test_bucketed_running_totals_equal_plain(scored, by, descending):
    df, _ = scored
    counts = stage(evaluation.score_counts(df, by))
    plain = ranking.running_totals(counts, ["n", "pos"], by, descending=descending)
    bucketed = ranking.running_totals(counts, ["n", "pos"], by, descending=descending, max_rows=50)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, bucketed.select(plain.columns).collect()))


@pytest.mark.parametrize("by", [("model",), ()])
def test_bucketed_quantiles_equal_numpy(scored, by):
    df, rows = scored
    probs = [0.0, 0.005, 0.1, 0.37, 0.5, 0.8, 0.995, 1.0]
    counts = stage(ranking.value_counts(df, "score", by))
    for limit in (1_000_000, 40):
        for r in ranking.quantiles(counts, probs, by, max_rows=limit).collect():
            p = arrays(rows, r["model"])[1] if by else np.array([x[2] for x in rows])
            assert list(r["q"]) == pytest.approx(np.quantile(p, probs).tolist(), abs=1e-12)


def test_recall_at_k_worked_example(spark):
    p = [.95, .6, .55, .5, .3, .2, .2, .1]
    y = [0, 1, 1, 0, 1, 0, 1, 0]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(p, y))], "encounter_id bigint, score double, target int")
    r = evaluation.recall_precision_at_k(df, 0.5).first()
    assert (r["k"], r["recall_at_k"], r["precision_at_k"]) == (4, 0.5, 0.5)


def test_recall_at_k_cuts_a_large_tie_by_encounter(scored):
    df, rows = scored
    for r in evaluation.recall_precision_at_k(df, 0.35, ("model",)).collect():
        part = sorted((x for x in rows if x[0] == r["model"]), key=lambda x: (-x[2], x[1]))
        k = int(len(part) * 0.35)
        assert r["true_positives"] == sum(x[3] for x in part[:k])


def test_histogram_equals_numpy(spark):
    x = [0.0, 0.1, 0.25, 0.5, 0.5, 0.99, 1.0, 1.2]
    edges = [0.0, 0.25, 0.5, 1.0]
    df = spark.createDataFrame([(v,) for v in x], "v double")
    got = {r["bin"]: r["n"] for r in ranking.histogram(df, "v", edges).collect()}
    assert [got.get(i, 0) for i in range(3)] == np.histogram(x, edges)[0].tolist()


def psi(spark, ref, cur):
    def table(v):
        return spark.createDataFrame([(float(x),) for x in v], "score double")
    return drift.psi_of_column(table(ref), table(cur), "score").first()["psi"]


def test_psi_of_hand_counted_bins(spark):
    """Ten equal reference bins of ten values; the window has twenty values in the first bin and none in the last."""
    ref = np.arange(100.0)
    cur = np.concatenate([ref[:10], ref[:90]])
    shares = [(0.1, 0.2), *[(0.1, 0.1)] * 8, (0.1, 1e-4)]
    assert psi(spark, ref, cur) == pytest.approx(sum((c - r) * np.log(c / r) for r, c in shares))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=40), st.integers(2, 4))
def test_psi_is_zero_on_repeated_values_and_never_negative(spark, ref, times):
    ref = np.array(ref, float)
    assert psi(spark, ref, np.repeat(ref, times)) == pytest.approx(0, abs=1e-12)
    assert psi(spark, ref, ref + 1) >= 0


def test_psi_separates_same_from_shifted(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(0, 1, 3000)
    assert psi(spark, a, a) < 1e-9
    assert psi(spark, a, rng.normal(0, 1, 3000)) < 0.05
    assert psi(spark, a, rng.normal(1.5, 1, 3000)) > 0.2
    assert psi(spark, np.full(9, 2.0), np.full(5, 2.0)) == 0.0
    assert psi(spark, np.full(9, 2.0), np.array([2.0, 3.0])) == 1.0


def test_psi_categorical(spark):
    rows = [("c", "a", 500, 900), ("c", "b", 500, 100), ("same", "a", 7, 7), ("new", None, 10, 0), ("new", "x", 0, 10)]
    df = spark.createDataFrame(rows, "feature string, cat string, n_ref bigint, n_cur bigint")
    got = {r["feature"]: r["psi"] for r in drift.psi_categorical(df).collect()}
    want = (0.9 - 0.5) * np.log(0.9 / 0.5) + (0.1 - 0.5) * np.log(0.1 / 0.5)
    assert got["c"] == pytest.approx(want) and got["same"] == 0
    assert got["new"] == pytest.approx(2 * (1 - 1e-4) * np.log(1 / 1e-4))


def test_fairness_compares_large_named_groups_only(spark):
    """Two large groups whose positives rank alike, one below the size limit, one without a name."""
    sizes = {"Hispanic": 1500, "AfricanAmerican": 1500, "Other": 60, "?": 400}
    rows, k = [], 0
    for race, n in sizes.items():
        for j in range(n):
            top = race in ("Hispanic", "AfricanAmerican") and j % 5 == 0
            rows.append((k, "Male" if j % 4 < 2 else "Female", race, "[50-60)", 0.9 if top else 0.1, int(j % 5 == 0)))
            k += 1
    df = spark.createDataFrame(rows, "encounter_id bigint, gender string, race string, age string, score double, target int")
    groups = evaluation.group_recall(df, 0.2)
    used = {r["value"]: r["used"] for r in groups.where("dim = 'race'").collect()}
    assert used["Hispanic"] and used["AfricanAmerican"] and not used["Other"] and not used["missing"]
    assert evaluation.fairness_gap(groups).first()["race"] == pytest.approx(0.0)


def test_salted_join_equals_plain_join(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 100).alias("k"), F.col("id").alias("row"))
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left"):
        plain = left.join(right, "k", how)
        salted = join_unique(left, right, "k", F.col("row"), how=how, hot_rows=200)
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_salts_follow_the_measured_key_size(spark):
    left = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("row"))
    right = spark.range(3).select(F.col("id").alias("k"))
    plan = join_unique(left, right, "k", F.col("row"), hot_rows=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    assert join_unique(left, right, "k", F.col("row"), hot_rows=4000)._jdf.queryExecution().optimizedPlan().toString().count("_salt") == 0


def test_joined_tables_are_not_sent_to_all_tasks(spark):
    """Both tables look small to Spark, as millions of rows in compressed files do."""
    left = spark.range(300).select((F.col("id") % 40).alias("k"), F.col("id").alias("row"))
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    assert "BroadcastHashJoin" in left.join(right, "k")._jdf.queryExecution().executedPlan().toString()
    for how in ("inner", "left"):
        joined = join_unique(left, right, "k", F.col("row"), how=how)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, "k", how).collect()))


def test_rows_of_a_group_are_not_brought_together(spark):
    """Two models of 20,000 rows, with automatic broadcasts off, as for tables beyond their limit."""
    scored = stage(spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("model"), F.col("id").alias("encounter_id"),
        (F.pmod(F.xxhash64("id"), F.lit(997)) / 997).alias("score"), (F.col("id") % 3 == 0).cast("int").alias("target"),
        F.lit("Male").alias("gender"), F.lit("Other").alias("race"), F.lit("[50-60)").alias("age")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        groups = evaluation.group_recall(scored, 0.1, ("model",))
        assert "SortMergeJoin" not in groups._jdf.queryExecution().executedPlan().toString()
        topk = evaluation.recall_precision_at_k(scored, 0.1, ("model",)).orderBy("model").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert groups.where("dim = 'gender'").count() == 2
    for row in topk:
        own = scored.where(F.col("model") == row["model"]).orderBy(F.desc("score"), "encounter_id").limit(2000)
        assert (row["k"], row["true_positives"]) == (2000, own.where("target = 1").count())


def test_ranges_stay_small_and_exact_with_one_huge_group(spark):
    """One group of 20,000 values (a null key), one of 7,000 and 1,000 of 3; two levels of offsets."""
    g = F.when(F.col("id") < 20_000, None).when(F.col("id") < 27_000, -1).otherwise(F.col("id") % 1000)
    values = stage(spark.range(30_000).select(
        g.alias("g"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).cast("double").alias("value"), (F.col("id") % 5 + 1).alias("n")))
    plain = ranking.running_totals(values, ["n"], ("g",), totals=True)
    cut = ranking.running_totals(values, ["n"], ("g",), max_rows=100, totals=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.select(plain.columns).collect()))
    ranged, n = ranking.cut_ranges(values, [F.col("g"), F.col("value")], 30_000, 1000, "r")
    assert n == 60 and ranged.groupBy("r").count().agg(F.max("count")).first()[0] < 2000
    probs = [0.0, 0.25, 0.9, 1.0]
    few, many = (ranking.quantiles(values, probs, ("g",), max_rows=m).collect() for m in (1_000_000, 100))
    as_dict = lambda rows: {r["g"]: r["q"] for r in rows}
    assert as_dict(few).keys() == as_dict(many).keys()
    assert all(q == pytest.approx(as_dict(few)[k]) for k, q in as_dict(many).items())


def test_visits_cut_in_ranges_equal_plain_order(spark):
    visits = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("p"), F.col("id").alias("k"),
        F.timestamp_seconds(F.pmod(F.col("id") * 7919, F.lit(200)) * 40000).alias("t"))
    plain = visit_sequence(visits, "p", "t", "k")
    cut = visit_sequence(visits, "p", "t", "k", max_rows=50)
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.select(plain.columns).collect()))


def test_the_curve_is_ordered_once_for_all_metrics(spark, monkeypatch):
    rows = [("m", k, float(k % 97) / 97, k % 3 % 2, "Female", "Asian", "[70-80)") for k in range(300)]
    scored = spark.createDataFrame(rows, "model string, encounter_id long, score double, target int, gender string, race string, age string")
    curves = []
    monkeypatch.setattr(evaluation, "curve_metrics", lambda curve, by: curves.append(curve) or curve.groupBy(*by).agg(*[F.lit(0.0).alias(c) for c in ("pr_auc", "roc_auc", "brier")]))
    evaluation.evaluate_wide(scored, ("model",)).collect()
    assert "Window" not in curves[0]._jdf.queryExecution().toString()
