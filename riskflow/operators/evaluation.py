"""Exact ranking, probability-error and fairness metrics, for one model or several at once.

``scored`` has one row per (model, encounter): the ``by`` columns name the model, then ``score``,
``target`` and ``encounter_id``. Ranking metrics read (model, score) counts, so rows with equal
scores are combined before anything is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions import age_start
from riskflow.operators.ranking import join_groups, quantiles, running_totals, value_counts
from riskflow.params import Params
from riskflow.session import keep, stage

# Values that name no demographic group.
NOT_A_GROUP = ["missing", "Unknown/Invalid"]
AGE_LIMIT = 60


def with_models(df: DataFrame, scores: dict[str, str]) -> DataFrame:
    """Long form of several score columns of one table: (other columns, model, score)."""
    pairs = [F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("score")) for m, c in scores.items()]
    keep = [c for c in df.columns if c not in scores.values()]
    return df.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(*pairs)))


def score_counts(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., value, n, pos): rows and positives per distinct score."""
    return value_counts(scored, "score", by, pos=F.col("target").cast("bigint"))


def pr_curve(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Cumulative rows and positives over falling scores: (by..., value, n, pos, cum_n, cum_pos)."""
    return running_totals(counts, ["n", "pos"], by, descending=True)


def curve_metrics(curve: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Average precision, tie-corrected ROC-AUC and Brier score in one aggregation over the curve."""
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    before = F.col("cum_pos") - F.col("pos")
    p = F.col("value")
    sums = curve.groupBy(*by).agg(
        F.sum("n").alias("n_rows"), F.sum(pos).alias("n_pos"),
        F.sum(pos * F.col("cum_pos") / F.col("cum_n")).alias("ap"),
        F.sum(neg * (before + pos / 2.0)).alias("auc"),
        F.sum(pos * (1 - p) * (1 - p) + neg * p * p).alias("err"),
    )
    both = (F.col("n_pos") > 0) & (F.col("n_pos") < F.col("n_rows"))
    pairs = F.col("n_pos").cast("double") * (F.col("n_rows") - F.col("n_pos"))
    return sums.select(
        *by, "n_rows", "n_pos",
        F.when(F.col("n_pos") > 0, F.col("ap") / F.col("n_pos")).otherwise(0.0).alias("pr_auc"),
        F.when(both, F.col("auc") / pairs).alias("roc_auc"),
        (F.col("err") / F.col("n_rows")).alias("brier"),
    )


def ranking_metrics(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return curve_metrics(pr_curve(stage(score_counts(scored, by)), by), by)


def average_precision(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return ranking_metrics(scored, by).select(*by, "pr_auc")


def roc_auc(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return ranking_metrics(scored, by).select(*by, "roc_auc")


def brier(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean squared error of the probability; needs no order."""
    err = F.col("score") - F.col("target")
    return scored.groupBy(*by).agg(F.avg(err * err).alias("brier"))


def recall_precision_at_k(
    scored: DataFrame, k_frac: float = Params().top_k_frac, by: tuple[str, ...] = (),
    curve: DataFrame | None = None,
) -> DataFrame:
    """Recall and precision of the k highest scores, ties taken in encounter order: (by..., k, ...).

    Scores above the boundary score count whole. Only the rows at the boundary score are ordered by
    encounter, again over counts, because with a coarse score they may be a large share of the table.
    """
    keys = list(by) or ["_all"]
    rows = scored if by else scored.withColumn("_all", F.lit(0))
    if curve is None:
        curve = pr_curve(stage(score_counts(rows, tuple(keys))), tuple(keys))
    elif not by:
        curve = curve.withColumn("_all", F.lit(0))
    totals = curve.groupBy(*keys).agg(F.sum("n").alias("n_rows"), F.sum("pos").alias("n_pos"))
    k = F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("n_rows") * F.lit(k_frac)))
    totals = totals.withColumn("k", k)
    full = F.col("cum_n") < F.col("k")
    boundary = stage(
        join_groups(curve, totals, keys).groupBy(*keys, "n_rows", "n_pos", "k").agg(
            F.max(F.when(~full, F.col("value"))).alias("edge"),
            F.coalesce(F.max(F.when(full, F.col("cum_n"))), F.lit(0)).alias("n_above"),
            F.coalesce(F.max(F.when(full, F.col("cum_pos"))), F.lit(0)).alias("pos_above"),
        )
    )
    edges = boundary.select(*keys, F.col("edge").alias("score"))
    # One boundary row per model; models are named by whoever calls.
    tied = join_groups(rows.withColumn("score", F.col("score").cast("double")), edges, [*keys, "score"])
    ties = stage(tied.groupBy(*keys, F.col("encounter_id").alias("value")).agg(
        F.count("*").alias("n"), F.sum(F.col("target").cast("bigint")).alias("pos")
    ))
    ranked = running_totals(ties, ["n", "pos"], tuple(keys))
    taken = (
        join_groups(ranked, boundary, keys)
        .where(F.col("cum_n") <= F.col("k") - F.col("n_above"))
        .groupBy(*keys).agg(F.max("cum_pos").alias("pos_tied"))
    )
    tp = F.col("pos_above") + F.coalesce("pos_tied", F.lit(0))
    return boundary.join(taken, keys, "left").select(
        *by, "k", tp.alias("true_positives"),
        (tp / F.greatest(F.col("n_pos"), F.lit(1))).alias("recall_at_k"),
        (tp / F.col("k")).alias("precision_at_k"),
    )


def subgroups() -> list[tuple[str, Column]]:
    """The demographic dimensions; age is reported, not judged."""
    race = F.coalesce(F.nullif(F.col("race"), F.lit("?")), F.lit("missing"))
    age = F.when(age_start() >= AGE_LIMIT, ">=60").otherwise("<60")
    return [
        ("gender", F.coalesce(F.col("gender"), F.lit("missing"))),
        ("race", race),
        ("age60", age),
    ]


def score_threshold(counts: DataFrame, k_frac: float, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., threshold): the 1-k quantile of the scores."""
    return quantiles(counts, [1 - k_frac], by).select(*by, F.col("q")[0].alias("threshold"))


def group_recall(
    scored: DataFrame, k_frac: float = Params().top_k_frac, by: tuple[str, ...] = (),
    params: Params = Params(), counts: DataFrame | None = None,
) -> DataFrame:
    """Recall of the flagged share per demographic group: (by..., dim, value, n_positive, recall, used)."""
    keys = list(by) or ["_all"]
    rows = scored if by else scored.withColumn("_all", F.lit(0))
    if counts is None:
        counts = stage(score_counts(rows, tuple(keys)))
    elif not by:
        counts = counts.withColumn("_all", F.lit(0))
    limits = score_threshold(counts, k_frac, tuple(keys))
    dims = [F.struct(F.lit(d).alias("dim"), v.alias("value")) for d, v in subgroups()]
    # One threshold for all rows is a value, not a join.
    limited = join_groups(rows, limits, keys) if by else rows.withColumn("threshold", limits.select("threshold").scalar()).where("threshold IS NOT NULL")
    flagged = limited.select(
        *keys, (F.col("score") >= F.col("threshold")).cast("int").alias("flagged"), "target",
        F.inline(F.array(*dims)),
    )
    positive = F.col("target") == 1
    return flagged.groupBy(*keys, "dim", "value").agg(
        F.count_if(positive).alias("n_positive"),
        F.avg(F.when(positive, F.col("flagged").cast("double"))).alias("recall"),
    ).select(
        *by, "dim", "value", "n_positive", "recall",
        (~F.col("value").isin(*NOT_A_GROUP) & (F.col("n_positive") >= params.min_group_positives)).alias("used"),
    )


def fairness_gap(groups: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Largest recall difference per dimension, and the larger of gender and race: (by..., gender, race, age60, max)."""
    def gap(dim: str) -> Column:
        recall = F.when((F.col("dim") == dim) & F.col("used"), F.col("recall"))
        # One usable group gives 0 by itself, none gives null.
        return F.coalesce(F.max(recall) - F.min(recall), F.lit(0.0))

    gaps = groups.groupBy(*by).agg(*[gap(d).alias(d) for d in ("gender", "race", "age60")])
    return gaps.withColumn("max", F.greatest("gender", "race"))


METRICS = ["pr_auc", "roc_auc", "brier", "recall_at_k", "precision_at_k", "fairness_gap", "age_recall_gap"]


def evaluate_wide(scored: DataFrame, by: tuple[str, ...], params: Params = Params()) -> DataFrame:
    """One row of metrics per model, 5 decimals. ``scored`` should be staged or cheap to read twice."""
    counts = stage(score_counts(scored, by))
    # Many distinct scores are ordered in ranges; the curve has four readers and is ordered for all of them at once.
    curve = keep(pr_curve(counts, by), "curve")
    topk = recall_precision_at_k(scored, params.top_k_frac, by, curve=curve)
    gaps = fairness_gap(group_recall(scored, params.top_k_frac, by, params, counts), by)
    joined = (
        curve_metrics(curve, by).join(topk, list(by)).join(gaps, list(by))
        .withColumnsRenamed({"max": "fairness_gap", "age60": "age_recall_gap"})
    )
    return joined.select(*by, *[F.round(m, 5).alias(m) for m in METRICS])


def evaluate(scored: DataFrame, by: tuple[str, ...] = ("model",), params: Params = Params()) -> DataFrame:
    """The metric bundle in long form: (by..., metric, value)."""
    return evaluate_wide(scored, by, params).unpivot(list(by), METRICS, "metric", "value")


def compare_models(df: DataFrame, scores: dict[str, str], params: Params = Params()) -> DataFrame:
    """Champion and challenger on the same rows: one pass over one table, no join."""
    return evaluate(with_models(df, scores), ("model",), params)


def select_best(metrics: DataFrame, metric: str = "pr_auc") -> DataFrame:
    """The best experiment; the first one wins a tie. ``metrics`` has one row per experiment with ``seq``."""
    return metrics.orderBy(F.col(metric).desc(), F.col("seq").asc()).limit(1)


def comparison_table(metrics: list[DataFrame]) -> DataFrame:
    """Experiments under each other, for the report."""
    table = metrics[0]
    for other in metrics[1:]:
        table = table.unionByName(other, allowMissingColumns=True)
    return table
