"""Population stability index (PSI) of all features at once, from value-count profiles.

Both samples are profiled once (``features.profile``); edges, bins and shares are then computed from
the profiles, which hold distinct values only. A stored reference profile spares its table a rescan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.contract import CAT_COLS, NUM_COLS
from riskflow.operators.features import profile
from riskflow.operators.ranking import bin_index, quantiles, value_counts
from riskflow.params import Params
from riskflow.session import stage

# Fixed values.
EPS = 1e-4
BINS = 10
BAND_LOW, BAND_HIGH = 0.1, 0.2


def merge_profiles(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(feature, num, cat, n_ref, n_cur): both samples' counts per value."""
    zero = F.lit(0).cast("bigint")
    ref = reference.select("feature", "num", "cat", F.col("n").alias("n_ref"), zero.alias("n_cur"))
    cur = current.select("feature", "num", "cat", zero.alias("n_ref"), F.col("n").alias("n_cur"))
    return ref.unionAll(cur).groupBy("feature", "num", "cat").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )


def reference_edges(values: DataFrame, bins: int = BINS, by: tuple[str, ...] = ("feature",)) -> DataFrame:
    """(by..., edges): the distinct quantiles of the reference, from (by..., value, n) counts."""
    probs = [i / bins for i in range(bins + 1)]
    return quantiles(values, probs, by).select(*by, F.array_distinct("q").alias("edges"))


def _index(shares: DataFrame) -> DataFrame:
    """PSI per (feature, kind) from (feature, kind, bucket, n_ref, n_cur) counts.

    A bucket empty on both sides adds nothing, so only buckets that hold something are needed.
    """
    totals = shares.groupBy("feature").agg(F.sum("n_ref").alias("ref_total"), F.sum("n_cur").alias("cur_total"))
    # One row per feature.
    joined = shares.join(F.broadcast(totals), "feature")

    def share(n: str, total: str) -> Column:
        return F.greatest(F.coalesce(F.try_divide(F.col(n), F.col(total)), F.lit(0.0)), F.lit(EPS))

    joined = joined.withColumns({"r": share("n_ref", "ref_total"), "c": share("n_cur", "cur_total")})
    return joined.groupBy("feature", "kind").agg(
        F.sum((F.col("c") - F.col("r")) * F.log(F.col("c") / F.col("r"))).alias("psi"),
        F.count("*").alias("buckets"),
        F.max("ref_total").alias("ref_total"), F.max("cur_total").alias("cur_total"),
    )


def psi_numeric(counts: DataFrame, bins: int = BINS) -> DataFrame:
    """PSI per numeric feature from (feature, value, n_ref, n_cur): (feature, bins, psi).

    Bins follow the reference quantiles and are open at both ends. ``bins`` = 1 warns that the
    quantiles collapsed and the index cannot see a change; a constant reference gives 0 or 1.
    """
    # Unknown values count for neither side; their rows stay so that an all-null feature is reported.
    unknown = F.col("value").isNull()
    known = counts.withColumns({
        n: F.when(unknown, F.lit(0)).otherwise(F.col(n)).cast("bigint") for n in ("n_ref", "n_cur")
    })
    reference = known.where(F.col("n_ref") > 0).select("feature", "value", F.col("n_ref").alias("n"))
    edges = reference_edges(reference, bins)
    cut = known.join(F.broadcast(edges), "feature", "left")
    # Outside the reference range the first and last bins go on.
    held = F.greatest(F.least(F.col("value"), F.element_at("edges", -1)), F.element_at("edges", 1))
    constant = F.size("edges") == 1
    bucket = F.when(constant, (F.col("value") != F.element_at("edges", 1)).cast("int")).otherwise(
        bin_index(held, F.col("edges"))
    )
    binned = cut.groupBy("feature", bucket.alias("bucket"), constant.alias("constant"), F.size("edges").alias("n_edges")).agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )
    index = _index(binned.select("feature", F.lit("numeric").alias("kind"), "bucket", "n_ref", "n_cur"))
    shape = binned.groupBy("feature").agg(
        F.bool_or("constant").alias("constant"), F.max("n_edges").alias("n_edges"),
        F.sum(F.when(F.col("constant") & (F.col("bucket") == 1), F.col("n_cur")).otherwise(0)).alias("n_other"),
    )
    empty = (F.col("ref_total") == 0) | (F.col("cur_total") == 0)
    psi = (
        F.when(empty, 0.0)
        .when(F.col("constant"), F.when(F.col("n_other") > 0, 1.0).otherwise(0.0))
        .otherwise(F.col("psi"))
    )
    return index.join(F.broadcast(shape), "feature").select(
        "feature", F.greatest(F.col("n_edges") - 1, F.lit(0)).alias("bins"), psi.alias("psi")
    )


def psi_categorical(counts: DataFrame) -> DataFrame:
    """PSI per categorical feature from (feature, cat, n_ref, n_cur); null counts as ``missing``."""
    by_cat = counts.groupBy("feature", F.coalesce("cat", F.lit("missing")).alias("bucket")).agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )
    index = _index(by_cat.select("feature", F.lit("categorical").alias("kind"), "bucket", "n_ref", "n_cur"))
    return index.select("feature", F.col("buckets").cast("int").alias("bins"), "psi")


def psi_of_profiles(reference: DataFrame, current: DataFrame, bins: int = BINS) -> DataFrame:
    """(feature, kind, bins, psi) for all features of two profiles."""
    both = stage(merge_profiles(reference, current))
    numeric = both.where(F.col("feature").isin(*NUM_COLS)).select(
        "feature", F.col("num").alias("value"), "n_ref", "n_cur"
    )
    categorical = both.where(F.col("feature").isin(*CAT_COLS))
    return (
        psi_numeric(numeric, bins).withColumn("kind", F.lit("numeric"))
        .unionByName(psi_categorical(categorical).withColumn("kind", F.lit("categorical")))
        .select("feature", "kind", "bins", "psi")
    )


def feature_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """PSI table of two samples of cleaned features, 4 decimals."""
    return psi_of_profiles(profile(reference), profile(current)).withColumn("psi", F.round("psi", 4))


def psi_of_column(reference: DataFrame, current: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """PSI of one numeric column of two tables, e.g. of scores: one row (bins, psi)."""
    return psi_of_counts(value_counts(reference, column), value_counts(current, column), bins)


def psi_of_counts(reference: DataFrame, current: DataFrame, bins: int = BINS) -> DataFrame:
    """PSI of two samples given as (value, n): one row (bins, psi)."""
    zero = F.lit(0).cast("bigint")
    ref = reference.select("value", F.col("n").alias("n_ref"), zero.alias("n_cur"))
    cur = current.select("value", zero.alias("n_ref"), F.col("n").alias("n_cur"))
    merged = ref.unionAll(cur).groupBy("value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    counts = stage(merged.select(F.lit("value").alias("feature"), "value", "n_ref", "n_cur"))
    # An aggregate without groups gives its one row also where a side is empty.
    return psi_numeric(counts, bins).agg(
        F.coalesce(F.max("bins"), F.lit(0)).alias("bins"), F.coalesce(F.max("psi"), F.lit(0.0)).alias("psi")
    )


def band(psi: Column) -> Column:
    """How to read an index: stable, moderate or major change."""
    return F.when(psi < BAND_LOW, "stable").when(psi < BAND_HIGH, "moderate").otherwise("major")


def summary(psi: DataFrame, params: Params = Params()) -> DataFrame:
    """One row: features drifted, their share, the largest index, and the data-drift verdict."""
    drifted = F.col("psi") >= params.psi_threshold
    row = psi.agg(
        F.count("*").alias("n_features"), F.count_if(drifted).alias("n_drifted"),
        F.max("psi").alias("max_feature_psi"),
    )
    share = F.col("n_drifted") / F.col("n_features")
    return row.select("*", share.alias("drift_share"), (share >= params.drift_share_threshold).alias("data_drift"))
