"""Labelled cohorts, patient-level splits and their lineage."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.contract import TARGET
from riskflow.functions import fingerprint as content
from riskflow.functions import hash_bucket
from riskflow.params import Params


def exclude_discharges(df: DataFrame, ids: tuple[int, ...] = Params().exclude_discharge_ids) -> DataFrame:
    """Drop death and hospice discharges; an unknown discharge id stays in."""
    code = F.col("discharge_disposition_id")
    return df.where(~code.isin(*ids) | code.isNull())


def with_target(df: DataFrame) -> DataFrame:
    """1 when the patient came back within 30 days; every other outcome, null included, is 0."""
    return df.withColumn(TARGET, F.col("readmitted").eqNullSafe("<30").cast("int")).drop("readmitted")


def make_target(df: DataFrame, ids: tuple[int, ...] = Params().exclude_discharge_ids) -> DataFrame:
    return with_target(exclude_discharges(df, ids))


def with_split(df: DataFrame, params: Params = Params(), key: str = "patient_nbr") -> DataFrame:
    """Assign ``split`` by patient. A narrow projection: rows neither move nor depend on each other."""
    bucketed = df.withColumn("_bucket", hash_bucket(key, params.seed))
    edge = params.test_size + params.val_size
    split = (
        F.when(F.col("_bucket") < params.test_size, "test")
        .when(F.col("_bucket") < edge, "val").otherwise("train")
    )
    return bucketed.withColumn("split", split).drop("_bucket")


def split_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(
        F.count("*").alias("rows"), F.round(F.avg(F.col(TARGET).cast("double")), 4).alias("pos_rate")
    )


def shared_patients(df: DataFrame) -> DataFrame:
    """Patients found in more than one split; empty for a proper split."""
    return (
        df.groupBy("patient_nbr").agg(F.min("split").alias("first"), F.max("split").alias("last"))
        .where(F.col("first") != F.col("last"))
    )


def assert_disjoint(df: DataFrame) -> None:
    if shared_patients(df).take(1):
        raise ValueError("a patient is in more than one split")


def fingerprints(df: DataFrame) -> DataFrame:
    """(split, rows, pos_rate, sha256): an order-independent content hash per split, which adds up over appends."""
    rate = F.round(F.avg(F.col(TARGET).cast("double")), 4)
    return content.fingerprints(df, ("split",), pos_rate=rate).select("split", "rows", "pos_rate", content.digest().alias("sha256"))


def settings(params: Params = Params()) -> str:
    """What else decides on a version: how rows are chosen and split."""
    names = ("exclude_discharge_ids", "seed", "test_size", "val_size")
    return json.dumps({n: getattr(params, n) for n in names})


def lineage(df: DataFrame, params: Params = Params(), parent: str | None = None, raw: DataFrame | None = None) -> DataFrame:
    """One row: the splits with their hashes, the hash of the raw table, the data version, and the version it grew from."""
    splits = F.sort_array(F.collect_list(F.struct("split", "rows", "pos_rate", "sha256")))
    source = content.fingerprints(raw).select(content.digest().alias("h")).scalar() if raw is not None else F.lit(None)
    row = fingerprints(df).agg(splits.alias("splits")).withColumn("raw_sha256", source.cast("string"))
    hashes = F.transform("splits", lambda s: F.concat_ws(":", s["split"], s["sha256"]))
    version = F.sha2(F.concat_ws("|", F.coalesce("raw_sha256", F.lit("")), F.lit(settings(params)), hashes), 256)
    return row.select("splits", "raw_sha256", F.substring(version, 1, 12).alias("data_version"), F.lit(parent).cast("string").alias("parent_data_version"))
