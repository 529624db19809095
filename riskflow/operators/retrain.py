"""The next training set: labelled production rows checked, split and merged into the old one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.contract import INPUT_COLS, TARGET
from riskflow.functions import hash_bucket
from riskflow.operators.joins import sorted_side
from riskflow.operators.quality import validate
from riskflow.params import Params
from riskflow.session import stage


def labeled_rows(labelled: DataFrame) -> DataFrame:
    """Labelled predictions as table rows: outcome as ``target``; score and version dropped."""
    return labelled.withColumnRenamed("readmitted_30d", TARGET).withColumn(
        TARGET, F.col(TARGET).cast("int")
    ).drop("score", "model_version")


def last_per_encounter(rows: DataFrame) -> DataFrame:
    """The last row per encounter by (ts, request_id), combined before the shuffle."""
    cols = [c for c in rows.columns if c not in ("ts", "request_id", "encounter_id")]
    last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in cols]), F.struct("ts", "request_id"))
    return rows.groupBy("encounter_id").agg(last.alias("r")).select("encounter_id", "r.*")


def to_raw_form(rows: DataFrame) -> DataFrame:
    """Labelled rows in the layout of the raw table, for the contract check."""
    patient = F.col("patient_nbr") if "patient_nbr" in rows.columns else F.lit(None)
    return rows.withColumns({
        "readmitted": F.when(F.col(TARGET) == 1, "<30").otherwise("NO"),
        "patient_nbr": F.coalesce(patient, F.col("encounter_id")).cast("bigint"),
        "encounter_id": F.col("encounter_id").cast("bigint"),
    }).drop(TARGET)


def split_new_labels(rows: DataFrame, old: DataFrame, params: Params = Params(), patients: DataFrame | None = None) -> DataFrame:
    """A patient of the old table stays in its split; others go 70 % to train, 30 % to test.

    The patient is that of the row, else that of the encounter in the old table or in ``patients`` (encounter_id,
    patient_nbr), which scoring requests don't carry. New patients are split by a hash of the patient, so a patient is in
    one split only. A row without any known patient is split by its encounter; ``shared_between_splits`` counts these.
    """
    own = F.col("patient_nbr") if "patient_nbr" in rows.columns else F.lit(None)
    known = old.select("encounter_id", "patient_nbr")
    if patients is not None:
        known = known.unionByName(patients.select("encounter_id", "patient_nbr").join(sorted_side(rows.select("encounter_id").distinct()), "encounter_id", "left_semi"))
    of_encounter = known.groupBy("encounter_id").agg(F.max("patient_nbr").alias("_known"))
    of_patient = old.where(F.col("patient_nbr").isNotNull()).groupBy("patient_nbr").agg(F.min("split").alias("_split"))
    found = rows.withColumn("_own", own.cast("bigint")).drop("patient_nbr").join(sorted_side(of_encounter), "encounter_id", "left")
    found = found.withColumn("patient_nbr", F.coalesce("_own", "_known")).drop("_own", "_known").join(sorted_side(of_patient), "patient_nbr", "left")
    key = F.coalesce(F.col("patient_nbr").cast("string"), F.col("encounter_id").cast("string"))
    split = F.when(hash_bucket(key, params.seed) < params.new_train_share, "train").otherwise("test")
    return found.withColumn("split", F.coalesce("_split", split)).drop("_split")


def merge_labeled(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old splits plus new rows; the new row of an encounter replaces its old one in whatever split.

    Only the old rows' keys are looked up, and no wide row is sorted. Columns the old table does not have are dropped, absent ones are null.
    """
    kept = new.select(*[F.col(f"`{c}`") for c in old.columns if c in new.columns])
    keys = new.select("encounter_id").distinct()
    return old.join(sorted_side(keys), "encounter_id", "left_anti").select(
        *[F.col(f"`{c}`") for c in old.columns]
    ).unionByName(kept, allowMissingColumns=True)


def build_dataset_version(
    old: DataFrame, labelled: DataFrame, params: Params = Params(), check: bool = True, patients: DataFrame | None = None
) -> DataFrame:
    """The merged table (``old`` has a ``split`` column); invalid new rows raise before anything is merged."""
    new = stage(last_per_encounter(labeled_rows(labelled)))
    if check:
        validate(to_raw_form(new).select("encounter_id", "patient_nbr", "readmitted", *INPUT_COLS), params, min_rows=1)
    return merge_labeled(old, split_new_labels(new, old, params, patients))


def shared_between_splits(merged: DataFrame) -> DataFrame:
    """One row: patients and encounters that are in more than one split, both 0 in a sound version, and the rows whose
    patient is unknown, of which nobody can tell."""
    def shared(key: str) -> DataFrame:
        several = merged.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("split").alias("a"), F.max("split").alias("b"))
        return several.where("a < b").select(F.lit(key).alias("key"))

    both = shared("patient_nbr").unionByName(shared("encounter_id"))
    count = lambda key: F.count(F.when(F.col("key") == key, 1))
    unknown = merged.agg(F.count_if(F.col("patient_nbr").isNull()).alias("n")).scalar()
    counts = both.agg(count("patient_nbr").alias("shared_patients"), count("encounter_id").alias("shared_encounters"))
    return counts.withColumn("rows_without_patient", unknown)
