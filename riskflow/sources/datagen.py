"""A generated cohort with planted risk, and what-if shifts of an existing cohort.

All draws are hashes of (seed, draw name, row id), so the same rows come out whatever the number of
partitions or retries.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.contract import AGE_BINS, MED_COLS, MED_VALUES, RANGES, RAW_COLS, TARGET
from riskflow.functions import hash_uniform, icd9_group, logistic

# ---- Fixed values: shares of each value in the generated cohort ----
SHARES = {
    "race": (["Caucasian", "AfricanAmerican", "Hispanic", "Asian", "Other", "?"],
             [0.74, 0.19, 0.02, 0.01, 0.015, 0.025]),
    "gender": (["Female", "Male"], [0.54, 0.46]),
    "age": (AGE_BINS, [0.005, 0.01, 0.02, 0.04, 0.09, 0.17, 0.22, 0.26, 0.16, 0.025]),
    "admission_type_id": ([1, 2, 3, 5, 6], [0.53, 0.18, 0.19, 0.05, 0.05]),
    "discharge_disposition_id": ([1, 3, 6, 18, 2, 22, 11], [0.59, 0.14, 0.13, 0.04, 0.03, 0.05, 0.02]),
    "admission_source_id": ([7, 1, 17, 4, 6], [0.56, 0.29, 0.07, 0.04, 0.04]),
    "payer_code": (["?", "MC", "HM", "SP"], [0.4, 0.32, 0.14, 0.14]),
    "medical_specialty": (["?", "InternalMedicine", "Emergency/Trauma", "Family/GeneralPractice",
                           "Cardiology", "Surgery-General"], [0.49, 0.14, 0.08, 0.07, 0.12, 0.1]),
    "max_glu_serum": (["None", "Norm", ">200", ">300"], [0.95, 0.025, 0.015, 0.01]),
    "A1Cresult": (["None", "Norm", ">7", ">8"], [0.83, 0.05, 0.04, 0.08]),
    "change": (["No", "Ch"], [0.54, 0.46]),
    "diabetesMed": (["Yes", "No"], [0.77, 0.23]),
}
MED_SHARES = (MED_VALUES, [0.8, 0.15, 0.03, 0.02])
DIAGNOSIS_POOL = ["428", "250.83", "410", "414", "486", "491", "584", "V57", "780", "996", "715", "?"]
# Log-odds of coming back within 30 days.
RISK = {"base": -3.3, "inpatient": 0.7, "emergency": 0.4, "stay": 0.08, "age": 0.08,
        "heart_failure": 0.7, "insulin_up": 0.6, "nursing": 0.8}
LATE_RETURN = 0.35
# Log-odds after the outcome mechanism changed.
NEW_RISK = {"base": -2.6, "inpatient": -0.8, "procedures": 1.4, "respiratory": 1.2, "first_stay": 1.0}
# --------------------------------------------------------------------


def _choice(u: Column, values: list, shares: list[float]) -> Column:
    out, upper = None, 0.0
    for value, share in list(zip(values, shares))[:-1]:
        upper += share
        out = F.when(u < upper, F.lit(value)) if out is None else out.when(u < upper, F.lit(value))
    return F.lit(values[-1]) if out is None else out.otherwise(F.lit(values[-1]))


def _even(u: Column, values: list) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(u * len(values)) + 1).cast("int"))


def poisson(u: Column, mean: float) -> Column:
    """Inverse of the Poisson distribution function, to where double precision ends."""
    total, steps = 0.0, []
    for k in range(int(mean + 12 * math.sqrt(mean)) + 40):
        total += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) if mean > 0 else float(k == 0)
        steps.append(total)
    return F.size(F.filter(F.array(*map(F.lit, steps)), lambda s: u >= s)).cast("bigint")


def _normal(u1: Column, u2: Column, mean: float, spread: float) -> Column:
    radius = F.sqrt(F.lit(-2.0) * F.log(F.greatest(u1, F.lit(1e-12))))
    return F.lit(mean) + F.lit(spread) * radius * F.cos(F.lit(2 * math.pi) * u2)


def _clip(value: Column, low: int, high: int) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high)).cast("bigint")


def generate_encounters(spark: SparkSession, n: int, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """``n`` encounters in the raw 50-column layout, about 0.7 n patients, with a label to learn."""
    base = spark.range(1, n + 1, 1, partitions) if partitions else spark.range(1, n + 1)

    def u(name: str) -> Column:
        return hash_uniform("id", name, seed)

    cols = {
        "encounter_id": F.col("id") * 7,
        "patient_nbr": (F.floor(u("patient_nbr") * max(1, int(n * 0.7) - 1)) + 1).cast("bigint"),
        "weight": F.lit("?"),
        "time_in_hospital": _clip(poisson(u("time_in_hospital"), 3.4) + 1, 1, 14),
        "num_lab_procedures": _clip(F.round(_normal(u("lab1"), u("lab2"), 43, 19)), 1, 132),
        "num_procedures": F.floor(u("num_procedures") * 7).cast("bigint"),
        "num_medications": _clip(F.round(_normal(u("med1"), u("med2"), 16, 8)), 1, 81),
        "number_outpatient": poisson(u("number_outpatient"), 0.37),
        "number_emergency": poisson(u("number_emergency"), 0.2),
        "number_inpatient": poisson(u("number_inpatient"), 0.6),
        "number_diagnoses": (F.floor(u("number_diagnoses") * 16) + 1).cast("bigint"),
        **{d: _even(u(d), DIAGNOSIS_POOL) for d in ("diag_1", "diag_2", "diag_3")},
        **{c: _choice(u(c), *spec) for c, spec in SHARES.items()},
        **{c: _choice(u(c), *MED_SHARES) for c in MED_COLS},
    }
    integers = {"admission_type_id", "discharge_disposition_id", "admission_source_id"}
    rows = base.select("id", *[
        (v.cast("bigint") if c in integers else v).alias(c) for c, v in cols.items()
    ])

    def hit(condition: Column) -> Column:
        return condition.cast("double")

    age_index = F.array_position(F.array(*map(F.lit, AGE_BINS)), F.col("age")) - 1
    logit = (
        F.lit(RISK["base"]) + RISK["inpatient"] * F.col("number_inpatient")
        + RISK["emergency"] * F.col("number_emergency") + RISK["stay"] * F.col("time_in_hospital")
        + RISK["age"] * (age_index - 6) + RISK["heart_failure"] * hit(F.col("diag_1") == "428")
        + RISK["insulin_up"] * hit(F.col("insulin") == "Up")
        + RISK["nursing"] * hit(F.col("discharge_disposition_id").isin(3, 22))
    )
    rows = rows.withColumns({"_p": logistic(logit), "_u": u("readmitted")})
    outcome = (
        F.when(F.col("_u") < F.col("_p"), "<30").when(F.col("_u") < F.col("_p") + LATE_RETURN, ">30").otherwise("NO")
    )
    return rows.withColumn("readmitted", outcome).select(*[F.col(f"`{c}`") for c in RAW_COLS])


def resample(df: DataFrame, fraction: float, seed: int = 7) -> DataFrame:
    """Sample with replacement: each row comes Poisson(fraction) times, as an encounter of its own."""
    copies = poisson(hash_uniform("encounter_id", "copies", seed), fraction)
    drawn = df.withColumn("_copies", copies).where(F.col("_copies") > 0)
    drawn = drawn.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    new_id = F.pmod(F.xxhash64("encounter_id", "_copy", F.lit(seed)), F.lit(2**62)) + 1
    return drawn.withColumn("encounter_id", new_id).drop("_copies", "_copy")


def shift_cohort(df: DataFrame, scenario: str, seed: int = 7) -> DataFrame:
    """``data_drift`` makes the patients older and sicker; ``concept_drift`` keeps them and redraws ``target``."""
    def u(name: str) -> Column:
        return hash_uniform("encounter_id", name, seed)

    if scenario == "normal":
        return df
    if scenario == "data_drift":
        bins = F.array(*map(F.lit, AGE_BINS))
        older = F.least(F.array_position(bins, F.col("age")) + 2, F.lit(len(AGE_BINS)))
        return df.withColumns({
            "age": F.element_at(bins, older.cast("int")),
            "num_medications": _clip(
                F.col("num_medications") + 5 + F.floor(u("num_medications") * 10), *RANGES["num_medications"]
            ),
            "number_inpatient": _clip(
                F.col("number_inpatient") + poisson(u("number_inpatient"), 2.0), *RANGES["number_inpatient"]
            ),
            "admission_type_id": F.when(u("admission_type_id") < 0.9, 1).otherwise(2).cast("bigint"),
            "time_in_hospital": _clip(F.col("time_in_hospital") + 3, *RANGES["time_in_hospital"]),
        })
    if scenario == "concept_drift":
        respiratory = (icd9_group("diag_1") == "respiratory") | (icd9_group("diag_2") == "respiratory")
        logit = (
            F.lit(NEW_RISK["base"]) + NEW_RISK["inpatient"] * F.least(F.col("number_inpatient"), F.lit(3))
            + NEW_RISK["procedures"] * (F.col("num_procedures") >= 3).cast("double")
            + NEW_RISK["respiratory"] * respiratory.cast("double")
            + NEW_RISK["first_stay"] * (F.col("number_inpatient") == 0).cast("double")
        )
        return df.withColumn(TARGET, (u("target") < logistic(logit)).cast("int"))
    raise ValueError(f"unknown scenario: {scenario}")
