"""Diagnosis groups, comorbidity weights, the rule-based risk index and small clinical counts."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.contract import MED_COLS
from riskflow.functions.once import compute_once

# ---- Fixed values ----
# ICD-9 groups by organ system, first match wins: (group, low, high, extra single code).
ICD9_GROUPS = [
    ("circulatory", 390, 459, 785),
    ("respiratory", 460, 519, 786),
    ("digestive", 520, 579, 787),
    ("diabetes", 250, None, None),
    ("injury", 800, 999, None),
    ("musculoskeletal", 710, 739, None),
    ("genitourinary", 580, 629, 788),
    ("neoplasms", 140, 239, None),
]
# Charlson weights by ICD-9 range, ends included: (low, high, weight).
CHARLSON_RANGES = [
    (410, 412.99, 1), (428, 428.99, 1), (440, 443.99, 1), (430, 438.99, 1), (290, 290.99, 1),
    (490, 496.99, 1), (710, 714.99, 1), (531, 534.99, 1), (571, 571.99, 1), (250, 250.39, 1),
    (250.4, 250.99, 2), (342, 344.99, 2), (582, 586.99, 2), (140, 195.99, 2), (200, 208.99, 2),
    (196, 199.99, 6), (42, 44.99, 6),
]
TOP_SPECIALTIES = [
    "InternalMedicine", "Emergency/Trauma", "Family/GeneralPractice", "Cardiology",
    "Surgery-General", "Nephrology", "Orthopedics", "Radiologist", "Pulmonology",
]
LACE_MAX = 19
LACE_FLAG_AT = 10
# Decimal text; a plain cast would also take "4d", "nan" and "inf".
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
AGE_PATTERN = r"\[(\d+)-"
# ----------------------


def col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def icd9_number(code: Column | str) -> Column:
    """The numeric value of a diagnosis code, null for V/E codes, ``?`` and other text."""
    c = col(code).cast("string")
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def icd9_group(code: Column | str, number: Column | None = None) -> Column:
    """One of ten diagnosis groups.

    Pass ``number`` when the caller has already projected ``icd9_number(code)``: the parsed value is
    read by every branch, and a column of an earlier projection is computed once.
    """
    c = col(code).cast("string")
    v = icd9_number(code) if number is None else number
    out = F.when(c.isNull() | c.isin("?", ""), F.lit("missing"))
    out = out.when(c.substr(1, 1).isin("V", "E"), F.lit("other"))
    for name, low, high, single in ICD9_GROUPS:
        hit = v.between(low, high) if high is not None else (v >= low) & (v < low + 1)
        out = out.when(hit if single is None else hit | (v == single), F.lit(name))
    return out.otherwise(F.lit("other"))


def charlson_weight(number: Column) -> Column:
    """Largest weight among the ranges that hold the code, 0 outside all of them."""
    out = None
    for weight in sorted({w for _, _, w in CHARLSON_RANGES}, reverse=True):
        hit = reduce(or_, [number.between(lo, hi) for lo, hi, w in CHARLSON_RANGES if w == weight])
        out = F.when(hit, weight) if out is None else out.when(hit, weight)
    return out.otherwise(0)


def charlson(*codes: Column | str, numbers: list[Column] | None = None) -> Column:
    """Sum over the diagnosis fields; a condition named twice counts twice.

    Without ``numbers`` (see ``icd9_group``) each code is parsed once, as an array element.
    """
    if numbers is not None:
        return reduce(add, [charlson_weight(n) for n in numbers])
    parsed = F.array(*[icd9_number(c) for c in codes])
    return F.aggregate(parsed, F.lit(0), lambda total, v: total + charlson_weight(v))


def lace_score(
    stay: Column | str = "time_in_hospital",
    admission_type: Column | str = "admission_type_id",
    diagnoses: tuple = ("diag_1", "diag_2", "diag_3"),
    emergency: Column | str = "number_emergency",
    numbers: list[Column] | None = None,
) -> Column:
    """Length of stay + acute admission + comorbidity + emergency visits, 0..19."""
    los = col(stay).try_cast("double")
    length = (
        F.when(los < 1, 0).when(los == 1, 1).when(los == 2, 2).when(los == 3, 3)
        .when(los <= 6, 4).when(los <= 13, 5).otherwise(7)
    )
    acute = F.when(col(admission_type).try_cast("double") == 1, 3).otherwise(0)
    if numbers is None:
        # The cap as the closing step of the sum, which then is evaluated once.
        parsed = F.array(*[icd9_number(c) for c in diagnoses])
        capped = F.aggregate(
            parsed, F.lit(0), lambda total, v: total + charlson_weight(v),
            lambda total: F.when(total >= 4, 5).otherwise(total),
        )
    else:
        comorbidity = charlson(numbers=numbers)
        capped = F.when(comorbidity >= 4, 5).otherwise(comorbidity)
    visits = col(emergency).try_cast("double")
    # least() skips nulls, and an unknown visit count must leave the score unknown.
    visits = F.when(visits.isNotNull(), F.least(visits, F.lit(4.0)))
    return (length + acute + capped + visits).cast("double")


def lace_risk(score: Column | str) -> Column:
    s = col(score) / F.lit(float(LACE_MAX))
    return F.when(s.isNotNull(), F.greatest(F.lit(0.0), F.least(s, F.lit(1.0))))


def lace_flag(score: Column | str) -> Column:
    return (lace_risk(score) >= F.lit(LACE_FLAG_AT / LACE_MAX)).cast("int")


def with_lace(df: DataFrame, name: str = "lace") -> DataFrame:
    """Add the index. Each code is parsed once, so that the ranges compare plain numbers."""
    parsed = {f"_icd_{i}": icd9_number(f"diag_{i}") for i in (1, 2, 3)}
    scored = compute_once(df, parsed).withColumn(name, lace_score(numbers=[F.col(c) for c in parsed]))
    return scored.drop(*parsed)


def age_start(age: Column | str = "age") -> Column:
    text = F.regexp_extract(col(age).cast("string"), AGE_PATTERN, 1)
    return F.nullif(text, F.lit("")).try_cast("double")


def age_mid(age: Column | str = "age") -> Column:
    return age_start(age) + 5


def total_visits(*parts: Column | str) -> Column:
    cols = parts or ("number_outpatient", "number_emergency", "number_inpatient")
    return reduce(add, [F.coalesce(col(c).try_cast("double"), F.lit(0.0)) for c in cols])


def _count_in(cols: list[str], values: list[str]) -> Column:
    return reduce(add, [F.coalesce(col(c).isin(*values), F.lit(False)).cast("int") for c in cols])


def n_med_changes(cols: list[str] | None = None) -> Column:
    return _count_in(cols or MED_COLS, ["Up", "Down"])


def n_meds_active(cols: list[str] | None = None) -> Column:
    return _count_in(cols or MED_COLS, ["Steady", "Up", "Down"])


def specialty_group(specialty: Column | str = "medical_specialty") -> Column:
    """The nine frequent specialties; everything else, null included, is ``Other``."""
    return F.when(col(specialty).isin(*TOP_SPECIALTIES), col(specialty)).otherwise(F.lit("Other"))
