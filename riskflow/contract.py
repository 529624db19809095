"""Column lists, the data contract and the record layouts of the logs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---- Fixed values: column names, domains and ranges of the encounter table ----
MED_COLS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride", "acetohexamide",
    "glipizide", "glyburide", "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose", "miglitol",
    "troglitazone", "tolazamide", "examide", "citoglipton", "insulin", "glyburide-metformin",
    "glipizide-metformin", "glimepiride-pioglitazone", "metformin-rosiglitazone",
    "metformin-pioglitazone",
]
CLINICAL_COLS = [
    "race", "gender", "age", "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "time_in_hospital", "medical_specialty", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency", "number_inpatient", "diag_1",
    "diag_2", "diag_3", "number_diagnoses", "max_glu_serum", "A1Cresult", "change", "diabetesMed",
]
INPUT_COLS = sorted(CLINICAL_COLS + MED_COLS)
NUM_COLS = [
    "age_num", "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses", "total_visits",
    "n_med_changes", "n_meds_active",
]
CAT_COLS = [
    "race", "gender", "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "medical_specialty", "diag_1_grp", "diag_2_grp", "diag_3_grp", "max_glu_serum", "A1Cresult",
    "insulin", "metformin", "change", "diabetesMed",
]
RAW_COLS = (
    ["encounter_id", "patient_nbr", "race", "gender", "age", "weight", "admission_type_id",
     "discharge_disposition_id", "admission_source_id", "time_in_hospital", "payer_code",
     "medical_specialty", "num_lab_procedures", "num_procedures", "num_medications",
     "number_outpatient", "number_emergency", "number_inpatient", "diag_1", "diag_2", "diag_3",
     "number_diagnoses", "max_glu_serum", "A1Cresult"]
    + MED_COLS
    + ["change", "diabetesMed", "readmitted"]
)
LAB_COLS = ["max_glu_serum", "A1Cresult"]
CODE_COLS = ["admission_type_id", "discharge_disposition_id", "admission_source_id"]
AGE_BINS = [f"[{a}-{a + 10})" for a in range(0, 100, 10)]
GENDERS = ["Female", "Male", "Unknown/Invalid"]
GLUCOSE = ["None", "Norm", ">200", ">300"]
A1C = ["None", "Norm", ">7", ">8"]
MED_VALUES = ["No", "Steady", "Up", "Down"]
CHANGE = ["No", "Ch"]
YES_NO = ["Yes", "No"]
OUTCOMES = ["<30", ">30", "NO"]
RANGES = {
    "admission_type_id": (1, 8),
    "discharge_disposition_id": (1, 30),
    "admission_source_id": (1, 26),
    "time_in_hospital": (1, 14),
    "num_lab_procedures": (0, 200),
    "num_procedures": (0, 10),
    "num_medications": (0, 100),
    "number_outpatient": (0, 60),
    "number_emergency": (0, 100),
    "number_inpatient": (0, 30),
    "number_diagnoses": (1, 20),
}
NULLABLE = ["race", "medical_specialty", "diag_1", "diag_2", "diag_3", "max_glu_serum", "A1Cresult"]
TARGET = "target"
# -------------------------------------------------------------------------------


@dataclass(frozen=True)
class ColumnRule:
    """What one column must satisfy. ``low``/``high`` are inclusive; ``domain`` lists allowed text."""

    name: str
    type: str
    low: int | None = None
    high: int | None = None
    domain: tuple[str, ...] | None = None
    nullable: bool = False
    unique: bool = False
    # Value for a field that is absent from a request (an explicit null is not absent).
    default: str | None = None
    has_default: bool = False


def _int_rule(name: str, low: int, high: int | None = None, **kw) -> ColumnRule:
    return ColumnRule(name, "bigint", low=low, high=high, **kw)


def _text_rule(name: str, domain: list[str] | None = None, **kw) -> ColumnRule:
    return ColumnRule(name, "string", domain=tuple(domain) if domain else None,
                      nullable=name in NULLABLE, **kw)


_DOMAINS = {"gender": GENDERS, "age": AGE_BINS, "max_glu_serum": GLUCOSE, "A1Cresult": A1C,
            "change": CHANGE, "diabetesMed": YES_NO, "readmitted": OUTCOMES}


def _rule(name: str, **kw) -> ColumnRule:
    if name in RANGES:
        return _int_rule(name, *RANGES[name], **kw)
    return _text_rule(name, _DOMAINS.get(name), **kw)


DATASET_RULES: list[ColumnRule] = (
    [_int_rule("encounter_id", 1, unique=True), _int_rule("patient_nbr", 1)]
    + [_rule(c) for c in CLINICAL_COLS]
    + [_rule("readmitted")]
    + [_text_rule(c, MED_VALUES) for c in MED_COLS]
)

_REQUEST_DEFAULTS = {"max_glu_serum": "None", "A1Cresult": "None", "change": "No", "diabetesMed": "No",
                     "race": None, "medical_specialty": None, "diag_1": None, "diag_2": None, "diag_3": None}


def _request_rule(name: str) -> ColumnRule:
    if name in _REQUEST_DEFAULTS:
        return _rule(name, default=_REQUEST_DEFAULTS[name], has_default=True)
    return _rule(name)


REQUEST_RULES: list[ColumnRule] = (
    [_int_rule("encounter_id", 1)]
    + [_request_rule(c) for c in CLINICAL_COLS]
    + [_text_rule(c, MED_VALUES, default="No", has_default=True) for c in MED_COLS]
)

LABEL_RULES: list[ColumnRule] = [
    _int_rule("encounter_id", 1),
    ColumnRule("readmitted_30d", "boolean"),
]

_INT_COLS = {"encounter_id", "patient_nbr", *RANGES}


def _field(name: str) -> T.StructField:
    return T.StructField(name, T.LongType() if name in _INT_COLS else T.StringType())


RAW_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLS])
ENCOUNTER_SCHEMA = T.StructType([_field(c) for c in RAW_COLS])
SPLIT_SCHEMA = T.StructType(
    [_field(c) for c in RAW_COLS if c != "readmitted"]
    + [T.StructField(TARGET, T.IntegerType()), T.StructField("split", T.StringType())]
)
REQUEST_TEXT_SCHEMA = T.StructType([T.StructField(r.name, T.StringType()) for r in REQUEST_RULES])
FEATURE_STRUCT = T.StructType([_field(r.name) for r in REQUEST_RULES])
PREDICTION_LOG_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("follow_up", T.BooleanType()),
    T.StructField("features", FEATURE_STRUCT),
])
LABEL_LOG_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("encounter_id", T.LongType()),
    T.StructField("readmitted_30d", T.BooleanType()),
])
ALERT_SCHEMA = T.StructType([
    T.StructField("time", T.TimestampType()),
    T.StructField("title", T.StringType()),
    T.StructField("payload", T.StringType()),
])
REQUEST_LOG_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("latency_s", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("follow_up", T.BooleanType()),
    T.StructField("model_version", T.StringType()),
])
