"""Column -> Column functions; all stay inside the JVM."""

from riskflow.functions.clinical import (
    age_mid, age_start, charlson, icd9_group, icd9_number, lace_flag, lace_risk, lace_score,
    n_med_changes, n_meds_active, specialty_group, total_visits,
    with_lace,
)
from riskflow.functions.hashing import hash_bucket, hash_uniform, logistic
from riskflow.functions.once import compute_once
from riskflow.functions.sql import register_sql_functions

__all__ = [
    "age_mid", "age_start", "charlson", "compute_once", "hash_bucket", "hash_uniform", "icd9_group", "icd9_number",
    "lace_flag", "lace_risk", "lace_score", "logistic", "n_med_changes", "n_meds_active",
    "register_sql_functions", "specialty_group", "total_visits", "with_lace",
]
