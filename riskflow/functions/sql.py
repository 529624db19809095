"""The same scalar functions for SQL users, as temporary SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from riskflow.functions.clinical import CHARLSON_RANGES, ICD9_GROUPS, NUMBER_PATTERN


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create ``icd9_group``, ``charlson_weight``, ``lace_score`` and ``hash_bucket`` in the session."""
    pattern = NUMBER_PATTERN.replace("\\", "\\\\")
    number = f"CASE WHEN code RLIKE '{pattern}' THEN try_cast(code AS double) END"
    groups = " ".join(
        "WHEN {hit} THEN '{name}'".format(
            name=name,
            hit=(f"v BETWEEN {low} AND {high}" if high is not None else f"v >= {low} AND v < {low + 1}")
            + (f" OR v = {single}" if single is not None else ""),
        )
        for name, low, high, single in ICD9_GROUPS
    )
    weights = " ".join(
        f"WHEN v BETWEEN {lo} AND {hi} THEN {w}"
        for lo, hi, w in sorted(CHARLSON_RANGES, key=lambda r: -r[2])
    )
    definitions = {
        "icd9_group": (
            "icd9_group(code string) RETURNS string RETURN SELECT CASE "
            "WHEN code IS NULL OR code IN ('?', '') THEN 'missing' "
            f"WHEN substr(code, 1, 1) IN ('V', 'E') THEN 'other' {groups} ELSE 'other' END "
            f"FROM (SELECT {number} AS v)"
        ),
        "charlson_weight": (
            "charlson_weight(code string) RETURNS int RETURN "
            f"SELECT CASE {weights} ELSE 0 END FROM (SELECT {number} AS v)"
        ),
        "lace_score": (
            "lace_score(stay double, admission_type int, charlson int, emergency double) RETURNS double "
            "RETURN CASE WHEN stay < 1 THEN 0 WHEN stay = 1 THEN 1 WHEN stay = 2 THEN 2 "
            "WHEN stay = 3 THEN 3 WHEN stay <= 6 THEN 4 WHEN stay <= 13 THEN 5 ELSE 7 END "
            "+ CASE WHEN admission_type = 1 THEN 3 ELSE 0 END "
            "+ CASE WHEN charlson >= 4 THEN 5 ELSE charlson END "
            "+ CASE WHEN emergency IS NOT NULL THEN least(emergency, 4D) END"
        ),
        "hash_bucket": (
            "hash_bucket(seed int, key string) RETURNS double RETURN "
            "cast(conv(substring(md5(concat(seed, '-', key)), 1, 8), 16, 10) AS double) / 4294967295D"
        ),
    }
    for body in definitions.values():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")
    return list(definitions)
