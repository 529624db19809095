"""Encounter, log and request views derived from the test tables, all rows of them.

The column expressions are SQL text; ``encounter_sql`` renders them with an array lookup for Spark
or with ``split_part`` for other engines, so a check in another engine starts from the same inputs.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import contract as C
from riskflow.functions import hash_bucket, with_lace
from riskflow.functions.clinical import LACE_FLAG_AT, LACE_MAX
from riskflow.operators.history import visit_sequence
from riskflow.operators.joins import sorted_side
from riskflow.session import settle, shared_dir
from riskflow.sources.datagen import DIAGNOSIS_POOL

PERIOD_CUT = "1999-01-01"
RETRAIN_CUT = "2000-01-01"


def _pick(values: list[str], index: str) -> str:
    return "pick{" + ";".join(values) + "}" + f"[{index}]"


def _render(sql: str, portable: bool) -> str:
    match = re.fullmatch(r"pick\{(.*)\}\[(.*)\]", sql)
    if not match:
        return sql
    values, index = match.groups()
    if portable:
        return f"split_part('{values}', ';', cast({index} as int))"
    # A constant array is built once; splitting text would be repeated for every row.
    return "element_at(array({}), cast({} as int))".format(
        ", ".join(f"'{v}'" for v in values.split(";")), index
    )


def encounter_sql(portable: bool = False) -> dict[str, str]:
    return {name: _render(sql, portable) for name, sql in ENCOUNTER_SQL.items()}


_SPECIALTIES = ["?", "?", "?", "InternalMedicine", "Cardiology", "Nephrology", "Urology"]

# Inputs: k = order key, c = customer key, seg = market segment, n_lines, qty, n_ret per order.
ENCOUNTER_SQL = {
    "encounter_id": "k + 1",
    "patient_nbr": "c + 1",
    "race": "case seg when 'AUTOMOBILE' then 'Caucasian' when 'BUILDING' then 'AfricanAmerican' "
            "when 'FURNITURE' then 'Hispanic' when 'MACHINERY' then 'Asian' else '?' end",
    "gender": "case when c % 2 = 0 then 'Female' else 'Male' end",
    "age": _pick(C.AGE_BINS, "1 + (c * 7) % 10"),
    "admission_type_id": "1 + k % 8",
    "discharge_disposition_id": "1 + (k * 11) % 30",
    "admission_source_id": "1 + (k * 5) % 26",
    "time_in_hospital": "1 + qty % 14",
    "medical_specialty": _pick(_SPECIALTIES, "1 + (k * 3) % 7"),
    "num_lab_procedures": "qty % 132",
    "num_procedures": "n_lines % 7",
    "num_medications": "1 + qty % 81",
    "number_outpatient": "n_ret",
    "number_emergency": "k % 5",
    "number_inpatient": "cast((seq - 1) % 30 as bigint)",
    "diag_1": _pick(DIAGNOSIS_POOL, "1 + (k * 7) % 12"),
    "diag_2": _pick(DIAGNOSIS_POOL, "1 + (k * 5 + 3) % 12"),
    "diag_3": _pick(DIAGNOSIS_POOL, "1 + (k * 11 + 6) % 12"),
    "number_diagnoses": "1 + n_lines % 16",
    "max_glu_serum": _pick(["None", "None", "Norm", ">200", ">300"], "1 + k % 5"),
    "A1Cresult": _pick(["None", "None", "Norm", ">7", ">8"], "1 + (k * 3) % 5"),
    **{
        med: _pick(["No"] * 7 + ["Steady", "Up", "Down"], f"1 + (k * {2 * j + 3} + {j}) % 10")
        for j, med in enumerate(C.MED_COLS)
    },
    "change": "case when k % 2 = 0 then 'No' else 'Ch' end",
    "diabetesMed": "case when k % 4 = 0 then 'No' else 'Yes' end",
    "readmitted": "case when next_ts is null then 'NO' "
                  "when next_ts <= ts + interval '30' day then '<30' else '>30' end",
    "discharge_ts": "ts",
}

# Faults planted into the text form of the table, by encounter: (column, condition on encounter_id, text).
FAULTS = [
    ("time_in_hospital", "encounter_id % 101 = 0", "'99'"),
    ("gender", "encounter_id % 103 = 0", "'X'"),
    ("age", "encounter_id % 107 = 0", "'seventy'"),
    ("num_medications", "encounter_id % 109 = 0", "'many'"),
    ("insulin", "encounter_id % 113 = 0", "'Maybe'"),
    ("number_inpatient", "encounter_id % 131 = 0", "null"),
    ("race", "encounter_id % 137 = 0", "null"),
    ("A1Cresult", "encounter_id % 139 = 0", "null"),
    ("diag_1", "encounter_id % 149 = 0", "'785.4'"),
    ("encounter_id", "encounter_id % 127 = 0", "cast(encounter_id + 1 as {text})"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    settle(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def encounter_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One encounter per order: 48 contract columns and ``discharge_ts``."""
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    )
    customers = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("c"), F.col("c_mktsegment").alias("seg")
    )
    lines = (
        _table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"))
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("l_quantity").cast("bigint").alias("qty"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_ret"),
        )
    )
    visits = visit_sequence(orders, "c", "ts", "k").join(sorted_side(customers), "c").join(sorted_side(lines), "k", "left")
    zeros = {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("n_lines", "qty", "n_ret")}
    return visits.withColumns(zeros).select(
        *[F.expr(sql).alias(name) for name, sql in encounter_sql().items()]
    )


_TABLES: dict[tuple[str, str], tuple[str, T.StructType]] = {}


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encounter table: the view, written to the shared folder once per session and source.

    Operators start from a stored encounter table, so this is one, with columns to prune and filters
    to push down. All encounters are in it.
    """
    settle(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TABLES:
        view = encounter_view(spark, sf_dir)
        path = f"{shared_dir(spark)}/riskflow-encounters-{uuid.uuid4().hex}"
        view.write.parquet(path)
        _TABLES[key] = (path, view.schema)
    path, schema = _TABLES[key]
    return spark.read.schema(schema).parquet(path)


def faulty_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encounter table as text, with known faults: bad values, nulls and repeated ids."""
    planted = {c: f"case when {when} then {value.format(text='string')} else cast(`{c}` as string) end"
               for c, when, value in FAULTS}
    rows = encounters(spark, sf_dir)
    return rows.select(
        *[F.expr(planted.get(c, f"cast(`{c}` as string)")).alias(c) for c in rows.columns if c != "discharge_ts"]
    )


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests as JSON text. Drugs at ``No`` are left out of odd encounters, and some
    requests carry the planted faults or an explicit null for a drug."""
    rows = encounters(spark, sf_dir)
    planted = {c: (when, value) for c, when, value in FAULTS if c not in ("encounter_id", "race", "A1Cresult")}
    fields = []
    for rule in C.REQUEST_RULES:
        name = rule.name
        value = F.col(f"`{name}`").cast("string")
        if name in planted:
            when, text = planted[name]
            value = F.when(F.expr(when), F.expr(text).cast("string")).otherwise(value)
        if name in C.MED_COLS and name != "insulin":
            value = F.when((F.col("encounter_id") % 2 == 1) & (value == "No"), None).otherwise(value)
        fields.append(value.alias(name))
    line = F.to_json(F.struct(*fields))
    nulled = F.regexp_replace(line, r"^\{", '{"metformin":null,')
    return rows.select(
        "encounter_id",
        F.when((F.col("encounter_id") % 151 == 0) & (F.col("encounter_id") % 2 == 1)
               & (F.col("metformin") == "No"), nulled).otherwise(line).alias("line"),
    )


def scored_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All encounters with a label and two scores: the rule index, and one with near-unique values."""
    return with_lace(encounters(spark, sf_dir)).select(
        "encounter_id", "patient_nbr", "gender", "race", "age", "discharge_ts",
        (F.col("readmitted") == "<30").cast("int").alias("target"),
        (F.col("lace") / F.lit(float(LACE_MAX))).alias("lace"),
        ((F.col("lace") + hash_bucket("encounter_id", 7)) / F.lit(LACE_MAX + 1.0)).alias("blend"),
    )


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per encounter, and a repeated one an hour later for every 40th."""
    rows = with_lace(encounters(spark, sf_dir)).withColumns({
        "score": (F.col("lace") + hash_bucket("encounter_id", 7)) / F.lit(LACE_MAX + 1.0),
        "again": F.explode(F.when(F.col("encounter_id") % 40 == 0, F.array(F.lit(0), F.lit(1)))
                           .otherwise(F.array(F.lit(0)))),
    })
    return rows.select(
        (F.col("discharge_ts") + F.expr("make_dt_interval(0, again)")).alias("ts"),
        F.concat_ws("-", F.lit("r"), "encounter_id", "again").alias("request_id"),
        F.when(F.col("discharge_ts") < PERIOD_CUT, "v1").otherwise("v2").alias("model_version"),
        "score",
        (F.col("score") >= F.lit(LACE_FLAG_AT / LACE_MAX)).alias("follow_up"),
        F.struct(*[F.col(f"`{r.name}`") for r in C.REQUEST_RULES]).alias("features"),
    )


def label_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes 30 days after discharge, with a later correction for every 50th encounter."""
    rows = encounters(spark, sf_dir).select(
        "encounter_id", "discharge_ts", (F.col("readmitted") == "<30").alias("label"),
        F.explode(F.when(F.col("encounter_id") % 50 == 0, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("again"),
    )
    return rows.select(
        (F.col("discharge_ts") + F.expr("make_dt_interval(30 + again)")).alias("ts"),
        "encounter_id",
        F.when(F.col("again") == 1, ~F.col("label")).otherwise(F.col("label")).alias("readmitted_30d"),
    )


REQUEST_LOG_SQL = {
    "endpoint": "case event_type when 'view' then '/predict/batch' when 'purchase' then '/feedback' "
                "else '/predict' end",
    "status": "case when event_type = 'error' and user_id % 2 = 1 then 500 "
              "when event_type = 'error' then 422 else 200 end",
    "latency_s": "value / 1000",
    "score": "least(value / 500, 1)",
    "follow_up": "least(value / 500, 1) >= 0.9",
    "model_version": "case when ts < timestamp '2024-01-15 00:00:00' then 'v1' else 'v2' end",
}


def request_log_of(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp")).select(
        "ts", *[F.expr(sql).alias(name) for name, sql in REQUEST_LOG_SQL.items()]
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API request telemetry, one row per event."""
    return request_log_of(_table(spark, sf_dir, "events"))
