"""The catalogue's queries as DuckDB SQL, written independently of the Spark operators.

Only the definition of the test views, the data contract and fixed tables are shared with the library.
"""

from __future__ import annotations

import json
import math

from riskflow import contract as C
from riskflow.functions.clinical import CHARLSON_RANGES, ICD9_GROUPS, TOP_SPECIALTIES
from riskflow.operators.telemetry import ALERTS, LATENCY_EDGES, SCORE_EDGES
from riskflow.params import Params
from riskflow.sources import derived
from riskflow.sources.datagen import NEW_RISK

P = Params()
SCORES = ("lace", "blend")


def q(name: str) -> str:
    return f'"{name}"'


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def among(column: str, values) -> str:
    return f"{column} IN ({', '.join(text(v) if isinstance(v, str) else str(v) for v in values)})"


def bucket(key: str, seed: int = P.seed) -> str:
    return f"('0x'||substr(md5('{seed}-'||cast({key} AS varchar)),1,8))::bigint::double/4294967295"


def uniform(name: str, seed: int = 7) -> str:
    return f"('0x'||substr(md5('{seed}|{name}|'||cast(encounter_id AS varchar)),1,8))::bigint::double/4294967296"


def icd9(code: str) -> str:
    v = f"try_cast({code} AS double)"
    whens = []
    for name, low, high, single in ICD9_GROUPS:
        hit = f"{v} BETWEEN {low} AND {high}" if high is not None else f"floor({v}) = {low}"
        whens.append(f"WHEN {hit}" + (f" OR {v} = {single}" if single else "") + f" THEN '{name}'")
    return (f"CASE WHEN {code} IS NULL OR {code} IN ('?', '') THEN 'missing' "
            f"WHEN substr({code},1,1) IN ('V','E') THEN 'other' {' '.join(whens)} ELSE 'other' END")


def charlson() -> str:
    parts = []
    for i in (1, 2, 3):
        v = f"try_cast(diag_{i} AS double)"
        hits = ", ".join(f"CASE WHEN {v} BETWEEN {lo} AND {hi} THEN {w} ELSE 0 END" for lo, hi, w in CHARLSON_RANGES)
        parts.append(f"greatest({hits})")
    return "(" + " + ".join(parts) + ")"


# ---- test views --------------------------------------------------------------------------------

ENC = f"""
l AS (SELECT l_orderkey AS k, count(*) AS n_lines, cast(sum(l_quantity) AS bigint) AS qty,
        count(*) FILTER (WHERE l_returnflag = 'R') AS n_ret FROM lineitem GROUP BY l_orderkey),
visits AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS ts,
        row_number() OVER w AS seq, lead(o_orderdate) OVER w AS next_ts
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
base AS (SELECT visits.*, c_mktsegment AS seg, coalesce(n_lines, 0) AS n_lines, coalesce(qty, 0) AS qty,
        coalesce(n_ret, 0) AS n_ret FROM visits JOIN customer ON c_custkey = c LEFT JOIN l USING (k)),
enc AS MATERIALIZED (SELECT {', '.join(f'{sql} AS {q(name)}' for name, sql in derived.encounter_sql(portable=True).items())} FROM base)"""

_PLANTED = {c: f"CASE WHEN {when} THEN {value.format(text='varchar')} ELSE cast({q(c)} AS varchar) END"
            for c, when, value in derived.FAULTS}
_ENC_COLS = [c for c in derived.ENCOUNTER_SQL if c != "discharge_ts"]
FENC = ENC + f""",
fenc AS MATERIALIZED (SELECT {', '.join(f"{_PLANTED.get(c, f'cast({q(c)} AS varchar)')} AS {q(c)}" for c in _ENC_COLS)} FROM enc)"""


def split_case(key: str = "patient_nbr") -> str:
    b = bucket(key)
    return (f"CASE WHEN {b} < cast({P.test_size} AS double) THEN 'test' "
            f"WHEN {b} < cast({P.test_size + P.val_size} AS double) THEN 'val' ELSE 'train' END")


LACE_SQL = f"""(CASE WHEN time_in_hospital < 1 THEN 0 WHEN time_in_hospital = 1 THEN 1 WHEN time_in_hospital = 2 THEN 2
  WHEN time_in_hospital = 3 THEN 3 WHEN time_in_hospital <= 6 THEN 4 WHEN time_in_hospital <= 13 THEN 5 ELSE 7 END
  + CASE WHEN admission_type_id = 1 THEN 3 ELSE 0 END
  + CASE WHEN {charlson()} >= 4 THEN 5 ELSE {charlson()} END
  + least(number_emergency, 4))::double"""

LABELLED = ENC + f""",
labelled AS MATERIALIZED (SELECT *, cast(readmitted = '<30' AS bigint) AS target, {split_case()} AS split
    FROM enc WHERE NOT {among('discharge_disposition_id', P.exclude_discharge_ids)})"""

SCORED = ENC + f""",
raw_scores AS MATERIALIZED (SELECT encounter_id, patient_nbr, gender, race, age, discharge_ts,
        cast(readmitted = '<30' AS bigint) AS target, {LACE_SQL} AS lace_points,
        {bucket('encounter_id', 7)} AS jitter FROM enc),
scores AS MATERIALIZED (SELECT * EXCLUDE (lace_points, jitter), lace_points / 19.0::double AS lace,
        (lace_points + jitter) / 20.0::double AS blend FROM raw_scores),
sc AS MATERIALIZED (SELECT 'lace' AS model, lace AS score, * EXCLUDE (lace, blend) FROM scores
       UNION ALL SELECT 'blend', blend, * EXCLUDE (lace, blend) FROM scores)"""


def features(table: str, out: str, keep: str, rows: str = "TRUE") -> str:
    """The 27 features of an encounter table (typed or text)."""
    def t(c: str) -> str:
        return f"nullif(cast({q(c)} AS varchar), '?')"

    def n(c: str) -> str:
        return f"try_cast(cast({q(c)} AS varchar) AS double)"

    def count(values) -> str:
        return " + ".join(f"CASE WHEN {among(q(m), values)} THEN 1 ELSE 0 END" for m in C.MED_COLS)

    numeric = {
        "age_num": "try_cast(nullif(regexp_extract(age, '\\[(\\d+)-', 1), '') AS double) + 5",
        "total_visits": " + ".join(f"coalesce({n(c)}, 0)" for c in ("number_outpatient", "number_emergency", "number_inpatient")),
        "n_med_changes": f"cast({count(['Up', 'Down'])} AS double)",
        "n_meds_active": f"cast({count(['Steady', 'Up', 'Down'])} AS double)",
    }
    categorical = {
        "medical_specialty": f"CASE WHEN {among('medical_specialty', TOP_SPECIALTIES)} THEN medical_specialty ELSE 'Other' END",
        **{f"diag_{i}_grp": icd9(f"cast(diag_{i} AS varchar)") for i in (1, 2, 3)},
        **{c: f"cast(try_cast({q(c)} AS bigint) AS varchar)" for c in C.CODE_COLS},
        **{c: f"coalesce({t(c)}, 'None')" for c in C.LAB_COLS},
    }
    cols = [f"{numeric.get(c, n(c))} AS {q(c)}" for c in C.NUM_COLS]
    cols += [f"{categorical.get(c, t(c))} AS {q(c)}" for c in C.CAT_COLS]
    return f"{out} AS MATERIALIZED (SELECT {keep}, {', '.join(cols)} FROM {table} WHERE {rows})"


def longer(table: str, cols: list[str], keep: str = "", where: str = "TRUE") -> str:
    extra = keep + ", " if keep else ""
    return " UNION ALL ".join(f"SELECT {extra}'{c}' AS feature, {q(c)} AS v FROM {table} WHERE {where}" for c in cols)


def fitted(table: str, where: str, p: str = "") -> str:
    """CTEs with medians, clip bounds and scale of the 12 numeric features."""
    return f"""
{p}nlong AS MATERIALIZED ({longer(table, C.NUM_COLS, where=where)}),
{p}med AS (SELECT feature, quantile_cont(v, 0.5) AS median FROM {p}nlong GROUP BY feature),
{p}filled AS MATERIALIZED (SELECT feature, coalesce(v, median) AS v FROM {p}nlong JOIN {p}med USING (feature)),
{p}clip AS (SELECT feature, quantile_cont(v, 0.005) AS low, quantile_cont(v, 0.995) AS high FROM {p}filled GROUP BY feature),
{p}scale AS (SELECT feature, avg(c) AS mean, CASE WHEN stddev_pop(c) > 0 THEN stddev_pop(c) ELSE 1 END AS std
    FROM (SELECT feature, greatest(least(v, high), low) AS c FROM {p}filled JOIN {p}clip USING (feature)) GROUP BY feature)"""


def vocab(table: str, where: str, p: str = "") -> str:
    return f"""
{p}clong AS MATERIALIZED ({longer(table, C.CAT_COLS, where=where)}),
{p}vocab AS (SELECT feature, coalesce(v, 'missing') AS category, count(*) AS n, count(*) >= 20 AS frequent
    FROM {p}clong GROUP BY 1, 2)"""


# ---- metrics -----------------------------------------------------------------------------------

CURVE = """
counts AS (SELECT model, score, count(*) AS n, cast(sum(target) AS bigint) AS pos FROM sc GROUP BY model, score),
curve AS MATERIALIZED (SELECT *, cast(sum(n) OVER w AS bigint) AS cum_n, cast(sum(pos) OVER w AS bigint) AS cum_pos
    FROM counts WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
ap AS (SELECT model, sum(pos * (cum_pos::double / cum_n)) / sum(pos) AS pr_auc,
        sum((n - pos) * (cum_pos - pos + pos / 2.0::double)) / (sum(pos)::double * sum(n - pos)) AS roc_auc
    FROM curve GROUP BY model),
br AS (SELECT model, avg((score - target) * (score - target)) AS brier FROM sc GROUP BY model)"""

TOPK = f"""
ranked AS (SELECT model, target, row_number() OVER (PARTITION BY model ORDER BY score DESC, encounter_id) AS rk,
        count(*) OVER (PARTITION BY model) AS n FROM sc),
topk AS (SELECT model, max(greatest(1, cast(floor(n * {P.top_k_frac}::double) AS bigint))) AS k,
        cast(sum(target) FILTER (WHERE rk <= greatest(1, cast(floor(n * {P.top_k_frac}::double) AS bigint))) AS bigint) AS tp,
        sum(target) AS n_pos FROM ranked GROUP BY model)"""

_DIMS = {
    "gender": "coalesce(gender, 'missing')",
    "race": "coalesce(nullif(race, '?'), 'missing')",
    "age60": "CASE WHEN try_cast(regexp_extract(age, '\\[(\\d+)-', 1) AS double) >= 60 THEN '>=60' ELSE '<60' END",
}
GROUPS = f"""
lim AS (SELECT model, quantile_cont(score, {1 - P.top_k_frac}) AS threshold FROM sc GROUP BY model),
flagged AS (SELECT sc.*, (score >= threshold) AS flagged FROM sc JOIN lim USING (model)),
dims AS ({' UNION ALL '.join(f"SELECT model, '{d}' AS dim, {sql} AS value, target, flagged FROM flagged" for d, sql in _DIMS.items())}),
grp AS (SELECT model, dim, value, cast(sum(target) AS bigint) AS n_positive,
        avg(CASE WHEN flagged THEN 1.0::double ELSE 0 END) FILTER (WHERE target = 1) AS recall FROM dims GROUP BY 1, 2, 3),
judged AS (SELECT *, value NOT IN ('missing', 'Unknown/Invalid') AND n_positive >= {P.min_group_positives} AS used FROM grp),
gaps AS (SELECT model, {', '.join(f"coalesce(max(recall) FILTER (WHERE used AND dim = '{d}') - min(recall) FILTER (WHERE used AND dim = '{d}'), 0) AS {d}" for d in _DIMS)}
    FROM judged GROUP BY model)"""

BUNDLE = f"""{CURVE},{TOPK},{GROUPS},
wide AS (SELECT model, round(pr_auc, 5) AS pr_auc, round(roc_auc, 5) AS roc_auc, round(brier, 5) AS brier,
        round(tp::double / greatest(n_pos, 1), 5) AS recall_at_k, round(tp::double / k, 5) AS precision_at_k,
        round(greatest(gender, race), 5) AS fairness_gap, round(age60, 5) AS age_recall_gap
    FROM ap JOIN br USING (model) JOIN topk USING (model) JOIN gaps USING (model)),
metrics AS (SELECT * FROM wide UNPIVOT (value FOR metric IN
    (pr_auc, roc_auc, brier, recall_at_k, precision_at_k, fairness_gap, age_recall_gap)))"""

GATE = f"""{BUNDLE},
cand AS (SELECT metric, value FROM metrics WHERE model = 'blend'),
base_m AS (SELECT metric, value FROM metrics WHERE model = 'lace'),
checks AS (
 SELECT 'pr_auc_min' AS "check", 'pr_auc' AS metric, value, {P.min_pr_auc}::double AS "limit", value >= {P.min_pr_auc} AS passed FROM cand WHERE metric = 'pr_auc'
 UNION ALL SELECT 'beats_baseline', 'pr_auc', c.value, b.value + {P.min_gain_over_baseline}::double, c.value >= b.value + {P.min_gain_over_baseline}::double
   FROM cand c JOIN base_m b USING (metric) WHERE metric = 'pr_auc'
 UNION ALL SELECT 'not_worse_than_champion', 'pr_auc', c.value, b.value - {P.max_regression_vs_champion}::double, c.value >= b.value - {P.max_regression_vs_champion}::double
   FROM cand c JOIN base_m b USING (metric) WHERE metric = 'pr_auc'
 UNION ALL SELECT 'brier_max', 'brier', value, {P.max_brier}::double, value <= {P.max_brier} FROM cand WHERE metric = 'brier'
 UNION ALL SELECT 'fairness_gap_max', 'fairness_gap', value, {P.max_fairness_gap}::double, value <= {P.max_fairness_gap} FROM cand WHERE metric = 'fairness_gap')"""


# ---- drift -------------------------------------------------------------------------------------

_PROBS = "[" + ", ".join(f"{i / 10}::double" for i in range(11)) + "]"


def psi_values(long: str, out: str) -> str:
    """PSI per feature from (side, feature, v): bins by reference deciles, open at both ends."""
    return f"""
{out}_edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, {_PROBS}))) AS e FROM {long} WHERE side = 'ref' AND v IS NOT NULL GROUP BY feature),
{out}_binned AS (SELECT side, feature, len(list_filter(list_slice(e, 2, len(e) - 1), lambda x: v >= x)) AS b, count(*) AS n
    FROM {long} JOIN {out}_edges USING (feature) WHERE v IS NOT NULL GROUP BY 1, 2, 3),
{out}_share AS (SELECT feature, b, greatest(coalesce(sum(n) FILTER (WHERE side = 'ref'), 0) / max(rt), 1e-4) AS r,
        greatest(coalesce(sum(n) FILTER (WHERE side = 'cur'), 0) / max(ct), 1e-4) AS c
    FROM {out}_binned JOIN (SELECT feature, sum(n) FILTER (WHERE side = 'ref')::double AS rt, sum(n) FILTER (WHERE side = 'cur')::double AS ct
        FROM {out}_binned GROUP BY feature) USING (feature) GROUP BY 1, 2),
{out} AS (SELECT feature, max(len(e)) - 1 AS bins, sum((c - r) * ln(c / r)) AS psi FROM {out}_share JOIN {out}_edges USING (feature) GROUP BY feature)"""


def psi_categories(long: str, out: str) -> str:
    return f"""
{out}_n AS (SELECT side, feature, coalesce(v, 'missing') AS b, count(*) AS n FROM {long} GROUP BY 1, 2, 3),
{out}_share AS (SELECT feature, b, greatest(coalesce(sum(n) FILTER (WHERE side = 'ref'), 0) / max(rt), 1e-4) AS r,
        greatest(coalesce(sum(n) FILTER (WHERE side = 'cur'), 0) / max(ct), 1e-4) AS c
    FROM {out}_n JOIN (SELECT feature, sum(n) FILTER (WHERE side = 'ref')::double AS rt, sum(n) FILTER (WHERE side = 'cur')::double AS ct
        FROM {out}_n GROUP BY feature) USING (feature) GROUP BY 1, 2),
{out} AS (SELECT feature, count(*) AS bins, sum((c - r) * ln(c / r)) AS psi FROM {out}_share GROUP BY feature)"""


def psi_all(table: str, p: str = "") -> str:
    """CTEs {p}num, {p}cat and {p}psi from a feature table with a ``side`` column."""
    return f"""
{p}nl AS MATERIALIZED ({longer(table, C.NUM_COLS, 'side')}),
{p}cl AS MATERIALIZED ({longer(table, C.CAT_COLS, 'side')}),{psi_values(p + 'nl', p + 'num')},{psi_categories(p + 'cl', p + 'cat')},
{p}psi AS MATERIALIZED (SELECT feature, round(psi, 4) AS psi FROM {p}num UNION ALL SELECT feature, round(psi, 4) FROM {p}cat),
{p}summary AS (SELECT count(*) AS n_features, count(*) FILTER (WHERE psi >= {P.psi_threshold}) AS n_drifted, max(psi) AS max_feature_psi FROM {p}psi)"""


_SIDE = f"CASE WHEN discharge_ts < timestamp '{derived.PERIOD_CUT}' THEN 'ref' ELSE 'cur' END AS side"
PERIODS = ENC + "," + features("enc", "feat", _SIDE) + "," + psi_all("feat")
SUMMARY_COLS = (f"n_features, n_drifted, round(max_feature_psi, 6) AS max_feature_psi, round(n_drifted / n_features::double, 6) AS drift_share, "
                f"n_drifted / n_features::double >= {P.drift_share_threshold} AS data_drift")

_FIELDS = [r.name for r in C.REQUEST_RULES]
LOGS = SCORED + f""",
plog AS MATERIALIZED (SELECT discharge_ts + again * interval '1' hour AS ts, 'r-' || encounter_id || '-' || again AS request_id,
        CASE WHEN discharge_ts < timestamp '{derived.PERIOD_CUT}' THEN 'v1' ELSE 'v2' END AS model_version, blend AS score,
        {', '.join('enc.' + q(f) for f in _FIELDS)}
    FROM enc JOIN (SELECT encounter_id, blend FROM scores) USING (encounter_id)
    JOIN (SELECT encounter_id, unnest(CASE WHEN encounter_id % 40 = 0 THEN [0, 1] ELSE [0] END) AS again FROM enc) USING (encounter_id)),
llog AS MATERIALIZED (SELECT discharge_ts + (30 + again) * interval '1' day AS ts, encounter_id,
        CASE WHEN again = 1 THEN readmitted <> '<30' ELSE readmitted = '<30' END AS readmitted_30d
    FROM enc JOIN (SELECT encounter_id, unnest(CASE WHEN encounter_id % 50 = 0 THEN [0, 1] ELSE [0] END) AS again FROM enc) USING (encounter_id)),
latest AS MATERIALIZED (SELECT * FROM llog QUALIFY row_number() OVER (PARTITION BY encounter_id ORDER BY ts DESC, readmitted_30d DESC) = 1),
live AS MATERIALIZED (SELECT plog.*, readmitted_30d FROM plog JOIN (SELECT encounter_id, readmitted_30d FROM latest) USING (encounter_id))"""


def auc(table: str, score: str, target: str, out: str) -> str:
    return f"""
{out}_c AS (SELECT {score} AS s, count(*) AS n, sum(cast({target} AS int)) AS pos FROM {table} GROUP BY 1),
{out}_w AS (SELECT *, sum(n) OVER w AS cn, sum(pos) OVER w AS cp FROM {out}_c WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
{out} AS (SELECT sum(n)::bigint AS n_rows, sum(pos)::bigint AS n_pos, sum(pos * (cp::double / cn)) / sum(pos) AS pr_auc,
        sum((n - pos) * (cp - pos + pos / 2.0::double)) / (sum(pos)::double * sum(n - pos)) AS roc_auc,
        sum(pos) / sum(n)::double AS pos_rate FROM {out}_w)"""


def concept(live: str, score: str, target: str) -> str:
    return f"""
refrows AS (SELECT blend AS score, target FROM scores WHERE discharge_ts < timestamp '{derived.PERIOD_CUT}'),{auc('refrows', 'score', 'target', 'ref_m')},{auc(live, score, target, 'live_m')},
concept AS (SELECT live_m.n_rows AS n_labeled, ref_m.pr_auc AS ref_pr_auc, ref_m.roc_auc AS ref_roc_auc, ref_m.pos_rate AS ref_pos_rate,
        live_m.pr_auc AS live_pr_auc, live_m.roc_auc AS live_roc_auc, live_m.pos_rate AS live_pos_rate,
        ref_m.roc_auc - live_m.roc_auc >= {P.perf_drop_threshold} AS concept_drift,
        abs(live_m.pos_rate - ref_m.pos_rate) >= {P.label_shift_threshold} AS label_shift FROM ref_m, live_m
        WHERE live_m.n_rows >= {P.min_labels} AND live_m.n_pos BETWEEN 1 AND live_m.n_rows - 1)"""


def column_psi(ref: str, cur: str, out: str) -> str:
    return f"""
{out}_l AS (SELECT 'ref' AS side, 'score' AS feature, score AS v FROM {ref} UNION ALL SELECT 'cur', 'score', score FROM {cur}),{psi_values(out + '_l', out)}"""


SNAPSHOT = LOGS + f""",
recent AS MATERIALIZED (SELECT * FROM plog ORDER BY ts DESC, request_id DESC LIMIT {P.window_size}),
both_sides AS (SELECT 'ref' AS side, {', '.join(map(q, C.INPUT_COLS))} FROM enc WHERE discharge_ts < timestamp '{derived.PERIOD_CUT}'
    UNION ALL SELECT 'cur', {', '.join(map(q, C.INPUT_COLS))} FROM recent),
{features('both_sides', 'sfeat', 'side')},{psi_all('sfeat', 's_')},
recent_live AS (SELECT recent.*, readmitted_30d FROM recent JOIN (SELECT encounter_id, readmitted_30d FROM latest) USING (encounter_id)),{concept('recent_live', 'score', 'readmitted_30d')},{column_psi('refrows', 'recent', 'ppsi')},
snap AS (SELECT n_drifted / n_features::double >= {P.drift_share_threshold} AS data_drift, n_drifted / n_features::double AS drift_share, n_drifted,
        psi AS prediction_psi, psi >= {P.pred_psi_threshold} AS prediction_drift, concept.*, max_feature_psi
    FROM s_summary, ppsi, concept),
gauges AS (SELECT * FROM (SELECT cast(data_drift AS double) AS data_drift, drift_share, prediction_psi, cast(prediction_drift AS double) AS prediction_drift,
        cast(concept_drift AS double) AS concept_drift, cast(label_shift AS double) AS label_shift, live_pr_auc, ref_pr_auc, live_roc_auc, ref_roc_auc,
        cast(n_labeled AS double) AS n_labeled, max_feature_psi FROM snap)
    UNPIVOT (value FOR metric IN (data_drift, drift_share, prediction_psi, prediction_drift, concept_drift, label_shift,
        live_pr_auc, ref_pr_auc, live_roc_auc, ref_roc_auc, n_labeled, max_feature_psi)))"""


# ---- what-if shifts ----------------------------------------------------------------------------

def poisson(u: str, mean: float, most: int = 40) -> str:
    steps, total, term = [], 0.0, math.exp(-mean)
    for k in range(most):
        total += term
        steps.append(repr(total) + "::double")
        term *= mean / (k + 1)
    return f"len(list_filter([{', '.join(steps)}], lambda s: {u} >= s))"


_BINS = "[" + ", ".join(text(b) for b in C.AGE_BINS) + "]"
_SHIFT = {
    "age": f"{_BINS}[least(list_position({_BINS}, age) + 2, 10)]",
    "num_medications": f"cast(least(greatest(num_medications + 5 + floor({uniform('num_medications')} * 10), 0), 100) AS bigint)",
    "number_inpatient": f"cast(least(greatest(number_inpatient + {poisson(uniform('number_inpatient'), 2.0)}, 0), 30) AS bigint)",
    "admission_type_id": f"cast(CASE WHEN {uniform('admission_type_id')} < 0.9::double THEN 1 ELSE 2 END AS bigint)",
    "time_in_hospital": "cast(least(greatest(time_in_hospital + 3, 1), 14) AS bigint)",
}
SHIFTED = ENC + f""",
shifted AS MATERIALIZED (SELECT * REPLACE ({', '.join(f'{sql} AS {c}' for c, sql in _SHIFT.items())}) FROM enc)"""
_RESP = f"(({icd9('diag_1')}) = 'respiratory' OR ({icd9('diag_2')}) = 'respiratory')"
_NEW_LOGIT = (f"({NEW_RISK['base']}::double + {NEW_RISK['inpatient']}::double * least(number_inpatient, 3)"
              f" + {NEW_RISK['procedures']}::double * cast(num_procedures >= 3 AS int) + {NEW_RISK['respiratory']}::double * cast({_RESP} AS int)"
              f" + {NEW_RISK['first_stay']}::double * cast(number_inpatient = 0 AS int))")


# ---- telemetry ---------------------------------------------------------------------------------

REQ = f"""
req AS MATERIALIZED (SELECT ts, epoch_us(ts) // 1000000 AS sec, {', '.join(f'{sql} AS {c}' for c, sql in derived.REQUEST_LOG_SQL.items())} FROM events)"""
ENDPOINTS = ("/predict", "/predict/batch", "/feedback")
SCORED_REQ = "endpoint LIKE '/predict%' AND status = 200"


def windows(rows: str, out: str, sums: dict[str, str], size: int, step: int, by: str = "") -> str:
    keys = by + ", " if by else ""
    aggs = ", ".join(f"cast(sum({sql}) AS bigint) AS {name}" for name, sql in sums.items())
    again = ", ".join(f"cast(sum({name}) AS bigint) AS {name}" for name in sums)
    return f"""
{out}_s AS (SELECT {keys}sec // {step} * {step} AS s, {aggs} FROM req WHERE {rows} GROUP BY ALL),
{out} AS (SELECT {keys}w_start, {again} FROM (SELECT *, unnest(generate_series(s - {size - step}, s, {step})) AS w_start FROM {out}_s) GROUP BY ALL)"""


def share(rows: str, out: str, condition: str, name: str, size: int, step: int) -> str:
    w = windows(rows, out + "_w", {"n": "1", "hits": f"CASE WHEN {condition} THEN 1 ELSE 0 END"}, size, step)
    return w + f",\n{out} AS (SELECT w_start, n, hits, (hits / {size}.0::double) / greatest(n / {size}.0::double, 1e-9) AS {name} FROM {out}_w)"


def bucket_quantiles(rows: str, out: str, value: str, edges: list[float], probs: dict[str, float], size: int, step: int) -> str:
    sums = {f"b{i}": f"CASE WHEN {value} <= {e}::double THEN 1 ELSE 0 END" for i, e in enumerate(edges)}
    w = windows(rows, out + "_w", {**sums, "n": "1"}, size, step)
    cum = "[" + ", ".join(f"b{i}" for i in range(len(edges))) + "]"
    bounds = "[" + ", ".join(f"{e}::double" for e in edges) + "]"

    def at(p: float) -> str:
        i = f"len(list_filter(cum, lambda c: c < n * {p}::double))"
        low = f"CASE WHEN {i} = 0 THEN 0 ELSE bounds[{i}] END"
        below = f"CASE WHEN {i} = 0 THEN 0 ELSE cum[{i}] END"
        first = f"WHEN {i} = 0 THEN {edges[0]}::double" if edges[0] <= 0 else ""
        return (f"CASE WHEN {i} >= {len(edges)} THEN {edges[-1]}::double {first} ELSE "
                f"{low} + (bounds[{i} + 1] - ({low})) * ((n * {p}::double - ({below})) / (cum[{i} + 1] - ({below}))) END")

    cols = ", ".join(f"{at(p)} AS {name}" for name, p in probs.items())
    return w + f",\n{out} AS (SELECT w_start, n, {cols} FROM (SELECT *, {cum} AS cum, {bounds} AS bounds FROM {out}_w))"


def _alert_series() -> str:
    size = {name: spec[1] for name, spec in ALERTS.items()}
    return ",".join([
        bucket_quantiles("endpoint = '/predict'", "a_lat", "latency_s", LATENCY_EDGES, {"v": 0.95}, size["latency_p95"], 60),
        share("TRUE", "a_err", "status >= 500", "v", size["error_rate"], 60),
        share("TRUE", "a_inv", "status = 422", "v", size["invalid_rate"], 60),
        share(SCORED_REQ, "a_fol", "follow_up", "v", size["follow_up_rate"], 60),
    ])


_ALERT_UNION = " UNION ALL ".join(
    f"SELECT '{name}' AS alert, w_start, v > {ALERTS[name][0]}::double AS firing, {ALERTS[name][2]} AS lasts FROM {t}"
    for name, t in (("latency_p95", "a_lat"), ("error_rate", "a_err"), ("invalid_rate", "a_inv"), ("follow_up_rate", "a_fol"))
)


# ---- contract ----------------------------------------------------------------------------------

def cell_check(rule: C.ColumnRule) -> str:
    whens = [f"WHEN v IS NULL THEN {'NULL' if rule.nullable else text('not_null')}"]
    if rule.type == "bigint":
        whens.append("WHEN try_cast(v AS bigint) IS NULL THEN 'type'")
        outside = f"try_cast(v AS bigint) < {rule.low}" + (f" OR try_cast(v AS bigint) > {rule.high}" if rule.high is not None else "")
        whens.append(f"WHEN {outside} THEN 'range'")
    if rule.domain:
        whens.append(f"WHEN NOT ({among('v', rule.domain)}) THEN 'domain'")
    return f"SELECT '{rule.name}' AS col, CASE {' '.join(whens)} END AS chk, v FROM (SELECT {q(rule.name)} AS v FROM fenc)"


CELLS = FENC + f""",
cells AS ({' UNION ALL '.join(cell_check(r) for r in C.DATASET_RULES)}
    UNION ALL SELECT 'encounter_id', 'unique', encounter_id FROM fenc QUALIFY count(*) OVER (PARTITION BY encounter_id) > 1)"""

_CONTRACT = [r.name for r in C.DATASET_RULES]
_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS col, avg(CASE WHEN {q(c)} IS NULL OR {q(c)} = '?' THEN 1.0::double ELSE 0 END) AS rate FROM fenc" for c in _CONTRACT
)

_REQUEST_REASONS = [
    ("encounter_id % 101 = 0", "time_in_hospital:range:99"), ("encounter_id % 103 = 0", "gender:domain:X"),
    ("encounter_id % 107 = 0", "age:domain:seventy"), ("encounter_id % 109 = 0", "num_medications:type:many"),
    ("encounter_id % 113 = 0", "insulin:domain:Maybe"), ("encounter_id % 131 = 0", "number_inpatient:not_null"),
    ("encounter_id % 151 = 0 AND encounter_id % 2 = 1 AND metformin = 'No'", "metformin:not_null"),
]
REQUESTS = ENC + f""",
judged_req AS MATERIALIZED (SELECT *, list_sort(list_filter([{', '.join(f"CASE WHEN {w} THEN {text(r)} END" for w, r in _REQUEST_REASONS)}], lambda x: x IS NOT NULL)) AS reasons FROM enc)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def fingerprint(table: str, out: str, columns: list[str], by: str = "") -> str:
    """Rows and sums modulo 2^64 of both halves of the md5 of each row's text, columns in order of their names."""
    cells = []
    for c in sorted(columns):
        value = f"epoch_us({q(c)})" if c == "discharge_ts" else q(c)
        cells.append(f"coalesce(length(cast({value} AS varchar)) || ':' || cast({value} AS varchar), '~')")
    half = lambda at: f"cast(sum(('0x' || substr(h, {at}, 16))::ubigint::hugeint) % 18446744073709551616::hugeint AS varchar)"
    keys = by + ", " if by else ""
    rate = ", round(avg(target), 4) AS pos_rate" if by else ""
    return f"""{out} AS MATERIALIZED (SELECT {keys}rows{', pos_rate' if by else ''}, sha256(rows || '|' || low || '|' || high) AS sha256 FROM (
    SELECT {keys}count(*) AS rows, {half(1)} AS low, {half(17)} AS high{rate}
    FROM (SELECT {keys}{'target, ' if by else ''}md5({" || ';' || ".join(cells)}) AS h FROM {table}) {'GROUP BY ' + by if by else ''}))"""


_SETTINGS = json.dumps({"exclude_discharge_ids": list(P.exclude_discharge_ids), "seed": P.seed, "test_size": P.test_size, "val_size": P.val_size})
_VERSION_COLS = [c for c in derived.ENCOUNTER_SQL if c not in ("readmitted", "discharge_ts")] + ["target"]
_TABLE_COLS = [c for c in derived.ENCOUNTER_SQL if c != "readmitted"] + ["target"]


def version_of(prints: str, raw: str = "''") -> str:
    """The data version from the splits' hashes."""
    return f"(SELECT substr(sha256({raw} || '|' || {text(_SETTINGS)} || '|' || string_agg(split || ':' || sha256, '|' ORDER BY split)), 1, 12) FROM {prints})"


def _retrain() -> str:
    return LOGS + f""",
labelled AS MATERIALIZED (SELECT *, cast(readmitted = '<30' AS bigint) AS target, {split_case()} AS split
    FROM enc WHERE NOT {among('discharge_disposition_id', P.exclude_discharge_ids)}),
old_rows AS MATERIALIZED (SELECT * FROM labelled WHERE discharge_ts < timestamp '{derived.RETRAIN_CUT}'),
last_live AS (SELECT live.*, enc.patient_nbr AS known, cast(readmitted_30d AS bigint) AS target
    FROM live JOIN (SELECT encounter_id AS eid, patient_nbr FROM enc) enc ON eid = live.encounter_id
    QUALIFY row_number() OVER (PARTITION BY encounter_id ORDER BY ts DESC, request_id DESC) = 1),
old_patients AS (SELECT DISTINCT patient_nbr AS p, split FROM old_rows),
new_rows AS MATERIALIZED (SELECT l.*, coalesce(split, CASE WHEN {bucket('known')} < {P.new_train_share}::double THEN 'train' ELSE 'test' END) AS split
    FROM last_live l LEFT JOIN old_patients ON p = known),
merged AS (SELECT split, encounter_id, patient_nbr, target, age, time_in_hospital, insulin FROM old_rows o
        WHERE NOT EXISTS (SELECT 1 FROM new_rows n WHERE n.encounter_id = o.encounter_id)
    UNION ALL SELECT split, encounter_id, known, target, age, time_in_hospital, insulin FROM new_rows)"""


def _gains() -> str:
    """Sums of gradients (of log-loss at the balanced prior, 1/2) and curvatures by code, then the gain of every split."""
    gain = "(g * g / h + (tg - g) * (tg - g) / (th - h) - tg * tg / th)"
    feat = features("labelled", "feat", "encounter_id, split, target")
    return f"""{LABELLED},{feat},{fitted('feat', "split = 'train'")},{vocab('feat', "split = 'train'")},
tr AS (SELECT * FROM feat WHERE split = 'train'),
cls AS (SELECT target AS t, (SELECT count(*) FROM tr) / (2.0::double * count(*)) AS w FROM tr GROUP BY target),
fit AS (SELECT tr.*, round(w * (0.5 - target) * 16777216) / 16777216 AS g, round(w * 0.25 * 16777216) / 16777216 AS h FROM tr JOIN cls ON t = target
    WHERE (SELECT count(*) FROM tr) <= 10000 OR {bucket('encounter_id', P.seed + 2)} >= 0.1),
tot AS (SELECT sum(g) AS tg, sum(h) AS th, count(*) AS tn FROM fit),
nums AS ({longer('fit', C.NUM_COLS, keep='g, h')}),
nc AS (SELECT feature, greatest(least(coalesce(v, median), high), low) AS code, count(*) AS n, sum(g) AS g, sum(h) AS h
    FROM nums JOIN med USING (feature) JOIN clip USING (feature) GROUP BY 1, 2),
ncum AS (SELECT feature, sum(n) OVER w AS n, sum(g) OVER w AS g, sum(h) OVER w AS h, count(*) OVER (PARTITION BY feature) AS n_codes
    FROM nc WINDOW w AS (PARTITION BY feature ORDER BY code ROWS UNBOUNDED PRECEDING)),
cats AS ({longer('fit', C.CAT_COLS, keep='g, h')}),
cc AS (SELECT cats.feature, CASE WHEN frequent THEN category END AS code, count(*) AS n, sum(g) AS g, sum(h) AS h
    FROM cats JOIN vocab ON vocab.feature = cats.feature AND category = coalesce(v, 'missing') GROUP BY 1, 2),
ccum AS (SELECT feature, n, g, h, count(*) OVER (PARTITION BY feature) AS n_codes FROM cc),
parts AS (SELECT * FROM ncum UNION ALL SELECT * FROM ccum)
SELECT feature, max(n_codes) AS n_codes, round(max(CASE WHEN n >= 20 AND tn - n >= 20 AND h >= 0.001 AND th - h >= 0.001 THEN {gain} END), 4) + 0.0 AS gain
FROM parts, tot GROUP BY feature"""


#: The least upper mean of the greatest lower ones: rate(i) is the max over j <= i of the min over k >= i of the mean from j to k.
ISOTONIC = """
lv AS (SELECT CASE WHEN model = 'lace' THEN 0 ELSE 1 END AS c, CASE WHEN model = 'lace' THEN score ELSE floor(score * 200) / 200 END AS v, target FROM sc),
pts AS MATERIALIZED (SELECT c, v, count(*) AS n, sum(target) AS pos, row_number() OVER (PARTITION BY c ORDER BY v) AS i FROM lv GROUP BY c, v),
run AS MATERIALIZED (SELECT *, sum(n) OVER w AS cn, sum(pos) OVER w AS cp FROM pts WINDOW w AS (PARTITION BY c ORDER BY i)),
means AS MATERIALIZED (SELECT a.c, a.i AS j, z.i AS k, (z.cp - a.cp + a.pos)::double / (z.cn - a.cn + a.n) AS m FROM run a JOIN run z ON a.c = z.c AND z.i >= a.i),
low AS (SELECT means.c, pts.i, j, min(m) AS m FROM pts JOIN means ON means.c = pts.c AND j <= pts.i AND k >= pts.i GROUP BY 1, 2, 3),
rates AS (SELECT c, i, max(m) AS rate FROM low GROUP BY 1, 2)
SELECT c::bigint AS curve, round(min(v), 6) + 0.0 AS low, round(max(v), 6) + 0.0 AS high, sum(n)::bigint AS n, sum(pos)::bigint AS pos, round(rate, 6) + 0.0 AS rate
FROM pts JOIN rates USING (c, i) GROUP BY c, round(rate, 10), rate"""


def oracle_sql() -> dict[str, str]:
    train_feat = LABELLED + "," + features("labelled", "feat", "encounter_id, split")
    faulty_feat = FENC + "," + features("fenc", "feat", "encounter_id AS id, patient_nbr")
    pivot = ", ".join(f"round(max(CASE WHEN feature = '{c}' THEN z END), 6) + 0.0 AS {q(c)}" for c in C.NUM_COLS)
    return {
        "risk_by_split_and_diagnosis": _with(LABELLED, f"""SELECT split, {icd9('diag_1')} AS diagnosis, count(*) AS rows,
            cast(sum(target) AS bigint) AS positives, round(avg({LACE_SQL}), 6) AS mean_lace FROM labelled GROUP BY 1, 2"""),
        "cohort_split_summary": _with(LABELLED, "SELECT split, count(*) AS rows, round(avg(target), 4) AS pos_rate FROM labelled GROUP BY 1"),
        "cohort_target": _with(LABELLED, "SELECT encounter_id, discharge_disposition_id, target FROM labelled"),
        "patient_split": _with(ENC, f"SELECT encounter_id, round({bucket('patient_nbr')}, 9) AS bucket, {split_case()} AS split FROM enc"),
        "split_disjoint": _with(LABELLED, """SELECT split, count(DISTINCT patient_nbr) AS patients,
            (SELECT count(*) FROM (SELECT patient_nbr FROM labelled GROUP BY 1 HAVING count(DISTINCT split) > 1)) AS shared_patients
            FROM labelled GROUP BY 1"""),

        "data_version": _with(LABELLED + "," + fingerprint("enc", "raw_print", list(derived.ENCOUNTER_SQL)) + "," + fingerprint("labelled", "prints", _TABLE_COLS, "split"),
            f"SELECT raw_print.sha256 AS raw_sha256, {version_of('prints', '(SELECT sha256 FROM raw_print)')} AS data_version, split, prints.rows AS rows, pos_rate, prints.sha256 AS sha256 FROM prints, raw_print"),

        "missing_rates": _with(FENC, f'SELECT col AS "column", round(rate, 6) AS missing_rate FROM ({_MISSING})'),
        "label_rate": _with(FENC, "SELECT round(avg(CASE WHEN readmitted = '<30' THEN 1.0::double ELSE 0 END), 6) AS label_rate FROM fenc"),
        "violation_report": _with(CELLS, """SELECT col AS "column", chk AS "check", count(*) AS n_failures,
            coalesce(array_to_string(list_slice(list_sort(list(DISTINCT v) FILTER (WHERE v IS NOT NULL)), 1, 5), '|'), '') AS examples
            FROM cells WHERE chk IS NOT NULL GROUP BY 1, 2"""),
        "duplicate_ids": _with(FENC, "SELECT encounter_id, count(*) AS n FROM fenc GROUP BY 1 HAVING count(*) > 1"),
        "dataset_checks": _with(FENC, f"""SELECT 'min_rows' AS "check", NULL AS "column", count(*)::double AS value, count(*) >= {P.min_rows} AS passed FROM fenc
            UNION ALL SELECT 'missing_rate', col, round(rate, 6), rate <= {P.max_missing_rate} FROM ({_MISSING})
            UNION ALL SELECT 'label_rate', NULL, round(avg(r), 6), avg(r) BETWEEN {P.min_label_rate} AND {P.max_label_rate}
            FROM (SELECT CASE WHEN readmitted = '<30' THEN 1.0::double ELSE 0 END AS r FROM fenc)"""),
        "dq_report": _with(CELLS + f""",
            found AS (SELECT 'schema' AS type, col, chk, count(*) AS n, NULL::double AS value FROM cells WHERE chk IS NOT NULL GROUP BY 2, 3
                UNION ALL SELECT 'dataset', NULL, 'min_rows', NULL, count(*)::double FROM fenc HAVING count(*) < {P.min_rows}
                UNION ALL SELECT 'dataset', col, 'missing_rate', NULL, round(rate, 6) FROM ({_MISSING}) WHERE rate > {P.max_missing_rate}
                UNION ALL SELECT 'dataset', NULL, 'label_rate', NULL, round(avg(r), 6) FROM (SELECT CASE WHEN readmitted = '<30' THEN 1.0::double ELSE 0 END AS r FROM fenc)
                    HAVING avg(r) NOT BETWEEN {P.min_label_rate} AND {P.max_label_rate})""",
            """SELECT (SELECT count(*) FROM fenc) AS n_rows, (SELECT count(*) FROM found) AS n_issues, FALSE AS passed, type, col AS "column", chk AS "check",
                n AS n_failures, value, 1::bigint AS alerts FROM found"""),
        "quarantine": _with(REQUESTS, """SELECT encounter_id AS source_id, len(reasons)::bigint AS n_violations, array_to_string(reasons, '|') AS reasons
            FROM judged_req WHERE len(reasons) > 0"""),
        "accepted_requests": _with(REQUESTS, """SELECT encounter_id, time_in_hospital, num_medications, age,
            CASE WHEN encounter_id % 149 = 0 THEN '785.4' ELSE diag_1 END AS diag_1, max_glu_serum, metformin, insulin,
            "glyburide-metformin" AS glyburide_metformin FROM judged_req WHERE len(reasons) = 0"""),

        "icd9_groups": _with(FENC, f"SELECT patient_nbr, encounter_id, {', '.join(icd9(f'diag_{i}') + f' AS diag_{i}_grp' for i in (1, 2, 3))} FROM fenc"),
        "charlson_scores": _with(ENC, f"SELECT encounter_id, {charlson()}::bigint AS charlson FROM enc"),
        "lace_scores": _with(ENC, f"SELECT encounter_id, {LACE_SQL} AS lace FROM enc"),
        "lace_flags": _with(ENC, f"SELECT encounter_id, round(lace / 19.0::double, 6) AS risk, cast(lace >= 10 AS bigint) AS flag FROM (SELECT encounter_id, {LACE_SQL} AS lace FROM enc)"),
        "med_counts": _with(FENC, f"""SELECT patient_nbr,
            cast({' + '.join(f"CASE WHEN {q(m)} IN ('Up','Down') THEN 1 ELSE 0 END" for m in C.MED_COLS)} AS bigint) AS n_med_changes,
            cast({' + '.join(f"CASE WHEN {q(m)} IN ('Steady','Up','Down') THEN 1 ELSE 0 END" for m in C.MED_COLS)} AS bigint) AS n_meds_active,
            {' + '.join(f"coalesce(try_cast({c} AS double), 0)" for c in ('number_outpatient', 'number_emergency', 'number_inpatient'))} AS total_visits,
            try_cast(nullif(regexp_extract(age, '\\[(\\d+)-', 1), '') AS double) + 5 AS age_num FROM fenc"""),
        "specialty_groups": _with(ENC, f"SELECT CASE WHEN {among('medical_specialty', TOP_SPECIALTIES)} THEN medical_specialty ELSE 'Other' END AS specialty, count(*) AS n FROM enc GROUP BY 1"),
        "sql_functions": _with(ENC, f"SELECT encounter_id, {icd9('diag_1')} AS diagnosis, {LACE_SQL} AS lace FROM enc"),

        "clean_features": _with(faulty_feat, "SELECT * FROM feat"),
        "impute_medians": _with(faulty_feat + "," + fitted("feat", "TRUE"), "SELECT feature, round(median, 6) AS median FROM med"),
        "clip_bounds": _with(faulty_feat + "," + fitted("feat", "TRUE"), "SELECT feature, round(low, 6) AS low, round(high, 6) AS high FROM clip"),
        "scale_stats": _with(faulty_feat + "," + fitted("feat", "TRUE"), "SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM scale"),
        "onehot_vocab": _with(faulty_feat + "," + vocab("feat", "TRUE"), "SELECT * FROM vocab"),
        "scaled_features": _with(train_feat + "," + fitted("feat", "split = 'train'") + f""",
            all_long AS ({longer('feat', C.NUM_COLS, 'encounter_id')}),
            z AS (SELECT encounter_id, feature, (greatest(least(coalesce(v, median), high), low) - mean) / std AS z
                FROM all_long JOIN med USING (feature) JOIN clip USING (feature) JOIN scale USING (feature))""",
            f"SELECT encounter_id, {pivot} FROM z GROUP BY encounter_id"),
        "onehot_totals": _with(train_feat + "," + vocab("feat", "split = 'train'") + f""",
            test AS ({longer('feat', C.CAT_COLS, where="split = 'test'")}),
            tested AS (SELECT t.feature, coalesce(t.v, 'missing') AS category, count(*) AS n FROM test t GROUP BY 1, 2),
            marked AS (SELECT tested.*, coalesce(vocab.frequent, FALSE) AS frequent FROM tested LEFT JOIN vocab USING (feature, category))""",
            """SELECT v.feature || '=' || v.category AS indicator, coalesce(t.n, 0) AS n FROM vocab v LEFT JOIN tested t USING (feature, category) WHERE v.frequent
            UNION ALL SELECT f.feature || '=infrequent', coalesce(cast(sum(m.n) AS bigint), 0)
            FROM (SELECT DISTINCT feature FROM vocab WHERE NOT frequent) f LEFT JOIN marked m ON m.feature = f.feature AND NOT m.frequent GROUP BY f.feature"""),

        "score_quantiles_exact": _with(SCORED, "SELECT model, " + ", ".join(f"round(quantile_cont(score, {p}), 6) AS {n}" for n, p in
            (("q0", 0.0), ("q25", 0.25), ("q50", 0.5), ("q90", 0.9), ("q100", 1.0))) + " FROM sc GROUP BY model"),
        "decision_threshold": _with(SCORED, f"SELECT round(quantile_cont(blend, {1 - P.top_k_frac}), 6) AS threshold FROM scores"),
        "decisions": _with(SCORED, f"""SELECT encounter_id, round(blend, 5) AS risk_score, blend >= (SELECT round(quantile_cont(blend, {1 - P.top_k_frac}), 6) FROM scores) AS follow_up,
            'v1' AS model_version FROM scores"""),
        "score_histogram": _with(SCORED, "SELECT model, least(len(list_filter([" + ", ".join(f"{e}::double" for e in SCORE_EDGES[1:-1]) +
            "], lambda e: score >= e)), 19)::bigint AS bin, count(*) AS n FROM sc WHERE score BETWEEN 0 AND 1 GROUP BY 1, 2"),
        "brier_score": _with(SCORED + "," + CURVE, "SELECT model, round(brier, 6) AS brier FROM br"),
        "average_precision": _with(SCORED + "," + CURVE, "SELECT model, round(pr_auc, 6) AS pr_auc FROM ap"),
        "roc_auc": _with(SCORED + "," + CURVE, "SELECT model, round(roc_auc, 6) AS roc_auc FROM ap"),
        "pr_curve": _with(SCORED + "," + CURVE, "SELECT model, round(score, 6) AS score, n, pos, cum_n, cum_pos FROM curve"),
        "recall_at_k": _with(SCORED + "," + TOPK, """SELECT model, k, tp AS true_positives, round(tp::double / greatest(n_pos, 1), 6) AS recall_at_k,
            round(tp::double / k, 6) AS precision_at_k FROM topk"""),
        "group_recall": _with(SCORED + "," + GROUPS, "SELECT model, dim, value, n_positive, round(recall, 6) AS recall, used FROM judged"),
        "fairness_gap": _with(SCORED + "," + GROUPS, """SELECT model, round(gender, 6) AS gender, round(race, 6) AS race, round(age60, 6) AS age60,
            round(greatest(gender, race), 6) AS max FROM gaps"""),
        "model_comparison": _with(SCORED + "," + BUNDLE, "SELECT model, metric, value FROM metrics"),
        "best_experiment": _with(SCORED + "," + BUNDLE, "SELECT model, pr_auc FROM wide ORDER BY pr_auc DESC, model = 'blend' LIMIT 1"),
        "gate_checks": _with(SCORED + "," + GATE, 'SELECT "check", metric, round(value, 6) AS value, round("limit", 6) AS "limit", passed FROM checks'),
        "gate_verdict": _with(SCORED + "," + GATE, "SELECT bool_and(passed) AS passed FROM checks"),

        "psi_numeric": _with(PERIODS, "SELECT feature, bins, round(psi, 6) AS psi FROM num"),
        "psi_categorical": _with(PERIODS, "SELECT feature, bins, round(psi, 6) AS psi FROM cat"),
        "feature_drift": _with(PERIODS, "SELECT feature, psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'moderate' ELSE 'major' END AS band FROM psi"),
        "drift_summary": _with(PERIODS, f"SELECT {SUMMARY_COLS} FROM summary"),
        "shifted_cohort": _with(SHIFTED, f"SELECT encounter_id, {', '.join(_SHIFT)} FROM shifted"),
        "shifted_drift": _with(SHIFTED + "," + features("(SELECT 'ref' AS side, * FROM enc UNION ALL SELECT 'cur', * FROM shifted)", "feat", "side") + "," + psi_all("feat"),
            f"SELECT {SUMMARY_COLS} FROM summary"),
        "shifted_labels": _with(ENC, f"SELECT encounter_id, cast({uniform('target')} < 1 / (1 + exp(-{_NEW_LOGIT})) AS bigint) AS target FROM enc"),
        "prediction_drift": _with(SCORED + f""",
            before AS (SELECT blend AS score FROM scores WHERE discharge_ts < timestamp '{derived.PERIOD_CUT}'),
            after AS (SELECT blend AS score FROM scores WHERE discharge_ts >= timestamp '{derived.PERIOD_CUT}'),""" + column_psi("before", "after", "ppsi"),
            f"SELECT round(psi, 6) AS prediction_psi, psi >= {P.pred_psi_threshold} AS prediction_drift FROM ppsi"),
        "concept_drift": _with(LOGS + "," + concept("live", "score", "readmitted_30d"), """SELECT n_labeled, round(ref_pr_auc, 6) AS ref_pr_auc, round(ref_roc_auc, 6) AS ref_roc_auc,
            round(ref_pos_rate, 6) AS ref_pos_rate, round(live_pr_auc, 6) AS live_pr_auc, round(live_roc_auc, 6) AS live_roc_auc,
            round(live_pos_rate, 6) AS live_pos_rate, concept_drift FROM concept"""),
        "label_shift": _with(LOGS + "," + concept("live", "score", "readmitted_30d"),
            "SELECT round(ref_pos_rate, 6) AS ref_pos_rate, round(live_pos_rate, 6) AS live_pos_rate, label_shift FROM concept"),
        "monitor_snapshot": _with(SNAPSHOT, "SELECT metric, round(value, 6) AS value FROM gauges"),
        "monitor_stream": _with(SNAPSHOT, "SELECT metric, round(value, 6) AS value FROM gauges"),
        "monitor_decision": _with(SNAPSHOT, f"""SELECT 'ok' AS status, (SELECT count(*) FROM recent) AS n_production, data_drift, prediction_drift, concept_drift, label_shift,
            concept_drift OR data_drift AS retrain_recommended, CASE WHEN concept_drift THEN 'concept_drift' WHEN data_drift THEN 'data_drift' END AS reason, n_drifted FROM snap"""),
        "flag_alerts": _with(SNAPSHOT, "SELECT metric, value FROM gauges WHERE metric IN ('data_drift', 'prediction_drift', 'concept_drift') AND value = 1"),
        "latest_labels": _with(LOGS, "SELECT encounter_id, epoch_us(ts) // 1000000 AS ts, readmitted_30d FROM latest"),
        "recent_predictions": _with(LOGS, f"""SELECT request_id, encounter_id, epoch_us(ts) // 1000000 AS ts, round(score, 6) AS score, model_version
            FROM plog ORDER BY plog.ts DESC, request_id DESC LIMIT {P.window_size}"""),
        "label_join": _with(LOGS, "SELECT request_id, encounter_id, round(score, 6) AS score, model_version, readmitted_30d FROM live"),

        "raw_form": _with(_retrain(), "SELECT encounter_id, encounter_id AS patient_nbr, CASE WHEN target = 1 THEN '<30' ELSE 'NO' END AS readmitted, age, time_in_hospital FROM new_rows"),
        "retrain_dataset": _with(_retrain(), "SELECT * FROM merged"),
        "retrain_disjoint": _with(_retrain(), """SELECT
            (SELECT count(*) FROM (SELECT patient_nbr FROM merged WHERE patient_nbr IS NOT NULL GROUP BY 1 HAVING count(DISTINCT split) > 1)) AS shared_patients,
            (SELECT count(*) FROM (SELECT encounter_id FROM merged GROUP BY 1 HAVING count(DISTINCT split) > 1)) AS shared_encounters, 0::bigint AS rows_without_patient"""),
        "retrain_lineage": _with(_retrain() + f""",
            wide AS (SELECT {', '.join(q(c) for c in _VERSION_COLS)}, split FROM old_rows o WHERE NOT EXISTS (SELECT 1 FROM new_rows n WHERE n.encounter_id = o.encounter_id)
                UNION ALL SELECT {', '.join('known' if c == 'patient_nbr' else q(c) for c in _VERSION_COLS)}, split FROM new_rows),
            {fingerprint('old_rows', 'print1', _VERSION_COLS, 'split')}, {fingerprint('wide', 'print2', _VERSION_COLS, 'split')},
            ids AS (SELECT {version_of('print1')} AS v1, {version_of('print2')} AS v2)""",
            "SELECT 1::bigint AS number, NULL::varchar AS parent_data_version, v1 AS data_version, print1.* FROM print1, ids UNION ALL SELECT 2, v1, v2, print2.* FROM print2, ids"),
        "retrain_summary": _with(_retrain(), "SELECT split, count(*) AS rows, round(avg(target), 4) AS pos_rate FROM merged GROUP BY split"),

        "request_rate": _with(REQ + "," + windows("TRUE", "w", {"n": "1"}, 60, 60, "endpoint"), "SELECT endpoint, w_start, n, round(n / 60.0::double, 6) AS per_second FROM w"),
        "status_rate": _with(REQ + "," + windows("TRUE", "w", {"n": "1"}, 60, 60, "status"), "SELECT status::bigint AS status, w_start, n, round(n / 60.0::double, 6) AS per_second FROM w"),
        "latency_quantiles": _with(REQ + "," + bucket_quantiles("endpoint = '/predict'", "w", "latency_s", LATENCY_EDGES, {"p50": 0.5, "p95": 0.95}, 300, 60),
            "SELECT w_start, n, round(p50, 6) AS p50, round(p95, 6) AS p95 FROM w"),
        "error_rate": _with(REQ + "," + share("TRUE", "w", "status >= 500", "error_rate", 300, 60), "SELECT w_start, n, hits, round(error_rate, 6) AS error_rate FROM w"),
        "invalid_rate": _with(REQ + "," + share("TRUE", "w", "status = 422", "invalid_rate", 300, 60), "SELECT w_start, n, hits, round(invalid_rate, 6) AS invalid_rate FROM w"),
        "score_quantiles": _with(REQ + "," + bucket_quantiles(SCORED_REQ, "w", "score", SCORE_EDGES, {"p50": 0.5, "p90": 0.9}, 300, 60),
            "SELECT w_start, n, round(p50, 6) AS p50, round(p90, 6) AS p90 FROM w"),
        "follow_up_rate": _with(REQ + "," + share(SCORED_REQ, "w", "follow_up", "follow_up_rate", 300, 60), "SELECT w_start, n, hits, round(follow_up_rate, 6) AS follow_up_rate FROM w"),
        "model_in_use": _with(REQ, "SELECT sec // 3600 * 3600 AS w_start, arg_max(model_version, (ts, model_version)) AS model_version FROM req GROUP BY 1"),
        "label_counts": _with(LOGS, "SELECT cast(readmitted_30d AS bigint) AS label, epoch_us(ts) // 1000000 // 86400 * 86400 AS w_start, count(*) AS n FROM llog GROUP BY 1, 2"),
        "sustained_alerts": _with(REQ + "," + _alert_series() + f""",
            firing AS (SELECT *, w_start - 60 * row_number() OVER (PARTITION BY alert ORDER BY w_start) AS island FROM ({_ALERT_UNION}) WHERE firing),
            silent AS (SELECT sec AS start, lead(sec) OVER (ORDER BY sec) AS "end" FROM (SELECT DISTINCT sec FROM req))""",
            """SELECT alert, min(w_start) AS start, max(w_start) AS "end", max(w_start) - min(w_start) AS duration, min(w_start) + max(lasts) AS fires_at
            FROM firing GROUP BY alert, island HAVING max(w_start) - min(w_start) >= max(lasts)
            UNION ALL SELECT 'service_silent', start, "end", "end" - start, start + 30 FROM silent WHERE "end" - start >= 30"""),
        "scored_rows": _with(LABELLED, f"""SELECT model, count(*) AS n, count(DISTINCT encounter_id) AS encounters, 0::bigint AS outside, sum(target)::bigint AS positives
            FROM labelled, (SELECT unnest(['logreg_balanced', 'gbt_default', 'gbt_tuned', 'gbt_calibrated']) AS model) WHERE split = 'test' GROUP BY model"""),
        "logistic_optimum": _with(train_feat + "," + vocab("feat", "split = 'train'"), f"""SELECT unnest([{', '.join(text(c) for c in C.NUM_COLS)}]) AS feature, 0.0::double AS gradient
            UNION ALL SELECT feature || '=' || category, 0.0 FROM vocab WHERE frequent UNION ALL SELECT DISTINCT feature || '=infrequent', 0.0 FROM vocab WHERE NOT frequent"""),
        "first_split_gains": "WITH " + _gains(),
        "isotonic_rates": "WITH " + SCORED + "," + ISOTONIC,
        "stream_label_join": _with(LOGS, "SELECT request_id, encounter_id, round(score, 6) AS score, model_version, readmitted_30d FROM live"),
        "stream_unlabelled": _with(LOGS + f""",
            told AS (SELECT * FROM llog WHERE encounter_id NOT IN (SELECT encounter_id FROM enc WHERE {among('discharge_disposition_id', P.exclude_discharge_ids)})),
            seen AS (SELECT least((SELECT max(ts) FROM plog), (SELECT max(ts) FROM told)) - interval 1 day AS until)""",
            """SELECT request_id, encounter_id, round(score, 6) AS score, model_version FROM plog, seen WHERE plog.ts + interval 60 day < until
            AND NOT EXISTS (SELECT 1 FROM told WHERE told.encounter_id = plog.encounter_id AND told.ts BETWEEN plog.ts - interval 60 day AND plog.ts + interval 60 day)"""),
        "stream_quarantine": _with(REQUESTS, """SELECT unnest(reasons) AS reason, count(*) AS n FROM judged_req GROUP BY 1
            UNION ALL SELECT 'accepted', count(*) FROM judged_req WHERE len(reasons) = 0"""),
        "stream_scores": _with(REQUESTS + f""",
            scored_req AS (SELECT * REPLACE (CASE WHEN encounter_id % 149 = 0 THEN '785.4' ELSE diag_1 END AS diag_1) FROM judged_req WHERE len(reasons) = 0)""",
            f"SELECT encounter_id, round({LACE_SQL} / 19.0::double, 6) AS score, 'lace' AS model_version FROM scored_req"),
        "stream_telemetry": _with(REQ + f""",
            sums AS (SELECT endpoint, sec // 60 * 60 AS s, count(*) AS requests, count(*) FILTER (WHERE status >= 500) AS errors, count(*) FILTER (WHERE status = 422) AS invalid FROM req GROUP BY 1, 2),
            wide AS (SELECT endpoint, w_start, cast(sum(requests) AS bigint) AS requests, cast(sum(errors) AS bigint) AS errors, cast(sum(invalid) AS bigint) AS invalid
                FROM (SELECT *, unnest(generate_series(s - 240, s, 60)) AS w_start FROM sums) GROUP BY 1, 2),
            {','.join(bucket_quantiles(f"endpoint = '{e}'", f'q{i}', 'latency_s', LATENCY_EDGES, {'p50': 0.5, 'p95': 0.95}, 300, 60) for i, e in enumerate(ENDPOINTS))},
            qs AS ({' UNION ALL '.join(f"SELECT '{e}' AS endpoint, * FROM q{i}" for i, e in enumerate(ENDPOINTS))})""",
            "SELECT w_start, endpoint, requests, errors, invalid, round(p50, 6) AS p50, round(p95, 6) AS p95 FROM wide JOIN qs USING (endpoint, w_start)"),
        "slo_report": _with(REQ + f""",
            m AS (SELECT count(*) AS requests, quantile_cont(latency_s * 1000, [0.5, 0.95, 0.99]) AS p, avg(CASE WHEN status <> 200 THEN 1.0::double ELSE 0 END) AS errors,
                (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6 AS seconds FROM req),
            r AS (SELECT requests, round(p[1], 2) AS p50_ms, round(p[2], 2) AS p95_ms, round(p[3], 2) AS p99_ms, round(requests / seconds, 5) AS throughput_rps, round(errors, 4) AS error_rate FROM m),
            v AS (SELECT *, p50_ms <= {P.slo_p50_ms} AS p50_met, p95_ms <= {P.slo_p95_ms} AS p95_met, throughput_rps >= {P.slo_min_rps} AS throughput_met, error_rate <= {P.slo_error_rate} AS errors_met FROM r)""",
            "SELECT *, p50_met AND p95_met AND throughput_met AND errors_met AS all_met FROM v"),
    }
