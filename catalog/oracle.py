"""Building blocks of the oracle SQL: the reference semantics written the plain
way (row_number, self-joins, ordered aggregates), independent of the Spark plans."""

from __future__ import annotations

import re

from catalog import bind
from staylens import schema as S


def clean(col: str) -> str:
    return rf"nullif(regexp_replace(trim({col}, ' '), '\s+', ' ', 'g'), '')"


def guard(col: str) -> str:
    lo, hi = S.CLEAN_RANGES[col]
    return f"CASE WHEN {col} BETWEEN {lo} AND {hi} THEN {col} END AS {col}"


def half_up(num: str, den: str, scale: int) -> str:
    """num / den of whole numbers, rounded half away from zero, as DOUBLE."""
    n, d, p = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)", 10**scale
    up = f"((2 * abs({n}) * {p} + abs({d})) // (2 * abs({d})))"
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    return f"(CAST({sign} * {up} AS DOUBLE) / {p})"


def cents(col: str) -> str:
    return f"CAST({col} * 100 AS BIGINT)"


_ED_COLS = [
    "stay_id", "subject_id", "hadm_id", "intime", "outtime", "gender", "race",
    "arrival_transport", "disposition", "created_at",
]
_ED_REST = [c for c in _ED_COLS if c not in ("stay_id", "created_at")]

CTES: dict[str, str] = {f"raw_{t}": bind.duck(sql) for t, sql in bind.BINDINGS.items()}

CTES["cleaned_ed_stays"] = f"""
SELECT stay_id, subject_id, hadm_id, intime, outtime,
       CASE WHEN upper({clean('gender')}) IN ('M', 'MALE') THEN 'Male'
            WHEN upper({clean('gender')}) IN ('F', 'FEMALE') THEN 'Female' ELSE 'Unknown' END AS gender,
       {clean('race')} AS race, {clean('arrival_transport')} AS arrival_transport,
       {clean('disposition')} AS disposition, created_at
FROM (
  SELECT *, row_number() OVER (PARTITION BY stay_id ORDER BY
      ({' + '.join(f'CAST({c} IS NOT NULL AS INT)' for c in _ED_COLS)}) DESC,
      created_at DESC NULLS LAST, {', '.join(f'{c} DESC NULLS LAST' for c in _ED_REST)}) AS rn
  FROM raw_ed_stays WHERE stay_id IS NOT NULL AND subject_id IS NOT NULL AND intime IS NOT NULL
) WHERE rn = 1
"""

CTES["cleaned_triage"] = f"""
SELECT stay_id, subject_id, {', '.join(S.VITALS)}, pain, acuity, chiefcomplaint,
       {', '.join(f'{v} IS NULL AS {v}_missing' for v in S.VITALS)}, created_at
FROM (
  SELECT *, row_number() OVER (PARTITION BY stay_id
      ORDER BY created_at ASC NULLS LAST, triage_id ASC NULLS LAST) AS rn
  FROM (
    SELECT t.triage_id, t.stay_id, t.subject_id, {', '.join(guard(c) for c in S.VITALS)},
           coalesce({clean('pain')}, 'Unknown') AS pain, {guard('acuity')},
           coalesce({clean('chiefcomplaint')}, 'Unknown') AS chiefcomplaint, t.created_at
    FROM raw_triage t JOIN (SELECT stay_id FROM cleaned_ed_stays) e USING (stay_id)
    WHERE t.stay_id IS NOT NULL AND t.subject_id IS NOT NULL
  )
) WHERE rn = 1
"""


def _deduped(table: str, columns: list[str], order_id: str, exprs: dict[str, str]) -> str:
    keys = S.BUSINESS_KEYS[table]
    picked = ", ".join(exprs.get(c, f"{c} AS {c}") for c in columns)
    needed = " OR ".join(f"{c} IS NOT NULL" for c in S.REQUIRED_ANY[table])
    title = "coalesce(icd_title, 'Unknown diagnosis')"
    keys_sql = ", ".join(title if k == "icd_title" else k for k in keys)
    out = ", ".join(f"{title} AS icd_title" if c == "icd_title" else c for c in columns)
    return f"""
SELECT {out}, created_at
FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys_sql}
      ORDER BY created_at ASC NULLS LAST, {order_id} ASC NULLS LAST) AS rn
  FROM (
    SELECT {order_id}, {picked}, created_at
    FROM raw_{table} JOIN (SELECT stay_id FROM cleaned_ed_stays) e USING (stay_id)
    WHERE stay_id IS NOT NULL AND subject_id IS NOT NULL
  ) WHERE {needed}
) WHERE rn = 1
"""


def _cleaned_exprs(cols: list[str]) -> dict[str, str]:
    return {c: f"{clean(c)} AS {c}" for c in cols}


CTES["cleaned_vital_sign"] = _deduped(
    "vital_sign", S.BUSINESS_KEYS["vital_sign"], "vital_id",
    {**{v: guard(v) for v in S.VITALS}, **_cleaned_exprs(["rhythm", "pain"])},
)
CTES["cleaned_diagnosis"] = _deduped(
    "diagnosis", S.BUSINESS_KEYS["diagnosis"], "diagnosis_id",
    {"icd_code": f"upper({clean('icd_code')}) AS icd_code", **_cleaned_exprs(["icd_title"])},
)
CTES["cleaned_pyxis"] = _deduped(
    "pyxis", S.BUSINESS_KEYS["pyxis"], "pyxis_id",
    _cleaned_exprs(["med_rn", "name", "gsn_rn", "gsn"]),
)
CTES["cleaned_med_recon"] = _deduped(
    "med_recon", S.BUSINESS_KEYS["med_recon"], "med_recon_id",
    _cleaned_exprs(["name", "gsn", "ndc", "etc_rn", "etccode", "etcdescription"]),
)

# --- features -----------------------------------------------------------------

_SI = "CASE WHEN sbp > 0 THEN CAST(heartrate AS DOUBLE) / CAST(sbp AS DOUBLE) END"


def _r4(x: str) -> str:
    """Half up at four decimals, not tipped by the last bits of a double."""
    return f"(floor({x} * 10000 + 0.5 + 5e-7) / 10000)"


def _stats(vital: str, prefix: str) -> str:
    return f"""
       {half_up(f'SUM({cents(vital)})', f'100 * COUNT({vital})', 3)} AS {prefix}_mean,
       CAST(MIN({vital}) AS DOUBLE) AS {prefix}_min, CAST(MAX({vital}) AS DOUBLE) AS {prefix}_max"""


def _slope(v: str) -> str:
    span = f"(epoch_us({v}_last_time) - epoch_us({v}_first_time))"
    change = f"(CAST({cents(f'{v}_last')} AS HUGEINT) - {cents(f'{v}_first')})"
    slope = half_up(f"{change} * 36000000", span, 4)
    # numeric(8,4) holds no more than 9999.9999
    return f"CASE WHEN {span} <> 0 AND abs({slope}) < 10000 THEN {slope} END"


def _dx(col: str, kind: str) -> str:
    from staylens.functions.clinical import CODE_CLASSES

    letter, prefixes = CODE_CLASSES[kind]
    digits = "|".join(str(p) for p in prefixes)
    return f"(left({col}, 1) = '{letter}' OR regexp_matches({col}, '^({digits})'))"


DX_KINDS = ["cardiovascular", "respiratory", "endocrine", "renal"]


def has_word(col: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"strpos(upper(coalesce({col}, '')), '{w}') > 0" for w in words) + ")"


_ADMIT = f"(p.hadm_id IS NOT NULL OR {has_word('p.disposition', ['ADMIT', 'TRANSFER'])})"
_ICU = has_word("p.disposition", ["ICU", "DECEASED", "EXPIRED", "DIED"])

CTES["f_stay"] = f"""
SELECT stay_id, subject_id, gender, CAST(gender = 'Male' AS INT) AS gender_male,
       CAST(gender = 'Female' AS INT) AS gender_female, CAST(gender = 'Unknown' AS INT) AS gender_unknown,
       race, arrival_transport, disposition, CAST(hadm_id IS NOT NULL AS INT) AS has_hadm_id,
       {half_up('epoch_us(outtime) - epoch_us(intime)', '3600000000', 2)} AS length_of_stay_hours,
       CASE WHEN hadm_id IS NOT NULL
              OR {has_word('disposition', ['ADMIT', 'TRANSFER', 'ICU', 'DECEASED', 'EXPIRED', 'DIED'])}
            THEN 1 ELSE 0 END AS risk_target
FROM cleaned_ed_stays
"""

CTES["f_triage"] = f"""
SELECT stay_id, {', '.join(f'CAST({v} AS DOUBLE) AS triage_{v}' for v in S.VITALS)}, acuity,
       {', '.join(f'CAST({v}_missing AS INT) AS triage_{v}_missing' for v in S.VITALS)},
       CAST(acuity IS NULL AS INT) AS acuity_missing, CAST(pain = 'Unknown' AS INT) AS triage_pain_unknown,
       CAST(chiefcomplaint = 'Unknown' AS INT) AS chiefcomplaint_unknown,
       {_r4(_SI)} AS triage_shock_index
FROM cleaned_triage
"""

CTES["f_vital"] = f"""
SELECT a.*, CAST(hr_first AS DOUBLE) AS hr_first, CAST(hr_last AS DOUBLE) AS hr_last,
       {_slope('hr')} AS hr_slope,
       CAST(sbp_first AS DOUBLE) AS sbp_first, CAST(sbp_last AS DOUBLE) AS sbp_last,
       {_slope('sbp')} AS bp_slope
FROM (
  SELECT stay_id, COUNT(*) AS vital_row_count,
       {', '.join(f'COUNT({v}) AS {v}_count' for v in S.VITALS)},
       {', '.join(_stats(v, names[0]) for v, names in S.VITAL_NAMES.items())},
       {_r4(f'AVG({_SI})')} AS shock_index, {_r4(f'MAX({_SI})')} AS shock_index_max,
       {', '.join(half_up(f'COUNT(*) - COUNT({v})', 'COUNT(*)', 4) + f' AS {v}_missing_rate' for v in S.VITALS)},
       COUNT(*) FILTER (WHERE heartrate >= 120) AS tachycardia_count,
       COUNT(*) FILTER (WHERE sbp < 90) AS hypotension_count,
       COUNT(*) FILTER (WHERE o2sat < 92) AS hypoxia_count,
       COUNT(*) FILTER (WHERE temperature >= 100.4) AS fever_count,
       COUNT(*) FILTER (WHERE pain IS NULL) AS vital_pain_missing_count
  FROM cleaned_vital_sign GROUP BY stay_id
) a LEFT JOIN (
  SELECT stay_id,
    {', '.join(f'''(array_agg({v} ORDER BY charttime ASC, {v} ASC) FILTER (WHERE {v} IS NOT NULL))[1] AS {n}_first,
    (array_agg({v} ORDER BY charttime DESC, {v} DESC) FILTER (WHERE {v} IS NOT NULL))[1] AS {n}_last,
    MIN(charttime) FILTER (WHERE {v} IS NOT NULL) AS {n}_first_time,
    MAX(charttime) FILTER (WHERE {v} IS NOT NULL) AS {n}_last_time''' for v, n in (('heartrate', 'hr'), ('sbp', 'sbp')))}
  FROM cleaned_vital_sign GROUP BY stay_id
) f USING (stay_id)
"""

CTES["f_dx"] = f"""
SELECT stay_id, COUNT(*) AS diagnosis_count, COUNT(DISTINCT icd_code) AS distinct_diagnosis_count,
       MAX(CASE WHEN icd_version = 9 THEN 1 ELSE 0 END) AS has_icd9,
       MAX(CASE WHEN icd_version = 10 THEN 1 ELSE 0 END) AS has_icd10,
       {', '.join(f"MAX(CASE WHEN {_dx('icd_code', k)} THEN 1 ELSE 0 END) AS has_{k}_dx" for k in DX_KINDS)},
       COUNT(*) AS comorbidity_score
FROM cleaned_diagnosis GROUP BY stay_id
"""

CTES["f_pyxis"] = """
SELECT stay_id, COUNT(*) AS pyxis_med_count, COUNT(DISTINCT name) AS pyxis_distinct_med_count,
       COUNT(DISTINCT gsn) FILTER (WHERE gsn IS NOT NULL) AS pyxis_distinct_gsn_count,
       COUNT(*) FILTER (WHERE gsn IS NULL) AS pyxis_missing_gsn_count
FROM cleaned_pyxis GROUP BY stay_id
"""

CTES["f_med"] = """
SELECT stay_id, COUNT(*) AS med_recon_count, COUNT(DISTINCT name) AS med_recon_distinct_med_count,
       COUNT(DISTINCT ndc) FILTER (WHERE ndc IS NOT NULL) AS med_recon_distinct_ndc_count,
       COUNT(*) FILTER (WHERE etccode IS NULL) AS med_recon_missing_etccode_count
FROM cleaned_med_recon GROUP BY stay_id
"""

CTES["f_visits"] = f"""
SELECT c.stay_id, COUNT(p.stay_id) AS prior_ed_visit_count,
       COUNT(p.stay_id) FILTER (WHERE p.intime >= c.intime - INTERVAL '30 days') AS prior_ed_visit_count_30d,
       COUNT(p.stay_id) FILTER (WHERE p.intime >= c.intime - INTERVAL '90 days') AS prior_ed_visit_count_90d,
       {half_up('epoch_us(c.intime) - epoch_us(MAX(p.intime))', '86400000000', 4)} AS time_since_last_ed_visit_days,
       COUNT(p.stay_id) FILTER (WHERE {_ADMIT}) AS prior_admission_count,
       COUNT(p.stay_id) FILTER (WHERE {_ADMIT} AND p.intime >= c.intime - INTERVAL '1 year') AS prior_admission_count_1y,
       COUNT(p.stay_id) FILTER (WHERE {_ICU}) AS prior_icu_or_death_count
FROM cleaned_ed_stays c LEFT JOIN cleaned_ed_stays p
  ON c.subject_id = p.subject_id AND p.intime < c.intime
GROUP BY c.stay_id, c.intime
"""

CTES["f_dx_history"] = f"""
SELECT c.stay_id,
       {', '.join(f"COUNT(*) FILTER (WHERE {_dx('d.icd_code', k)}) AS prior_{k}_dx_count" for k in DX_KINDS)},
       COUNT(DISTINCT d.icd_code) FILTER (WHERE d.icd_code IS NOT NULL) AS prior_distinct_diagnosis_count
FROM cleaned_ed_stays c
  LEFT JOIN cleaned_ed_stays p ON c.subject_id = p.subject_id AND p.intime < c.intime
  LEFT JOIN cleaned_diagnosis d ON p.stay_id = d.stay_id
GROUP BY c.stay_id
"""

CTES["latest_predictions"] = """
SELECT stay_id, subject_id, risk_score, risk_label, created_at
FROM (
  SELECT *, row_number() OVER (PARTITION BY stay_id
      ORDER BY created_at DESC NULLS FIRST, risk_prediction_id DESC NULLS FIRST) AS rn
  FROM raw_risk_predictions
) WHERE rn = 1
"""

CTES["f_predictions"] = f"""
SELECT c.stay_id,
       COUNT(p.stay_id) FILTER (WHERE p.risk_label = 'HIGH') AS prior_high_risk_prediction_count,
       CAST((array_agg(p.risk_score ORDER BY p.created_at DESC, p.stay_id DESC) FILTER (WHERE p.stay_id IS NOT NULL))[1] AS DOUBLE) AS last_risk_score,
       {half_up('SUM(CAST(p.risk_score * 100000 AS BIGINT))', '100000 * COUNT(p.risk_score)', 5)} AS avg_prior_risk_score,
       CAST(MAX(p.risk_score) AS DOUBLE) AS max_prior_risk_score
FROM cleaned_ed_stays c LEFT JOIN latest_predictions p
  ON c.subject_id = p.subject_id AND p.created_at < c.intime
GROUP BY c.stay_id
"""


def _feature_select() -> str:
    from staylens.plans.features import FEATURE_STORE_COLUMNS, ZERO_FILLED

    out = []
    for c in FEATURE_STORE_COLUMNS:
        if c == "updated_at":
            continue
        if c == "medication_intensity_score":
            out.append("coalesce(pyxis_med_count, 0) + coalesce(med_recon_count, 0) AS medication_intensity_score")
        elif c in ZERO_FILLED:
            out.append(f"coalesce({c}, 0) AS {c}")
        else:
            out.append(c)
    return ",\n       ".join(out)


CTES["feature_store"] = f"""
SELECT {_feature_select()}
FROM f_stay LEFT JOIN f_triage USING (stay_id) LEFT JOIN f_vital USING (stay_id)
  LEFT JOIN f_dx USING (stay_id) LEFT JOIN f_pyxis USING (stay_id) LEFT JOIN f_med USING (stay_id)
  LEFT JOIN f_visits USING (stay_id) LEFT JOIN f_dx_history USING (stay_id)
  LEFT JOIN f_predictions USING (stay_id)
"""


def with_ctes(select: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``select`` with every block it needs, in order."""
    blocks = {**CTES, **(extra or {})}
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name, body in blocks.items():
            if name not in needed and body is not sql and re.search(rf"\b{name}\b", sql):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({blocks[n]})" for n in needed) + "\n" + select
