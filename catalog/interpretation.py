"""Queries over the rule interpretation, on feature rows bound to orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bind
from catalog.oracle import with_ctes
from staylens.functions import clinical
from staylens.operators import arrays
from staylens.plans import interpret as I
from staylens.schema import VITALS, VITAL_NAMES

K, C = "o_orderkey", "o_custkey"


def _f(expr: str, none_every: int) -> str:
    return f"CASE WHEN ({K} + {C}) % {none_every} <> 1 THEN CAST({expr} AS DOUBLE) END"


# One value per feature from the keys of an order: about every rule fires and
# fails, alone and together.
FEATURES = {
    "triage_o2sat": _f(f"86 + ({K} * 7 + {C}) % 15", 9),
    "spo2_mean": _f(f"90 + ({K} * 3 + {C}) % 11", 5),
    "spo2_min": _f(f"87 + ({K} * 5 + {C}) % 14", 4),
    "spo2_max": _f(f"94 + {K} % 7", 6),
    "triage_resprate": _f(f"12 + ({K} + {C}) % 12", 7),
    "rr_mean": _f(f"14 + ({K} * 3 + {C}) % 10", 5),
    "rr_max": _f(f"15 + ({K} * 7) % 18", 3),
    "triage_heartrate": _f(f"70 + ({K} * 11 + {C}) % 45", 8),
    "hr_mean": _f(f"72 + ({K} * 5) % 40 + 0.5", 6),
    "hr_min": _f(f"60 + ({K} * 3 + {C}) % 46", 4),
    "hr_max": _f(f"80 + ({K} * 13) % 50", 5),
    "triage_sbp": _f(f"88 + ({K} * 7) % 60", 7),
    "sbp_mean": _f(f"90 + ({K} * 9 + {C}) % 50", 5),
    "sbp_min": _f(f"82 + ({K} * 11 + {C}) % 60", 4),
    "sbp_max": _f(f"110 + {K} % 40", 6),
    "triage_dbp": _f(f"55 + ({K} * 3) % 30", 5),
    "dbp_mean": _f(f"58 + ({K} * 5) % 34", 4),
    "dbp_min": _f(f"50 + ({C} * 7) % 30", 3),
    "dbp_max": _f(f"70 + ({K} * 7) % 25", 6),
    "triage_temperature": _f(f"96 + ({K} * 7) % 26 * 0.25", 5),
    "temperature_mean": _f(f"97 + ({K} * 5) % 18 * 0.25", 4),
    "temperature_min": _f(f"96 + ({K} * 3 + {C}) % 12 * 0.25", 3),
    "temperature_max": _f(f"98 + ({K} * 11) % 20 * 0.25", 6),
    "triage_shock_index": _f(f"(5000 + ({K} * 37) % 4800) / 10000.0", 5),
    "shock_index": _f(f"(5000 + ({K} * 41 + {C}) % 5000) / 10000.0", 4),
    "shock_index_max": _f(f"(5500 + ({K} * 29 + {C}) % 5000) / 10000.0", 3),
    "hr_slope": _f(f"(({K} * 17) % 500 - 300) / 100.0", 4),
    "bp_slope": _f(f"(({K} * 13 + {C}) % 500 - 250) / 100.0", 3),
    "hypoxia_count": _f(f"greatest(0, {K} % 9 - 5)", 5),
    "tachycardia_count": _f(f"greatest(0, {C} % 8 - 5)", 6),
    "hypotension_count": _f(f"greatest(0, {K} % 11 - 8)", 5),
    "fever_count": _f(f"greatest(0, ({K} + {C}) % 7 - 4)", 4),
    "vital_row_count": _f(f"({K} * 3 + {C}) % 7", 11),
    "acuity": _f(f"1 + {K} % 5", 6),
    "acuity_missing": _f(f"CASE WHEN {K} % 12 = 3 THEN 1 ELSE 0 END", 7),
    **{
        f"triage_{v}_missing": _f(f"CASE WHEN {K} % {i + 4} = 1 THEN 1 ELSE 0 END", 8)
        for i, v in enumerate(VITALS)
    },
    **{
        f"{v}_missing_rate": _f(f"(({K} * {2 * i + 3} + {C}) % 20) / 30.0", 6)
        for i, v in enumerate(VITALS)
    },
}
# Rows with none of the measurements at all show the fallback texts.
_QUIET = f"{K} % 8 = 3"
_KEPT = {"acuity", "acuity_missing", "vital_row_count", "hr_slope", "bp_slope", "hypoxia_count"}
SCORE = "(CAST(FLOOR(o_totalprice) AS BIGINT) % 1001) / 1000.0"


def _column(name: str) -> str:
    expr = FEATURES[name]
    if name in _KEPT and name != "hypoxia_count":
        return f"{expr} AS {name}"
    return f"CASE WHEN NOT ({_QUIET}) THEN {expr} END AS {name}"


FEATURE_SQL = (
    f"SELECT {K}, CAST({SCORE} AS DOUBLE) AS score, "
    + ", ".join(_column(n) for n in FEATURES) + " FROM {orders}"
)


def feature_rows(spark, sf):
    df = bind.run_sql(spark, sf, FEATURE_SQL)
    names = ["hr_slope", "spo2_min", "acuity", "dbp_min", "shock_index_max", "vital_row_count", "bp_slope",
             "rr_mean", "prior_ed_visit_count"]
    items = F.array(
        *[
            F.struct(
                F.lit(n).alias("feature_name"),
                (F.col(n) if n in FEATURES else F.lit(None).cast("double")).alias("feature_value"),
                F.lit(1.0 - i / 10).alias("contribution"),
                F.when(F.expr(f"({K} + {i}) % 3 = 0"), "decreases_risk").otherwise("increases_risk")
                .alias("contribution_direction"),
            )
            for i, n in enumerate(names)
        ]
    )
    return df.withColumn("risk_label", clinical.risk_label(F.col("score"))).withColumn("top", items)


def interpreted(spark, sf):
    stored = bind.written(spark, sf, "interpretation_input", lambda: feature_rows(spark, sf))
    return I.interpret(stored, "score", "risk_label", "top").select(
        K, "clinical_interpretation.*"
    )


INDICATORS = {
    "respiratory": I.RESPIRATORY, "tachycardia": I.TACHYCARDIA, "hemodynamic": I.HEMODYNAMIC,
    "fever": I.FEVER, "shock": I.SHOCK, "limited": I.LIMITED, "deterioration": I.DETERIORATION,
    "sparse": I.SPARSE, "acuity_concern": I.ACUITY_CONCERN, "acuity_context": I.ACUITY_CONTEXT,
}
PATTERNS = {
    "p_respiratory": "Respiratory deterioration pattern",
    "p_hemodynamic": "Hemodynamic instability pattern",
    "p_cardio": "Cardiopulmonary stress pattern",
    "p_sepsis": "Sepsis-like physiology pattern",
    "p_fever": "Fever with physiologic instability",
}


def _severity_columns(array: str, kind: str, names: dict):
    hit = lambda name: F.filter(array, lambda x: x[kind] == name)
    return [F.try_element_at(hit(n), F.lit(1))["severity"].alias(k) for k, n in names.items()]


def q_interpret_indicators(spark, sf):
    return interpreted(spark, sf).select(
        K, *_severity_columns("clinical_indicators", "indicator", INDICATORS),
        F.size("clinical_indicators").alias("indicator_count"),
    )


def q_interpret_patterns(spark, sf):
    return interpreted(spark, sf).select(
        K, *_severity_columns("clinical_patterns", "pattern", PATTERNS),
        F.size("clinical_patterns").alias("pattern_count"),
    )


def q_interpret_evidence(spark, sf):
    rows = arrays.rows_of_array(interpreted(spark, sf), "clinical_indicators", K)
    return rows.select(
        K, "indicator", "severity", F.array_join("evidence", "; ").alias("evidence"), "doctor_message"
    )


def q_interpret_focus(spark, sf):
    return interpreted(spark, sf).select(
        K, F.array_join("recommended_review_focus", "; ").alias("focus")
    )


def q_interpret_sentence(spark, sf):
    return interpreted(spark, sf).select(K, "risk_summary.*").drop("risk_score_note")


def q_data_quality(spark, sf):
    return interpreted(spark, sf).select(K, "data_quality.*").withColumn(
        "missing_features", F.array_join("missing_features", "; ")
    )


def q_interpret_drivers(spark, sf):
    return arrays.rows_of_array(interpreted(spark, sf), "dominant_clinical_drivers", K)


# --- oracle: the rules as plain CASE over the same rows ---------------------------

_FACTS = f"""
SELECT *, CASE WHEN score >= 0.7 THEN 'HIGH' WHEN score >= 0.4 THEN 'MODERATE' ELSE 'LOW' END AS label,
  coalesce(hypoxia_count, 0) AS hyp, coalesce(tachycardia_count, 0) AS tac,
  coalesce(hypotension_count, 0) AS hpt, coalesce(fever_count, 0) AS fev,
  least(triage_o2sat, spo2_mean, spo2_min) AS lo3, least(triage_o2sat, spo2_min) AS lo2,
  greatest(triage_resprate, rr_mean, rr_max) AS hirr, greatest(triage_heartrate, hr_mean, hr_max) AS hihr,
  least(triage_sbp, sbp_mean, sbp_min) AS losbp,
  greatest(triage_temperature, temperature_mean, temperature_max) AS hit,
  least(triage_temperature, temperature_min) AS lot,
  greatest(triage_shock_index, shock_index, shock_index_max) AS si,
  coalesce(hr_min > 100, false) OR coalesce(hr_mean > 100, false) AS persistent,
  coalesce(triage_heartrate > 100, false) OR coalesce(hr_mean > 100, false) AS fast_hr,
  coalesce(triage_resprate > 20, false) OR coalesce(rr_mean > 20, false) AS fast_rr,
  coalesce(sbp_min < 90, false) AS low_sbp_min,
  [x for x in [{', '.join(f"CASE WHEN {v}_missing_rate > 0.5 THEN '{VITAL_NAMES[v][1]}' END" for v in VITALS)}] if x IS NOT NULL] AS missing,
  {' + '.join(f'coalesce(CAST({n} = 1 AS INT), 0)' for n in I.MISSING_FLAGS)} AS flags,
  CAST(vital_row_count AS INT) AS n,
  coalesce(hr_slope >= 1.0, false) AS hr_up, coalesce(bp_slope <= -1.0, false) AS bp_down
FROM ({FEATURE_SQL.replace('{orders}', 'orders')})
"""


def _yes(x: str) -> str:
    return f"coalesce({x}, false)"


def _graded(fires: str, high: str, moderate: str, low: str = "'low'") -> str:
    return f"CASE WHEN {_yes(fires)} THEN CASE WHEN {_yes(high)} THEN 'high' WHEN {_yes(moderate)} THEN 'moderate' ELSE {low} END END"


_TACHY = f"({_yes('hihr > 100')} OR tac > 0)"
_MOVES = "(hr_up OR bp_down)"
_TREND = "(n IS NOT NULL AND (hr_slope IS NOT NULL OR bp_slope IS NOT NULL))"
_RESP_FIRES = f"({_yes('lo3 < 95')} OR hyp > 0 OR {_yes('hirr > 20')})"
_HEMO_FIRES = f"({_yes('losbp < 100')} OR hpt > 0 OR {_yes('si >= 0.9')})"
_FEVER_FIRES = f"({_yes('hit >= 100.4')} OR fev > 0 OR {_yes('lot < 96.8')})"

_SEVERITY = f"""
SELECT *,
  {_graded(_RESP_FIRES, f"{_yes('lo3 < 90')} OR {_yes('hirr >= 30')} OR hyp >= 2", f"{_yes('lo3 <= 94')} OR {_yes('hirr > 20')} OR hyp > 0")} AS respiratory,
  {_graded(_TACHY, f"{_yes('hihr >= 120')} OR ({_yes('hihr > 100')} AND (hyp > 0 OR hpt > 0 OR fev > 0))", f"{_yes('hihr >= 110')} OR persistent")} AS tachycardia,
  {_graded(_HEMO_FIRES, f"{_yes('si >= 1.0')} OR ({_yes('losbp < 90')} AND {_TACHY}) OR (hpt > 0 AND label = 'HIGH')", f"{_yes('losbp < 90')} OR {_yes('si >= 0.9')}")} AS hemodynamic,
  {_graded(_FEVER_FIRES, f"{_yes('hit >= 102.2')} OR (fev > 0 AND ({_yes('si >= 0.9')} OR low_sbp_min OR {_yes('lo2 < 92')}))", f"(fev > 0 AND (fast_hr OR fast_rr)) OR {_yes('hit >= 100.4')}")} AS fever,
  {_graded('si >= 0.7', 'si >= 1.0', 'si >= 0.9')} AS shock,
  CASE WHEN {_TREND} AND n < 3 THEN 'low' END AS limited,
  CASE WHEN {_TREND} AND n >= 3 AND {_MOVES} THEN CASE WHEN hr_up AND bp_down THEN 'high' ELSE 'moderate' END END AS deterioration,
  (len(missing) > 0 OR flags >= 3) AS concern,
  CASE WHEN acuity_missing = 1 THEN CASE WHEN acuity = 5 THEN NULL ELSE 'moderate' END
       WHEN acuity IN (1, 2) THEN 'high' WHEN acuity = 3 AND label IN ('MODERATE', 'HIGH') THEN 'moderate' END AS acuity_concern,
  CASE WHEN coalesce(acuity_missing, 0) <> 1 AND acuity IN (4, 5) THEN 'low' END AS acuity_context,
  ({_RESP_FIRES} OR {_TACHY} OR {_HEMO_FIRES} OR {_FEVER_FIRES} OR {_yes('si >= 0.7')}
     OR ({_TREND} AND n >= 3 AND {_MOVES})) AS other_abnormal
FROM facts
"""
_STRAIN = f"({_yes('si >= 0.9')} OR low_sbp_min)"
_LOW_O2 = _yes("lo2 < 92")
_PATTERN = f"""
SELECT *,
  CASE WHEN concern OR {_yes('n < 2')} THEN CASE WHEN concern AND {_yes('n < 2')} THEN 'high' ELSE 'moderate' END END AS sparse,
  CASE WHEN respiratory IS NOT NULL AND ({_LOW_O2} OR hyp > 0 OR fast_rr)
       THEN CASE WHEN {_yes('lo2 < 90')} OR hyp >= 2 THEN 'high' ELSE 'moderate' END END AS p_respiratory,
  CASE WHEN hemodynamic IS NOT NULL AND (low_sbp_min OR {_yes('si >= 1.0')} OR ({_yes('n >= 3')} AND hr_up AND bp_down))
       THEN 'high' END AS p_hemodynamic,
  CASE WHEN (respiratory IS NOT NULL AND tachycardia IS NOT NULL) OR {_yes('si >= 0.9')}
       THEN CASE WHEN {_yes('si >= 1.0')} OR {_LOW_O2} THEN 'high' ELSE 'moderate' END END AS p_cardio,
  CASE WHEN fever IS NOT NULL AND tachycardia IS NOT NULL AND fast_rr
       THEN CASE WHEN {_STRAIN} THEN 'high' ELSE 'moderate' END END AS p_sepsis,
  CASE WHEN fev > 0 AND (fast_hr OR tac > 0 OR fast_rr OR {_STRAIN})
       THEN CASE WHEN {_STRAIN} THEN 'high' ELSE 'moderate' END END AS p_fever
FROM severity
"""
_EXTRA = {"facts": _FACTS, "severity": _SEVERITY, "findings": _PATTERN}


def _oracle(select: str) -> str:
    return with_ctes(select, _EXTRA)


_COUNT = lambda names: " + ".join(f"CAST({n} IS NOT NULL AS INT)" for n in names)

O_INDICATORS = _oracle(
    f"SELECT {K}, {', '.join(INDICATORS)}, {_COUNT(INDICATORS)} AS indicator_count FROM findings"
)
O_PATTERNS = _oracle(f"SELECT {K}, {', '.join(PATTERNS)}, {_COUNT(PATTERNS)} AS pattern_count FROM findings")


def _num(x: str, digits: int) -> str:
    return f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE printf('%.{digits}f', {x}) END"


def _ev(label: str, x: str, unit: str = "", digits: int = 1) -> str:
    suffix = f" || ' {unit}'" if unit else ""
    return f"CASE WHEN {x} IS NOT NULL THEN '{label}: ' || {_num(x, digits)}{suffix} END"


def _ep(label: str, x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN '{label}: ' || {_num(x, 0)} || ' episodes' END"


_OBS = "CASE WHEN n IS NOT NULL THEN 'Vital observations: ' || n END"
_SLOPES = [
    f"CASE WHEN hr_slope IS NOT NULL THEN 'Heart-rate trend value: ' || {_num('hr_slope', 2)} END",
    f"CASE WHEN bp_slope IS NOT NULL THEN 'Blood-pressure trend value: ' || {_num('bp_slope', 2)} END",
]
_NOTE = f"""CASE WHEN concern THEN '{I.QUALITY_NOTES['concern']}' WHEN n >= 3 THEN '{I.QUALITY_NOTES['repeated']}'
  WHEN n >= 1 THEN '{I.QUALITY_NOTES['few']}' ELSE '{I.QUALITY_NOTES['unclear']}' END"""


def _block(key: str, evidence: list[str], message: str) -> str:
    return f"""SELECT {K}, '{INDICATORS[key]}' AS indicator, {key} AS severity,
  concat_ws('; ', {', '.join(evidence)}) AS evidence, {message} AS doctor_message
FROM findings WHERE {key} IS NOT NULL"""


O_EVIDENCE = _oracle(" UNION ALL ".join([
    _block("respiratory", [
        _ev("Triage SpO2", "triage_o2sat", "%"), _ev("Mean SpO2", "spo2_mean", "%"),
        _ev("Minimum SpO2", "spo2_min", "%"), _ev("Triage respiratory rate", "triage_resprate", "breaths/min"),
        _ev("Mean respiratory rate", "rr_mean", "breaths/min"),
        _ev("Peak respiratory rate", "rr_max", "breaths/min"), _ep("Hypoxia episodes", "hyp")],
        """CASE WHEN lo3 < 95 AND hirr > 20 THEN 'Reduced oxygen saturation with elevated respiratory rate suggests a respiratory compromise signal.'
        WHEN lo3 < 95 THEN 'Oxygen saturation is below ideal range and should be reviewed in clinical context.'
        ELSE 'Respiratory rate is elevated and should be reviewed in clinical context.' END"""),
    _block("tachycardia", [
        _ev("Triage heart rate", "triage_heartrate", "bpm"), _ev("Mean heart rate", "hr_mean", "bpm"),
        _ev("Minimum heart rate", "hr_min", "bpm"), _ev("Peak heart rate", "hr_max", "bpm"),
        _ep("Tachycardia episodes", "tac")],
        """CASE WHEN hihr >= 120 THEN 'Heart rate is markedly elevated, suggesting physiologic stress.'
        WHEN persistent THEN 'Heart rate is persistently elevated, suggesting physiologic stress.'
        ELSE 'Heart rate is elevated and should be reviewed in clinical context.' END"""),
    _block("hemodynamic", [
        _ev("Triage SBP", "triage_sbp", "mmHg"), _ev("Mean SBP", "sbp_mean", "mmHg"),
        _ev("Minimum SBP", "sbp_min", "mmHg"), _ep("Hypotension episodes", "hpt"),
        _ev("Maximum shock index", "si", "", 3)],
        """CASE WHEN losbp < 90 THEN 'Systolic blood pressure is below expected range and may suggest hemodynamic instability.'
        WHEN si >= 0.9 THEN 'Hemodynamic strain markers are elevated and should be reviewed in clinical context.'
        ELSE 'Borderline-low systolic blood pressure should be reviewed in clinical context.' END"""),
    _block("fever", [
        _ev("Triage temperature", "triage_temperature", "°F"), _ev("Mean temperature", "temperature_mean", "°F"),
        _ev("Minimum temperature", "temperature_min", "°F"), _ev("Maximum temperature", "temperature_max", "°F"),
        _ep("Fever episodes", "fev")],
        """CASE WHEN hit >= 100.4 THEN 'Fever signal present; review infection source and clinical context.'
        ELSE 'Temperature pattern is outside expected range and should be reviewed in context.' END"""),
    _block("shock", [
        _ev("Triage shock index", "triage_shock_index", "", 3), _ev("Shock index", "shock_index", "", 3),
        _ev("Maximum shock index", "shock_index_max", "", 3)],
        """CASE WHEN si >= 1.0 THEN 'Shock index is near or above 1.0, which may suggest hemodynamic strain in clinical context.'
        ELSE 'Shock index is elevated and should be reviewed for hemodynamic strain.' END"""),
    _block("limited", [_OBS, *_SLOPES],
        "'Trend interpretation is limited because only ' || n || ' vital-sign observations are available.'"),
    _block("deterioration", [_OBS, *_SLOPES],
        """CASE WHEN hr_up AND bp_down THEN 'Vitals show a possible deterioration pattern with rising heart rate and falling blood pressure.'
        ELSE 'Repeated vital signs show a trend that should be reviewed for possible deterioration.' END"""),
    _block("sparse", [
        _OBS, "CASE WHEN len(missing) > 0 THEN 'High missingness: ' || array_to_string(missing, '; High missingness: ') END",
        "CASE WHEN flags >= 3 THEN 'Missing triage elements: ' || flags END"], _NOTE),
    _block("acuity_concern", [
        "CASE WHEN acuity_missing = 1 THEN 'Triage acuity unavailable' ELSE 'Triage acuity: ' || CAST(acuity AS INT) END"],
        """CASE WHEN acuity_missing = 1 THEN 'Acuity is unavailable; the prediction relies more heavily on vitals and missingness patterns.'
        WHEN acuity <= 2 THEN 'Triage acuity indicates high initial urgency.'
        ELSE 'Triage acuity indicates moderate urgency and should be reviewed with the current physiologic findings.' END"""),
    _block("acuity_context", ["'Triage acuity: ' || CAST(acuity AS INT)"],
        """CASE WHEN acuity = 5 AND NOT other_abnormal THEN 'Triage acuity suggests low initial urgency and reduced the model-estimated risk.'
        ELSE 'Triage acuity suggests lower initial urgency and should be interpreted alongside current clinical findings.' END"""),
]))

_ABNORMAL = "(coalesce(respiratory, tachycardia, hemodynamic, fever, shock, deterioration, acuity_concern, p_respiratory, p_hemodynamic, p_cardio, p_sepsis, p_fever) IS NOT NULL)"
_R = I.REVIEW_FOCUS
O_FOCUS = _oracle(f"""
SELECT {K}, CASE WHEN NOT {_ABNORMAL} THEN CASE WHEN limited IS NOT NULL THEN '{_R['limited_trends']}'
    WHEN label = 'HIGH' THEN '{_R['drivers']}' ELSE '{_R['context']}' END
  ELSE array_to_string([x for x in [
    CASE WHEN coalesce(respiratory, p_respiratory, p_cardio) IS NOT NULL THEN '{_R['respiratory']}' END,
    CASE WHEN coalesce(tachycardia, p_cardio) IS NOT NULL THEN '{_R['tachycardia']}' END,
    CASE WHEN coalesce(hemodynamic, shock, p_hemodynamic, p_cardio) IS NOT NULL THEN '{_R['hemodynamic']}' END,
    CASE WHEN coalesce(deterioration, p_hemodynamic) IS NOT NULL THEN '{_R['trends']}' END,
    CASE WHEN acuity_concern IS NOT NULL OR (acuity_context IS NOT NULL AND other_abnormal) THEN '{_R['triage']}' END,
    CASE WHEN coalesce(fever, p_fever) IS NOT NULL AND p_sepsis IS NULL THEN '{_R['infection']}' END,
    CASE WHEN p_sepsis IS NOT NULL THEN '{_R['sepsis']}' END,
    CASE WHEN sparse IS NOT NULL OR (acuity_missing = 1 AND acuity_concern IS NOT NULL) THEN '{_R['data_quality']}' END
  ] if x IS NOT NULL][1:6], '; ') END AS focus
FROM findings
""")

_DOMAINS = """[x for x in [CASE WHEN respiratory IS NOT NULL THEN 'respiratory' END,
  CASE WHEN tachycardia IS NOT NULL THEN 'heart-rate' END,
  CASE WHEN coalesce(hemodynamic, shock) IS NOT NULL THEN 'hemodynamic strain' END,
  CASE WHEN fever IS NOT NULL THEN 'infection-context' END] if x IS NOT NULL]"""
_BASE = "Lower predicted risk overall, with no major abnormal vital-sign indicators detected."
O_SENTENCE = _oracle(f"""
SELECT {K}, label AS risk_label, CAST(printf('%.6f', score) AS DOUBLE) AS risk_score,
  CASE WHEN score >= 0.995 THEN '>0.99' ELSE printf('%.3f', score) END AS display_risk_score,
  CASE label WHEN 'HIGH' THEN '{I.PRIORITY['HIGH']}' WHEN 'MODERATE' THEN '{I.PRIORITY['MODERATE']}' ELSE '{I.PRIORITY['LOW']}' END AS clinical_priority,
  CASE WHEN NOT abnormal THEN CASE
      WHEN label = 'LOW' AND limited IS NOT NULL THEN '{_BASE} Trend interpretation is limited by sparse repeated measurements.'
      WHEN label = 'LOW' THEN '{_BASE}'
      WHEN label = 'MODERATE' THEN 'Intermediate model risk without major threshold-based vital-sign abnormalities; review model drivers and clinical context.'
      ELSE 'High model-estimated risk, but no major threshold-based vital-sign abnormality is detected in the provided features. Review model drivers, data completeness, and clinical context.' END
    WHEN label = 'HIGH' THEN 'High predicted risk with ' || joined || ' signals.'
    WHEN label = 'MODERATE' THEN 'Intermediate predicted risk; review ' || joined || ' signals.'
    ELSE 'Lower predicted risk overall, with ' || joined || ' findings to review in context.' END AS interpretation
FROM (SELECT *, {_ABNORMAL} AS abnormal,
    CASE len(d) WHEN 0 THEN 'clinical' WHEN 1 THEN d[1] WHEN 2 THEN d[1] || ' and ' || d[2]
      WHEN 3 THEN d[1] || ', ' || d[2] || ', and ' || d[3]
      ELSE d[1] || ', ' || d[2] || ', ' || d[3] || ', and ' || d[4] END AS joined
  FROM (SELECT *, {_DOMAINS} AS d FROM findings))
""")
O_QUALITY = _oracle(f"""
SELECT {K}, n AS vital_observation_count,
  CASE WHEN n IS NULL THEN 'unknown' WHEN n >= 5 THEN 'high' WHEN n >= 3 THEN 'moderate' ELSE 'low' END AS trend_interpretability,
  concern AS missingness_concern, array_to_string(missing, '; ') AS missing_features, {_NOTE} AS data_quality_note
FROM findings
""")

_OK = {
    "hr": " AND ".join(f"coalesce({n} BETWEEN 60 AND 100, true)" for n in I.HR),
    "sbp": " AND ".join(f"coalesce({n} >= 100, true)" for n in I.SBP),
    "dbp": " AND ".join(f"coalesce({n} BETWEEN 60 AND 90, true)" for n in I.DBP),
    "spo2": " AND ".join(f"coalesce({n} >= 95, true)" for n in I.SPO2),
    "si": " AND ".join(f"coalesce({n} < 0.7, true)" for n in I.SHOCKS),
}
_GENERIC = "CASE WHEN down THEN ' reduced the model-estimated risk.' ELSE ' contributed to the model estimate and should be interpreted in clinical context.' END"


def _driver(i: int, name: str, words: str, message: str) -> str:
    kind = "data_context" if name in I.DATA_CONTEXT else "model_signal"
    value = name if name in FEATURES else "CAST(NULL AS DOUBLE)"
    return f"""SELECT {K}, '{name}' AS feature_name, '{words}' AS clinical_meaning, {value} AS feature_value,
  '{kind}' AS driver_type, CASE WHEN down THEN 'decreases_risk' ELSE 'increases_risk' END AS contribution_direction,
  {message} AS doctor_message
FROM (SELECT *, ({K} + {i}) % 3 = 0 AS down FROM facts)"""


O_DRIVERS = _oracle(" UNION ALL ".join([
    _driver(0, "hr_slope", "Heart-rate trend", f"""CASE WHEN {_OK['hr']} THEN 'Heart-rate trend contributed to the model estimate, but absolute heart-rate values remain within expected range.'
      ELSE 'Heart-rate trend contributed to the model estimate alongside abnormal absolute heart-rate values.' END"""),
    _driver(1, "spo2_min", "Lowest oxygen saturation episode", f"""'Lowest oxygen saturation episode' || CASE WHEN down THEN ' reduced the model-estimated risk.'
      WHEN NOT ({_OK['spo2']}) THEN ' was below ideal range and contributed to elevated respiratory risk.'
      ELSE ' contributed to the model estimate, but available oxygenation values remain within expected range.' END"""),
    _driver(2, "acuity", "Triage severity level", f"""CASE WHEN acuity = 5 THEN 'Triage acuity suggests low initial urgency and reduced the model-estimated risk.'
      WHEN acuity IN (1, 2) THEN 'Triage acuity indicates high initial urgency and contributed to the model context.'
      ELSE 'Triage severity level' || {_GENERIC} END"""),
    _driver(3, "dbp_min", "Lowest diastolic blood pressure", f"""'Lowest diastolic blood pressure' || CASE WHEN down AND {_OK['dbp']}
      THEN ' remained within expected range and reduced the model-estimated risk.' ELSE {_GENERIC} END"""),
    _driver(4, "shock_index_max", "Peak hemodynamic strain", f"""'Peak hemodynamic strain' || CASE WHEN down THEN ' reduced the model-estimated risk.'
      WHEN NOT ({_OK['si']}) THEN ' was elevated and contributed to hemodynamic strain risk.'
      ELSE ' contributed to the model estimate, but available shock index values remain within expected range.' END"""),
    _driver(5, "vital_row_count", "Number of vital-sign observations", """CASE WHEN vital_row_count >= 3
      THEN 'Multiple vital-sign observations were available, allowing the model to assess repeated or evolving physiologic patterns.'
      ELSE 'Only limited repeated vital-sign data were available; trend-based interpretation should be cautious.' END"""),
    _driver(6, "bp_slope", "Blood-pressure trend", f"""CASE WHEN {_OK['sbp']} THEN 'Blood-pressure trend contributed to the model estimate, but available blood-pressure values do not meet hypotension thresholds.'
      ELSE 'Blood-pressure trend contributed to the model estimate alongside low or borderline-low systolic blood pressure.' END"""),
    _driver(7, "rr_mean", "Average respiratory rate", f"'Average respiratory rate' || {_GENERIC}"),
    _driver(8, "prior_ed_visit_count", "Prior Ed Visit Count", f"'Prior Ed Visit Count' || {_GENERIC}"),
]))


# --- scores -------------------------------------------------------------------------

def _scored(spark, sf):
    return bind.run_sql(spark, sf, f"SELECT {K}, CAST({SCORE} AS DOUBLE) AS score FROM {{orders}}")


def q_score_bands(spark, sf):
    s = F.col("score")
    return _scored(spark, sf).select(
        K, clinical.risk_label(s).alias("risk_label"), clinical.decide(s).alias("predicted_target"),
        clinical.cap_score(s).alias("capped"),
    )


O_SCORE_BANDS = f"""
SELECT {K}, CASE WHEN score >= 0.7 THEN 'HIGH' WHEN score >= 0.4 THEN 'MODERATE' ELSE 'LOW' END AS risk_label,
  CAST(score >= 0.4 AS INT) AS predicted_target, least(score, 0.999::DOUBLE) AS capped
FROM (SELECT {K}, CAST({SCORE} AS DOUBLE) AS score FROM orders)
"""


def q_severity(spark, sf):
    return _scored(spark, sf).select(K, clinical.severity(F.col("score")).alias("s")).select(K, "s.*")


O_SEVERITY = f"""
SELECT {K}, severity_index, severity_label, severity_description, '{clinical.SEVERITY_SCALE_NAME}' AS severity_scale_name
FROM (SELECT {K}, CASE WHEN score >= 0.85 THEN 1 WHEN score >= 0.7 THEN 2 WHEN score >= 0.55 THEN 3
        WHEN score >= 0.4 THEN 4 WHEN score >= 0.2 THEN 5 ELSE 6 END AS severity_index
      FROM (SELECT {K}, CAST({SCORE} AS DOUBLE) AS score FROM orders))
  JOIN (VALUES {', '.join(f"({i}, '{label}', '{text}')" for _, i, label, text in clinical.SEVERITY_BANDS)})
    AS bands(severity_index, severity_label, severity_description) USING (severity_index)
"""


def q_display_score(spark, sf):
    df = bind.run_sql(
        spark, sf, f"SELECT {K}, CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 10001 AS DOUBLE) / 10000 AS score FROM {{orders}}"
    )
    s = clinical.cap_score(F.col("score"))
    return df.select(
        K, clinical.display_prediction(s).alias("display_prediction"),
        clinical.display_interpretation(s).alias("display_interpretation"),
    )


O_DISPLAY_SCORE = f"""
SELECT {K}, CASE WHEN score >= 0.99 THEN '>0.99' ELSE printf('%.2f', score) END AS display_prediction,
  CASE WHEN score >= 0.995 THEN '>0.99' ELSE printf('%.3f', score) END AS display_interpretation
FROM (SELECT {K}, least(CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 10001 AS DOUBLE) / 10000, 0.999::DOUBLE) AS score FROM orders)
"""

QUERIES = {
    "interpret_indicators": q_interpret_indicators,
    "interpret_patterns": q_interpret_patterns,
    "interpret_evidence": q_interpret_evidence,
    "interpret_focus": q_interpret_focus,
    "interpret_sentence": q_interpret_sentence,
    "interpret_drivers": q_interpret_drivers,
    "data_quality": q_data_quality,
    "score_bands": q_score_bands,
    "severity": q_severity,
    "display_score": q_display_score,
}
ORACLES = {
    "interpret_indicators": O_INDICATORS,
    "interpret_patterns": O_PATTERNS,
    "interpret_evidence": O_EVIDENCE,
    "interpret_focus": O_FOCUS,
    "interpret_sentence": O_SENTENCE,
    "interpret_drivers": O_DRIVERS,
    "data_quality": O_QUALITY,
    "score_bands": O_SCORE_BANDS,
    "severity": O_SEVERITY,
    "display_score": O_DISPLAY_SCORE,
}
