"""Table schemas, ranges, business keys and the model feature contract."""

from __future__ import annotations

VITALS = ["temperature", "heartrate", "resprate", "o2sat", "sbp", "dbp"]

_VITAL_DDL = (
    "temperature decimal(5,2), heartrate decimal(6,2), resprate decimal(6,2), "
    "o2sat decimal(6,2), sbp decimal(6,2), dbp decimal(6,2)"
)

# Columns and types of the raw tables.
RAW_SCHEMAS = {
    "ed_stays": (
        "stay_id bigint, subject_id bigint, hadm_id bigint, intime timestamp_ntz, "
        "outtime timestamp_ntz, gender string, race string, arrival_transport string, "
        "disposition string, created_at timestamp_ntz"
    ),
    "triage": (
        f"triage_id bigint, stay_id bigint, subject_id bigint, {_VITAL_DDL}, pain string, "
        "acuity int, chiefcomplaint string, created_at timestamp_ntz"
    ),
    "vital_sign": (
        "vital_id bigint, stay_id bigint, subject_id bigint, charttime timestamp_ntz, "
        f"{_VITAL_DDL}, rhythm string, pain string, created_at timestamp_ntz"
    ),
    "diagnosis": (
        "diagnosis_id bigint, stay_id bigint, subject_id bigint, seq_num int, icd_code string, "
        "icd_version int, icd_title string, created_at timestamp_ntz"
    ),
    "pyxis": (
        "pyxis_id bigint, stay_id bigint, subject_id bigint, charttime timestamp_ntz, "
        "med_rn string, name string, gsn_rn string, gsn string, created_at timestamp_ntz"
    ),
    "med_recon": (
        "med_recon_id bigint, stay_id bigint, subject_id bigint, charttime timestamp_ntz, "
        "name string, gsn string, ndc string, etc_rn string, etccode string, "
        "etcdescription string, created_at timestamp_ntz"
    ),
}
RAW_TABLES = list(RAW_SCHEMAS)
CHILD_TABLES = [t for t in RAW_TABLES if t != "ed_stays"]

PREDICTIONS_SCHEMA = (
    "risk_prediction_id bigint, stay_id bigint, subject_id bigint, model_name string, "
    "model_version string, risk_score decimal(6,5), predicted_target int, risk_label string, "
    "severity_index int, severity_label string, severity_description string, "
    "severity_scale_name string, threshold_used decimal(6,5), top_features string, "
    "created_at timestamp_ntz"
)

# Clinical ranges of the cleaning stage.
CLEAN_RANGES = {
    "temperature": (90, 110),
    "heartrate": (20, 250),
    "resprate": (5, 80),
    "o2sat": (50, 100),
    "sbp": (50, 300),
    "dbp": (20, 200),
    "acuity": (1, 5),
}

# Ranges, rescale steps and clip bounds of the raw-file repair.
RAW_RANGES = {
    "temperature": (85, 110),
    "heartrate": (25, 250),
    "resprate": (5, 60),
    "o2sat": (50, None),
}
RAW_CLIP = {
    "temperature": (85, 110),
    "heartrate": (25, 250),
    "resprate": (5, 60),
    "o2sat": (50, 100),
    "sbp": (60, 300),
    "dbp": (30, 200),
}
RESCALE_STEPS = {
    "temperature": [(200, None, 10)],
    "o2sat": [(1000, None, 10)],
    "sbp": [(1000, None, 10), (1000, None, 10)],
    "dbp": [(10000, None, 1000), (1000, 10000, 100), (200, 1000, 10)],
}
RESCALE_UNTIL = {"sbp": (60, 300), "dbp": (30, 200)}

# Columns that make two rows of a table the same.
BUSINESS_KEYS = {
    "ed_stays": ["stay_id"],
    "triage": ["stay_id"],
    "vital_sign": ["stay_id", "subject_id", "charttime", *VITALS, "rhythm", "pain"],
    "diagnosis": ["stay_id", "subject_id", "seq_num", "icd_code", "icd_version", "icd_title"],
    "pyxis": ["stay_id", "subject_id", "charttime", "med_rn", "name", "gsn_rn", "gsn"],
    "med_recon": [
        "stay_id", "subject_id", "charttime", "name", "gsn", "ndc",
        "etc_rn", "etccode", "etcdescription",
    ],
}

# Columns of which at least one must hold a value.
REQUIRED_ANY = {
    "vital_sign": VITALS,
    "diagnosis": ["icd_code", "icd_title"],
    "pyxis": ["name", "gsn", "med_rn"],
    "med_recon": ["name", "gsn", "ndc", "etcdescription"],
}

UNKNOWN = "Unknown"
UNKNOWN_DIAGNOSIS = "Unknown diagnosis"
GENDERS = {"Male": ["M", "MALE"], "Female": ["F", "FEMALE"]}

# Vital column -> prefix of its summary columns, words used in descriptions.
VITAL_NAMES = {
    "temperature": ("temperature", "temperature", "body temperature"),
    "heartrate": ("hr", "heart rate", "heart rate"),
    "resprate": ("rr", "respiratory rate", "respiratory rate"),
    "o2sat": ("spo2", "oxygen saturation", "oxygen saturation"),
    "sbp": ("sbp", "systolic blood pressure", "systolic blood pressure"),
    "dbp": ("dbp", "diastolic blood pressure", "diastolic blood pressure"),
}

# Event counts over vital rows: output, vital column, comparison, bound.
EVENT_RULES = {
    "tachycardia_count": ("heartrate", ">=", 120),
    "hypotension_count": ("sbp", "<", 90),
    "hypoxia_count": ("o2sat", "<", 92),
    "fever_count": ("temperature", ">=", 100.4),
}

HISTORY_COUNTS = [
    "prior_ed_visit_count", "prior_ed_visit_count_30d", "prior_ed_visit_count_90d",
    "prior_admission_count", "prior_admission_count_1y", "prior_icu_or_death_count",
    "prior_cardiovascular_dx_count", "prior_respiratory_dx_count",
    "prior_endocrine_dx_count", "prior_renal_dx_count",
    "prior_distinct_diagnosis_count", "prior_high_risk_prediction_count",
]
HISTORY_FEATURES = [
    *HISTORY_COUNTS[:3], "time_since_last_ed_visit_days", *HISTORY_COUNTS[3:],
    "last_risk_score", "avg_prior_risk_score", "max_prior_risk_score",
]

# The 67 model inputs, in order.
MODEL_FEATURES = [
    "gender_male", "gender_female", "gender_unknown",
    *[f"triage_{v}" for v in VITALS], "acuity", "triage_shock_index",
    *[f"triage_{v}_missing" for v in VITALS], "acuity_missing",
    "vital_row_count",
    *[f"{p}_{s}" for p, _, _ in VITAL_NAMES.values() for s in ("mean", "min", "max")],
    "shock_index", "shock_index_max", "hr_slope", "bp_slope",
    *EVENT_RULES,
    *[f"{v}_missing_rate" for v in VITALS],
    *HISTORY_FEATURES,
]

# Columns that must not enter the model.
EXCLUDED_COLUMNS = [
    "stay_id", "subject_id", "race", "arrival_transport", "disposition", "has_hadm_id",
    "length_of_stay_hours", "diagnosis_count", "distinct_diagnosis_count",
    "comorbidity_score", "pyxis_med_count", "pyxis_distinct_med_count",
    "med_recon_count", "med_recon_distinct_med_count", "medication_intensity_score",
    "risk_target",
]

CONTRACT_VERSION = "2026-04-29"

# Text of the feature groups.
FEATURE_GROUPS = {
    "demographics": "Patient-level identity-aligned features kept as model-safe one-hot values.",
    "triage": "Initial ED triage measurements available early in the encounter.",
    "vital_summary": "Aggregated vital-sign statistics over the encounter window.",
    "derived_clinical": "Clinically derived features such as shock index.",
    "trend": "Time-aware deterioration or recovery features.",
    "event_count": "Counts of threshold-based instability events across vital rows.",
    "missingness": "Signals describing unavailable data, preserving EHR completeness patterns.",
    "history": (
        "Patient-aware features derived only from prior visits, diagnoses, admissions, and prior "
        "model outputs before the current stay."
    ),
}

# The contract, feature -> (category, type, description, future source).
# fmt: off
FEATURE_SPECS = {
    "gender_male": (
        "demographics", "binary", "One-hot indicator for male sex.",
        "Patient.gender",
    ),
    "gender_female": (
        "demographics", "binary", "One-hot indicator for female sex.",
        "Patient.gender",
    ),
    "gender_unknown": (
        "demographics", "binary", "One-hot indicator when sex is unknown or unavailable.",
        "Patient.gender or missing mapping fallback",
    ),
    "triage_temperature": (
        "triage", "numeric", "Initial triage temperature measurement.",
        "Observation: body temperature",
    ),
    "triage_heartrate": (
        "triage", "numeric", "Initial triage heart rate measurement.",
        "Observation: heart rate",
    ),
    "triage_resprate": (
        "triage", "numeric", "Initial triage respiratory rate measurement.",
        "Observation: respiratory rate",
    ),
    "triage_o2sat": (
        "triage", "numeric", "Initial triage peripheral oxygen saturation.",
        "Observation: oxygen saturation",
    ),
    "triage_sbp": (
        "triage", "numeric", "Initial triage systolic blood pressure.",
        "Observation: systolic blood pressure",
    ),
    "triage_dbp": (
        "triage", "numeric", "Initial triage diastolic blood pressure.",
        "Observation: diastolic blood pressure",
    ),
    "acuity": (
        "triage", "numeric", "Emergency severity or triage acuity score.",
        "Encounter.triage extension or custom Observation",
    ),
    "triage_shock_index": (
        "triage", "numeric", "Shock index derived from triage heart rate divided by systolic blood pressure.",
        "Derived from triage Observations",
    ),
    "triage_temperature_missing": (
        "missingness", "binary", "Indicator that triage temperature is missing.",
        "Derived from absence of Observation",
    ),
    "triage_heartrate_missing": (
        "missingness", "binary", "Indicator that triage heart rate is missing.",
        "Derived from absence of Observation",
    ),
    "triage_resprate_missing": (
        "missingness", "binary", "Indicator that triage respiratory rate is missing.",
        "Derived from absence of Observation",
    ),
    "triage_o2sat_missing": (
        "missingness", "binary", "Indicator that triage oxygen saturation is missing.",
        "Derived from absence of Observation",
    ),
    "triage_sbp_missing": (
        "missingness", "binary", "Indicator that triage systolic blood pressure is missing.",
        "Derived from absence of Observation",
    ),
    "triage_dbp_missing": (
        "missingness", "binary", "Indicator that triage diastolic blood pressure is missing.",
        "Derived from absence of Observation",
    ),
    "acuity_missing": (
        "missingness", "binary", "Indicator that acuity is missing.",
        "Derived from absence of acuity source",
    ),
    "vital_row_count": (
        "vital_summary", "numeric", "Number of time-series vital sign rows available for the encounter.",
        "Observation count over Encounter",
    ),
    "temperature_mean": (
        "vital_summary", "numeric", "Mean temperature across ED vital measurements.",
        "Derived from Observation series",
    ),
    "temperature_min": (
        "vital_summary", "numeric", "Minimum temperature across ED vital measurements.",
        "Derived from Observation series",
    ),
    "temperature_max": (
        "vital_summary", "numeric", "Maximum temperature across ED vital measurements.",
        "Derived from Observation series",
    ),
    "hr_mean": (
        "vital_summary", "numeric", "Mean heart rate across ED vital measurements.",
        "Derived from Observation series",
    ),
    "hr_min": (
        "vital_summary", "numeric", "Minimum heart rate across ED vital measurements.",
        "Derived from Observation series",
    ),
    "hr_max": (
        "vital_summary", "numeric", "Maximum heart rate across ED vital measurements.",
        "Derived from Observation series",
    ),
    "rr_mean": (
        "vital_summary", "numeric", "Mean respiratory rate across ED vital measurements.",
        "Derived from Observation series",
    ),
    "rr_min": (
        "vital_summary", "numeric", "Minimum respiratory rate across ED vital measurements.",
        "Derived from Observation series",
    ),
    "rr_max": (
        "vital_summary", "numeric", "Maximum respiratory rate across ED vital measurements.",
        "Derived from Observation series",
    ),
    "spo2_mean": (
        "vital_summary", "numeric", "Mean oxygen saturation across ED vital measurements.",
        "Derived from Observation series",
    ),
    "spo2_min": (
        "vital_summary", "numeric", "Minimum oxygen saturation across ED vital measurements.",
        "Derived from Observation series",
    ),
    "spo2_max": (
        "vital_summary", "numeric", "Maximum oxygen saturation across ED vital measurements.",
        "Derived from Observation series",
    ),
    "sbp_mean": (
        "vital_summary", "numeric", "Mean systolic blood pressure across ED vital measurements.",
        "Derived from Observation series",
    ),
    "sbp_min": (
        "vital_summary", "numeric", "Minimum systolic blood pressure across ED vital measurements.",
        "Derived from Observation series",
    ),
    "sbp_max": (
        "vital_summary", "numeric", "Maximum systolic blood pressure across ED vital measurements.",
        "Derived from Observation series",
    ),
    "dbp_mean": (
        "vital_summary", "numeric", "Mean diastolic blood pressure across ED vital measurements.",
        "Derived from Observation series",
    ),
    "dbp_min": (
        "vital_summary", "numeric", "Minimum diastolic blood pressure across ED vital measurements.",
        "Derived from Observation series",
    ),
    "dbp_max": (
        "vital_summary", "numeric", "Maximum diastolic blood pressure across ED vital measurements.",
        "Derived from Observation series",
    ),
    "shock_index": (
        "derived_clinical", "numeric", "Average shock index across ED vital measurements.",
        "Derived from Observation series",
    ),
    "shock_index_max": (
        "derived_clinical", "numeric", "Maximum shock index across ED vital measurements.",
        "Derived from Observation series",
    ),
    "hr_slope": (
        "trend", "numeric", "Hourly slope of heart rate over the encounter.",
        "Derived from timestamped heart rate Observations",
    ),
    "bp_slope": (
        "trend", "numeric", "Hourly slope of systolic blood pressure over the encounter.",
        "Derived from timestamped blood pressure Observations",
    ),
    "tachycardia_count": (
        "event_count", "numeric", "Count of vital rows with heart rate at or above tachycardia threshold.",
        "Derived from Observation series",
    ),
    "hypotension_count": (
        "event_count", "numeric", "Count of vital rows with systolic blood pressure below hypotension threshold.",
        "Derived from Observation series",
    ),
    "hypoxia_count": (
        "event_count", "numeric", "Count of vital rows with oxygen saturation below hypoxia threshold.",
        "Derived from Observation series",
    ),
    "fever_count": (
        "event_count", "numeric", "Count of vital rows with temperature in fever range.",
        "Derived from Observation series",
    ),
    "temperature_missing_rate": (
        "missingness", "numeric", "Fraction of vital rows missing temperature.",
        "Derived from Observation completeness",
    ),
    "heartrate_missing_rate": (
        "missingness", "numeric", "Fraction of vital rows missing heart rate.",
        "Derived from Observation completeness",
    ),
    "resprate_missing_rate": (
        "missingness", "numeric", "Fraction of vital rows missing respiratory rate.",
        "Derived from Observation completeness",
    ),
    "o2sat_missing_rate": (
        "missingness", "numeric", "Fraction of vital rows missing oxygen saturation.",
        "Derived from Observation completeness",
    ),
    "sbp_missing_rate": (
        "missingness", "numeric", "Fraction of vital rows missing systolic blood pressure.",
        "Derived from Observation completeness",
    ),
    "dbp_missing_rate": (
        "missingness", "numeric", "Fraction of vital rows missing diastolic blood pressure.",
        "Derived from Observation completeness",
    ),
    "prior_ed_visit_count": (
        "history", "numeric", "Count of prior ED visits for the same patient before the current stay.",
        "Derived from prior Encounter history before current Encounter.start",
    ),
    "prior_ed_visit_count_30d": (
        "history", "numeric", "Count of prior ED visits for the same patient within 30 days before the current stay.",
        "Derived from prior Encounter history before current Encounter.start",
    ),
    "prior_ed_visit_count_90d": (
        "history", "numeric", "Count of prior ED visits for the same patient within 90 days before the current stay.",
        "Derived from prior Encounter history before current Encounter.start",
    ),
    "time_since_last_ed_visit_days": (
        "history", "numeric", "Days since the patient's last ED visit before the current stay.",
        "Derived from prior Encounter timing before current Encounter.start",
    ),
    "prior_admission_count": (
        "history", "numeric", "Count of prior admissions or transfer-to-admit signals before the current ED stay.",
        "Derived from prior Encounter disposition or linked Admission history before current Encounter.start",
    ),
    "prior_admission_count_1y": (
        "history", "numeric", "Count of prior admissions or transfer-to-admit signals within one year before the current ED stay.",
        "Derived from prior Encounter disposition or linked Admission history before current Encounter.start",
    ),
    "prior_icu_or_death_count": (
        "history", "numeric", "Count of prior ICU or death-related disposition signals before the current ED stay.",
        "Derived from prior Encounter disposition history before current Encounter.start",
    ),
    "prior_cardiovascular_dx_count": (
        "history", "numeric", "Count of prior cardiovascular diagnosis rows from visits before the current ED stay.",
        "Derived from prior Condition or diagnosis history before current Encounter.start",
    ),
    "prior_respiratory_dx_count": (
        "history", "numeric", "Count of prior respiratory diagnosis rows from visits before the current ED stay.",
        "Derived from prior Condition or diagnosis history before current Encounter.start",
    ),
    "prior_endocrine_dx_count": (
        "history", "numeric", "Count of prior endocrine diagnosis rows from visits before the current ED stay.",
        "Derived from prior Condition or diagnosis history before current Encounter.start",
    ),
    "prior_renal_dx_count": (
        "history", "numeric", "Count of prior renal diagnosis rows from visits before the current ED stay.",
        "Derived from prior Condition or diagnosis history before current Encounter.start",
    ),
    "prior_distinct_diagnosis_count": (
        "history", "numeric", "Count of distinct prior diagnosis codes recorded before the current ED stay.",
        "Derived from prior Condition or diagnosis history before current Encounter.start",
    ),
    "prior_high_risk_prediction_count": (
        "history", "numeric", "Count of prior model predictions labeled HIGH and created before the current ED stay.",
        "Derived from prior internal model outputs before current Encounter.start",
    ),
    "last_risk_score": (
        "history", "numeric", "Most recent prior model risk score created before the current ED stay.",
        "Derived from prior internal model outputs before current Encounter.start",
    ),
    "avg_prior_risk_score": (
        "history", "numeric", "Average of prior model risk scores created before the current ED stay.",
        "Derived from prior internal model outputs before current Encounter.start",
    ),
    "max_prior_risk_score": (
        "history", "numeric", "Maximum prior model risk score created before the current ED stay.",
        "Derived from prior internal model outputs before current Encounter.start",
    ),
}
# fmt: on
