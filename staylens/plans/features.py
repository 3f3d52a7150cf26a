"""Cleaned tables to one feature row per stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens import schema as S
from staylens.functions import clinical, numeric
from staylens.operators import aggregates as A
from staylens.operators import history, rows


def stay_features(stays: DataFrame) -> DataFrame:
    hours = numeric.elapsed(F.col("intime"), F.col("outtime"), 3600)
    return stays.select(
        "stay_id", "subject_id", "gender",
        *[
            numeric.flag(F.col("gender") == g).alias(f"gender_{g.lower()}")
            for g in (*S.GENDERS, S.UNKNOWN)
        ],
        "race", "arrival_transport", "disposition",
        numeric.flag(F.col("hadm_id").isNotNull()).alias("has_hadm_id"),
        numeric.to_decimal(hours, 10, 2).alias("length_of_stay_hours"),
        clinical.risk_target(F.col("hadm_id"), F.col("disposition")).alias("risk_target"),
    )


def triage_features(triage: DataFrame) -> DataFrame:
    ratio = numeric.safe_ratio(F.col("heartrate"), F.col("sbp"))
    return triage.select(
        "stay_id",
        *[F.col(v).alias(f"triage_{v}") for v in S.VITALS],
        "acuity",
        *[F.col(f"{v}_missing").cast("int").alias(f"triage_{v}_missing") for v in S.VITALS],
        numeric.flag(F.col("acuity").isNull()).alias("acuity_missing"),
        numeric.flag(F.col("pain") == S.UNKNOWN).alias("triage_pain_unknown"),
        numeric.flag(F.col("chiefcomplaint") == S.UNKNOWN).alias("chiefcomplaint_unknown"),
        numeric.double_to_decimal(ratio, 8, 4).alias("triage_shock_index"),
    )


def event_rules() -> dict:
    compare = {">=": lambda c, b: c >= b, "<": lambda c, b: c < b}
    return {
        name: compare[op](F.col(col), F.lit(bound)) for name, (col, op, bound) in S.EVENT_RULES.items()
    }


def vital_features(vitals: DataFrame) -> DataFrame:
    """One aggregate per stay; slopes are arithmetic on its first/last pairs."""
    summary = A.per_key(
        vitals,
        "stay_id",
        F.count("*").alias("vital_row_count"),
        *A.nonnull_counts(S.VITALS),
        *A.mean_min_max({v: prefix for v, (prefix, _, _) in S.VITAL_NAMES.items()}),
        *A.ratio_stats(
            numeric.safe_ratio(F.col("heartrate"), F.col("sbp")), "shock_index", "shock_index_max"
        ),
        *A.event_counts({**event_rules(), "vital_pain_missing_count": F.col("pain").isNull()}),
        *A.missing_rates(S.VITALS),
        *A.first_last("heartrate", "charttime", "hr"),
        *A.first_last("sbp", "charttime", "sbp"),
    )
    return summary.withColumns(
        {
            "hr_first": F.col("hr_lo")["v"],
            "hr_last": F.col("hr_hi")["v"],
            "hr_slope": A.slope_per_hour("hr"),
            "sbp_first": F.col("sbp_lo")["v"],
            "sbp_last": F.col("sbp_hi")["v"],
            "bp_slope": A.slope_per_hour("sbp"),
        }
    ).drop("hr_lo", "hr_hi", "sbp_lo", "sbp_hi")


def diagnosis_features(dx: DataFrame) -> DataFrame:
    flags = {
        "has_icd9": F.col("icd_version") == 9,
        "has_icd10": F.col("icd_version") == 10,
        **{f"has_{c}_dx": hit for c, hit in clinical.code_classes(F.col("icd_code")).items()},
    }
    return A.per_key(
        dx,
        "stay_id",
        F.count("*").alias("diagnosis_count"),
        *A.distinct_counts({"icd_code": "distinct_diagnosis_count"}),
        *A.any_flags(flags),
        F.count("*").alias("comorbidity_score"),
    )


def pyxis_features(pyxis: DataFrame) -> DataFrame:
    return A.per_key(
        pyxis,
        "stay_id",
        F.count("*").alias("pyxis_med_count"),
        *A.null_counts({"gsn": "pyxis_missing_gsn_count"}),
        distinct={"name": "pyxis_distinct_med_count", "gsn": "pyxis_distinct_gsn_count"},
    ).select("stay_id", "pyxis_med_count", "pyxis_distinct_med_count", "pyxis_distinct_gsn_count", "pyxis_missing_gsn_count")


def med_recon_features(med_recon: DataFrame) -> DataFrame:
    return A.per_key(
        med_recon,
        "stay_id",
        F.count("*").alias("med_recon_count"),
        *A.null_counts({"etccode": "med_recon_missing_etccode_count"}),
        distinct={"name": "med_recon_distinct_med_count", "ndc": "med_recon_distinct_ndc_count"},
    ).select("stay_id", "med_recon_count", "med_recon_distinct_med_count", "med_recon_distinct_ndc_count", "med_recon_missing_etccode_count")


# Aggregates that are zero, not NULL, for a stay without rows.
ZERO_FILLED = [
    "vital_row_count", *[f"{v}_count" for v in S.VITALS], *S.EVENT_RULES, "vital_pain_missing_count",
    "diagnosis_count", "distinct_diagnosis_count", "has_icd9", "has_icd10",
    *[f"has_{c}_dx" for c in clinical.CODE_CLASSES], "comorbidity_score",
    "pyxis_med_count", "pyxis_distinct_med_count", "pyxis_distinct_gsn_count",
    "pyxis_missing_gsn_count", "med_recon_count", "med_recon_distinct_med_count",
    "med_recon_distinct_ndc_count", "med_recon_missing_etccode_count",
]

FEATURE_STORE_COLUMNS = [
    "stay_id", "subject_id", "gender", "gender_male", "gender_female", "gender_unknown", "race",
    "arrival_transport", "disposition", "has_hadm_id", "length_of_stay_hours",
    *[f"triage_{v}" for v in S.VITALS], "acuity", *[f"triage_{v}_missing" for v in S.VITALS],
    "acuity_missing", "triage_pain_unknown", "chiefcomplaint_unknown", "triage_shock_index",
    "vital_row_count", *[f"{v}_count" for v in S.VITALS],
    *[f"{p}_{s}" for p, _, _ in S.VITAL_NAMES.values() for s in ("mean", "min", "max")],
    "shock_index", "shock_index_max", "hr_first", "hr_last", "hr_slope", "sbp_first", "sbp_last",
    "bp_slope", *[f"{v}_missing_rate" for v in S.VITALS], *S.EVENT_RULES,
    "vital_pain_missing_count", *ZERO_FILLED[ZERO_FILLED.index("diagnosis_count"):],
    *S.HISTORY_FEATURES, "medication_intensity_score", "risk_target", "updated_at",
]


def feature_store(cleaned: dict[str, DataFrame], predictions: DataFrame) -> DataFrame:
    """The per-stay aggregates joined onto the stays, 108 columns."""
    stays = cleaned["ed_stays"]
    joined = rows.star_join(
        stay_features(stays),
        [
            triage_features(cleaned["triage"]),
            vital_features(cleaned["vital_sign"]),
            diagnosis_features(cleaned["diagnosis"]),
            pyxis_features(cleaned["pyxis"]),
            med_recon_features(cleaned["med_recon"]),
            history.patient_history(stays, cleaned["diagnosis"], predictions),
        ],
        "stay_id",
    )
    filled = rows.fill_zero(joined, ZERO_FILLED + S.HISTORY_COUNTS)
    return filled.withColumns(
        {
            "medication_intensity_score": numeric.sum_zero(
                F.col("pyxis_med_count"), F.col("med_recon_count")
            ),
            "updated_at": F.current_timestamp(),
        }
    ).select(*FEATURE_STORE_COLUMNS)
