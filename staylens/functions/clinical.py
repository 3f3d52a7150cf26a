"""Outcome, code and score expressions: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylens.functions.numeric import flag, format_fixed
from staylens.functions.text import contains_any

# Words in a disposition that mark an admission, and an
# intensive-care stay or a death.
ADMISSION_WORDS = ["ADMIT", "TRANSFER"]
ICU_OR_DEATH_WORDS = ["ICU", "DECEASED", "EXPIRED", "DIED"]

# Letter and two-digit prefixes of each diagnosis class.
CODE_CLASSES = {
    "cardiovascular": ("I", range(39, 46)),
    "respiratory": ("J", range(46, 52)),
    "endocrine": ("E", range(24, 28)),
    "renal": ("N", range(58, 63)),
}

# Lower bounds of the bands.
RISK_THRESHOLDS = {"HIGH": 0.70, "MODERATE": 0.40, "LOW": 0.0}
DECISION_THRESHOLD = 0.40
SCORE_CAP = 0.999
SEVERITY_BANDS = [
    (0.85, 1, "ASI-1 Critical", "Immediate clinician review recommended."),
    (0.70, 2, "ASI-2 Very High Risk", "Very high risk; urgent clinician review recommended."),
    (0.55, 3, "ASI-3 High Risk", "High risk; close monitoring recommended."),
    (0.40, 4, "ASI-4 Moderate Risk", "Moderate risk; reassessment may be appropriate."),
    (0.20, 5, "ASI-5 Low Risk", "Low predicted risk based on available data."),
    (None, 6, "ASI-6 Minimal Risk", "Minimal predicted risk based on available data."),
]
SEVERITY_SCALE_NAME = "Acute Severity Index"


def code_class(col: Column, letter: str, prefixes) -> Column:
    """The code starts with the letter or with one of the prefixes."""
    pattern = "^(" + "|".join(str(p) for p in prefixes) + ")"
    return (F.left(col, F.lit(1)) == letter) | col.rlike(pattern)


def code_classes(col: Column) -> dict[str, Column]:
    return {name: code_class(col, *rule) for name, rule in CODE_CLASSES.items()}


def is_admission(hadm_id: Column, disposition: Column) -> Column:
    return hadm_id.isNotNull() | contains_any(disposition, ADMISSION_WORDS)


def is_icu_or_death(disposition: Column) -> Column:
    return contains_any(disposition, ICU_OR_DEATH_WORDS)


def risk_target(hadm_id: Column, disposition: Column) -> Column:
    """1 where the encounter led to admission, transfer, intensive care or death."""
    return flag(is_admission(hadm_id, disposition) | is_icu_or_death(disposition))


def risk_label(score: Column, thresholds: dict[str, float] = RISK_THRESHOLDS) -> Column:
    return (
        F.when(score >= thresholds["HIGH"], "HIGH")
        .when(score >= thresholds["MODERATE"], "MODERATE")
        .otherwise("LOW")
    )


def severity(score: Column, scale_name: str = SEVERITY_SCALE_NAME) -> Column:
    """Struct of index, label, description and scale name."""

    def band(index: int, label: str, description: str) -> Column:
        return F.struct(
            F.lit(index).alias("severity_index"),
            F.lit(label).alias("severity_label"),
            F.lit(description).alias("severity_description"),
            F.lit(scale_name).alias("severity_scale_name"),
        )

    *ranked, (_, *last) = SEVERITY_BANDS
    out = None
    for floor, *rest in ranked:
        hit = score >= floor
        out = F.when(hit, band(*rest)) if out is None else out.when(hit, band(*rest))
    return out.otherwise(band(*last))


def decide(score: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    return (score >= threshold).cast("int")


def cap_score(score: Column) -> Column:
    return F.least(score, F.lit(SCORE_CAP))


def display_score(score: Column, top: float, digits: int) -> Column:
    """``>0.99`` from ``top`` on, else fixed decimals."""
    return F.when(score >= top, ">0.99").otherwise(format_fixed(score, digits))


def display_prediction(score: Column) -> Column:
    return display_score(score, 0.99, 2)


def display_interpretation(score: Column) -> Column:
    return display_score(score, 0.995, 3)
