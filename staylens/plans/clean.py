"""Raw tables to cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens import schema as S
from staylens.functions import text
from staylens.operators import rows


def clean_ed_stays(raw: DataFrame) -> DataFrame:
    cols = [c for c in raw.columns]
    best = rows.keep_best(
        rows.require_not_null(raw, ["stay_id", "subject_id", "intime"]), "stay_id", cols, "created_at"
    )
    return rows.clean_columns(best, ["race", "arrival_transport", "disposition"]).withColumn(
        "gender", text.normalize_category(F.col("gender"), S.GENDERS, S.UNKNOWN)
    )


def _children(raw: DataFrame, stays: DataFrame) -> DataFrame:
    return rows.keep_children(rows.require_not_null(raw, ["stay_id", "subject_id"]), stays, "stay_id")


def clean_triage(raw: DataFrame, stays: DataFrame) -> DataFrame:
    # Keep one row first: the rule looks at keys and times only, and the
    # columns are then cleaned for the kept rows alone.
    kept = rows.keep_earliest(_children(raw, stays), ["stay_id"], "created_at", "triage_id")
    guarded = rows.guard_ranges(kept, S.CLEAN_RANGES).withColumns(
        {
            c: text.default_text(text.clean_text(F.col(c)), S.UNKNOWN)
            for c in ("pain", "chiefcomplaint")
        }
    )
    return rows.add_missing_flags(guarded, S.VITALS).select(
        "stay_id", "subject_id", *S.VITALS, "pain", "acuity", "chiefcomplaint",
        *[f"{v}_missing" for v in S.VITALS], "created_at",
    )


def clean_vital_sign(raw: DataFrame, stays: DataFrame) -> DataFrame:
    ranges = {v: S.CLEAN_RANGES[v] for v in S.VITALS}
    guarded = rows.clean_columns(rows.guard_ranges(raw, ranges), ["rhythm", "pain"])
    measured = rows.require_any(guarded, S.REQUIRED_ANY["vital_sign"])
    return rows.dedupe(_children(measured, stays), S.BUSINESS_KEYS["vital_sign"], "created_at")


def clean_diagnosis(raw: DataFrame, stays: DataFrame) -> DataFrame:
    cleaned = raw.withColumns(
        {
            "icd_code": text.clean_code(F.col("icd_code")),
            "icd_title": text.clean_text(F.col("icd_title")),
        }
    )
    known = rows.require_any(cleaned, S.REQUIRED_ANY["diagnosis"]).withColumn(
        "icd_title", text.default_text(F.col("icd_title"), S.UNKNOWN_DIAGNOSIS)
    )
    return rows.dedupe(_children(known, stays), S.BUSINESS_KEYS["diagnosis"], "created_at")


def _clean_texts(raw: DataFrame, stays: DataFrame, table: str) -> DataFrame:
    keys = S.BUSINESS_KEYS[table]
    texts = [c for c in keys if c not in ("stay_id", "subject_id", "charttime")]
    known = rows.require_any(rows.clean_columns(raw, texts), S.REQUIRED_ANY[table])
    return rows.dedupe(_children(known, stays), keys, "created_at")


def clean_pyxis(raw: DataFrame, stays: DataFrame) -> DataFrame:
    return _clean_texts(raw, stays, "pyxis")


def clean_med_recon(raw: DataFrame, stays: DataFrame) -> DataFrame:
    return _clean_texts(raw, stays, "med_recon")


CHILD_CLEANERS = {
    "triage": clean_triage,
    "vital_sign": clean_vital_sign,
    "diagnosis": clean_diagnosis,
    "pyxis": clean_pyxis,
    "med_recon": clean_med_recon,
}


def clean_tables(raw: dict[str, DataFrame], stays: DataFrame | None = None) -> dict[str, DataFrame]:
    """All six cleaned tables. Pass ``stays`` where the cleaned stays are
    already written, so that they are not cleaned again for every child."""
    stays = clean_ed_stays(raw["ed_stays"]) if stays is None else stays
    return {
        "ed_stays": stays,
        **{t: clean(raw[t], stays) for t, clean in CHILD_CLEANERS.items()},
    }
