"""Queries over per-stay summaries, histories and the feature store."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bind
from catalog.cleaning import cleaned, cleaned_rows
from catalog.oracle import CTES, with_ctes
from catalog.shape import plain
from staylens import schema as S
from staylens.functions import clinical, numeric
from staylens.operators import aggregates as A
from staylens.operators import history, rows
from staylens.plans import features as P


def feature_plan(spark, sf, history_too: bool = True):
    """The feature store for one pass over it: as written, if it has been already, else as
    a plan, of which Spark leaves out what a query does not ask for. Diagnoses are read
    three times for the histories, from the same shuffle files (``bind.line_order_part``)."""
    if bind.is_written(spark, sf, "feature_store"):
        return feature_store(spark, sf)
    tables = {t: cleaned_rows(spark, sf, t) for t in S.RAW_TABLES}
    return P.feature_store(tables, bind.raw_rows(spark, sf, "risk_predictions"))


def feature_store(spark, sf):
    """The feature store as the feature stage writes it."""
    return bind.written(spark, sf, "feature_store", lambda: feature_plan(spark, sf))


def feature_columns(spark, sf, *columns):
    """Some columns of the feature store for several passes, none of them of the histories."""
    if bind.is_written(spark, sf, "feature_store"):
        return feature_store(spark, sf).select(*columns)
    return bind.written(spark, sf, f"feature_store({columns})", lambda: feature_plan(spark, sf, False).select(*columns))


def q_feature_store(spark, sf):
    return plain(feature_plan(spark, sf).drop("updated_at"))


def q_star_features(spark, sf):
    stays = P.stay_features(cleaned(spark, sf, "ed_stays")).select("stay_id")
    star = rows.star_join(
        stays,
        [P.diagnosis_features(cleaned_rows(spark, sf, "diagnosis")), P.pyxis_features(cleaned_rows(spark, sf, "pyxis"))],
        "stay_id",
    )
    return rows.fill_zero(star, ["diagnosis_count", "pyxis_med_count"])


O_STAR_FEATURES = with_ctes("""
SELECT * REPLACE (coalesce(diagnosis_count, 0) AS diagnosis_count, coalesce(pyxis_med_count, 0) AS pyxis_med_count)
FROM (SELECT stay_id FROM cleaned_ed_stays) LEFT JOIN f_dx USING (stay_id) LEFT JOIN f_pyxis USING (stay_id)
""")


def q_stage_features(spark, sf):
    stays = P.stay_features(cleaned(spark, sf, "ed_stays"))
    triage = P.triage_features(cleaned_rows(spark, sf, "triage"))
    return plain(rows.star_join(stays, [triage], "stay_id"))


O_STAGE_FEATURES = with_ctes("SELECT * FROM f_stay LEFT JOIN f_triage USING (stay_id)")


def q_vital_agg(spark, sf):
    v = P.vital_features(cleaned_rows(spark, sf, "vital_sign"))
    names = ["vital_row_count", *[f"{c}_count" for c in S.VITALS], "shock_index", "shock_index_max"]
    stats = [f"{p}_{s}" for p, _, _ in S.VITAL_NAMES.values() for s in ("mean", "min", "max")]
    return plain(v.select("stay_id", *names, *stats))


def _pick(table: str, like: str) -> str:
    return with_ctes(f"SELECT stay_id, COLUMNS('{like}') FROM {table}")


O_VITAL_AGG = _pick(
    "f_vital",
    "^(vital_row_count|(temperature|heartrate|resprate|o2sat|sbp|dbp)_count|shock_index|shock_index_max|.*_mean|.*_min|.*_max)$",
)


def q_vital_events(spark, sf):
    v = cleaned_rows(spark, sf, "vital_sign")
    events = {**P.event_rules(), "vital_pain_missing_count": F.col("pain").isNull()}
    out = A.per_key(
        v, "stay_id", *A.event_counts(events), *A.time_span("charttime", "first_vital_time", "last_vital_time")
    )
    return plain(out)


O_VITAL_EVENTS = with_ctes(f"""
SELECT f.stay_id, {', '.join(S.EVENT_RULES)}, vital_pain_missing_count, first_vital_time, last_vital_time
FROM f_vital f JOIN (SELECT stay_id, epoch_us(MIN(charttime)) AS first_vital_time,
    epoch_us(MAX(charttime)) AS last_vital_time FROM cleaned_vital_sign GROUP BY stay_id) USING (stay_id)
""")


def q_first_last_slope(spark, sf):
    v = P.vital_features(cleaned_rows(spark, sf, "vital_sign"))
    return plain(
        v.select("stay_id", "hr_first", "hr_last", "hr_slope", "sbp_first", "sbp_last", "bp_slope")
    )


O_FIRST_LAST_SLOPE = _pick("f_vital", "^((hr|sbp)_(first|last)|(hr|bp)_slope)$")


def q_missing_rates(spark, sf):
    v = cleaned_rows(spark, sf, "vital_sign")
    return plain(A.per_key(v, "stay_id", *A.missing_rates(S.VITALS)))


O_MISSING_RATES = _pick("f_vital", ".*_missing_rate$")


def _vitals_by_user(spark, sf):
    """Vital rows of the event stream: few users, each with very many rows."""
    return bind.run_sql(spark, sf, """
SELECT user_id AS stay_id, ts AS charttime, CAST(value AS DECIMAL(6,2)) AS heartrate,
       CAST(3 * CAST(get_json_object(props, '$.k') AS INT) AS DECIMAL(6,2)) AS sbp,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS pain
FROM {events}""")


def q_event_stream_vitals(spark, sf):
    v = rows.guard_ranges(_vitals_by_user(spark, sf), {c: S.CLEAN_RANGES[c] for c in ("heartrate", "sbp")})
    rules = {k: P.event_rules()[k] for k in ("tachycardia_count", "hypotension_count")}
    out = A.per_key(
        v, "stay_id",
        F.count("*").alias("vital_row_count"),
        *A.mean_min_max({"heartrate": "hr", "sbp": "sbp"}),
        *A.ratio_stats(numeric.safe_ratio(F.col("heartrate"), F.col("sbp")), "shock_index", "shock_index_max"),
        *A.event_counts({**rules, "vital_pain_missing_count": F.col("pain").isNull()}),
        *A.first_last("heartrate", "charttime", "hr"),
    )
    return plain(out.withColumn("hr_slope", A.slope_per_hour("hr")).drop("hr_lo", "hr_hi"))


def _event_stream_sql() -> str:
    from catalog.oracle import cents, guard, half_up, _r4, _SI

    base = f"""SELECT stay_id, charttime, pain, {guard('heartrate')}, {guard('sbp')}
FROM (SELECT user_id AS stay_id, ts AS charttime, CAST(value AS DECIMAL(6,2)) AS heartrate,
        CAST(3 * CAST(props->>'$.k' AS INT) AS DECIMAL(6,2)) AS sbp,
        CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS pain FROM events)"""
    mean = {v: half_up(f"SUM({cents(v)})", f"100 * COUNT({v})", 3) for v in ("heartrate", "sbp")}
    change = "(CAST(arg_max(heartrate, charttime) FILTER (WHERE heartrate IS NOT NULL) * 100 AS HUGEINT) - CAST(arg_min(heartrate, charttime) FILTER (WHERE heartrate IS NOT NULL) * 100 AS HUGEINT))"
    span = "(epoch_us(MAX(charttime) FILTER (WHERE heartrate IS NOT NULL)) - epoch_us(MIN(charttime) FILTER (WHERE heartrate IS NOT NULL)))"
    slope = half_up(f"{change} * 36000000", span, 4)
    return f"""
SELECT stay_id, COUNT(*) AS vital_row_count,
       {mean['heartrate']} AS hr_mean, CAST(MIN(heartrate) AS DOUBLE) AS hr_min, CAST(MAX(heartrate) AS DOUBLE) AS hr_max,
       {mean['sbp']} AS sbp_mean, CAST(MIN(sbp) AS DOUBLE) AS sbp_min, CAST(MAX(sbp) AS DOUBLE) AS sbp_max,
       {_r4(f'AVG({_SI})')} AS shock_index, {_r4(f'MAX({_SI})')} AS shock_index_max,
       COUNT(*) FILTER (WHERE heartrate >= 120) AS tachycardia_count,
       COUNT(*) FILTER (WHERE sbp < 90) AS hypotension_count,
       COUNT(*) FILTER (WHERE pain IS NULL) AS vital_pain_missing_count,
       CASE WHEN {span} <> 0 AND abs({slope}) < 10000 THEN {slope} END AS hr_slope
FROM ({base}) GROUP BY stay_id
"""


def q_code_class_flags(spark, sf):
    return P.diagnosis_features(cleaned_rows(spark, sf, "diagnosis"))


def q_distinct_counts(spark, sf):
    p = cleaned_rows(spark, sf, "pyxis")
    counted = A.per_key(
        p, "stay_id", *A.null_counts({"gsn": "missing_gsn"}), distinct={"name": "distinct_names", "gsn": "distinct_gsn"}
    )
    return counted.select("stay_id", "distinct_names", "distinct_gsn", "missing_gsn")


O_DISTINCT_COUNTS = with_ctes("""
SELECT stay_id, COUNT(DISTINCT name) AS distinct_names, COUNT(DISTINCT gsn) AS distinct_gsn,
       COUNT(*) FILTER (WHERE gsn IS NULL) AS missing_gsn
FROM cleaned_pyxis GROUP BY stay_id
""")


def q_med_features(spark, sf):
    meds = P.med_recon_features(cleaned_rows(spark, sf, "med_recon"))
    both = meds.join(P.pyxis_features(cleaned_rows(spark, sf, "pyxis")), "stay_id", "full")
    return both.withColumn(
        "medication_intensity_score",
        numeric.sum_zero(F.col("pyxis_med_count"), F.col("med_recon_count")),
    )


O_MED_FEATURES = with_ctes("""
SELECT *, coalesce(pyxis_med_count, 0) + coalesce(med_recon_count, 0) AS medication_intensity_score
FROM f_med FULL JOIN f_pyxis USING (stay_id)
""")


def q_visit_history(spark, sf):
    return plain(history.visit_history(cleaned(spark, sf, "ed_stays")))


def q_diagnosis_history(spark, sf):
    return plain(
        history.diagnosis_history(cleaned(spark, sf, "ed_stays"), cleaned(spark, sf, "diagnosis"))
    )


def q_prediction_history(spark, sf):
    return plain(
        history.prediction_history(
            cleaned(spark, sf, "ed_stays"), bind.raw_rows(spark, sf, "risk_predictions")
        )
    )


def q_event_history(spark, sf):
    """Earlier events of the same user, and those of the last 30 days: few
    users, each with a large share of all rows."""
    events = bind.source(spark, sf, "events")
    at = numeric.micros(F.col("ts"))
    told = events.select(
        "user_id", at.alias("at"), F.lit(1).cast("bigint").alias("n"),
        numeric.flag(F.col("event_type") == "error").cast("bigint").alias("errors"), at.alias("seen"),
    )
    totals = history.prior_totals(
        events, told, "event_id", "user_id", "ts",
        [
            history.Prior("prior_events", "n"),
            history.Prior("prior_events_30d", "n", lookback="INTERVAL '30' DAY"),
            history.Prior("prior_errors", "errors"),
            history.Prior("last_seen", "seen", "max"),
        ],
    )
    return rows.fill_zero(totals, ["prior_events", "prior_events_30d", "prior_errors"])


O_EVENT_HISTORY = """
SELECT event_id,
       COUNT(*) OVER w AS prior_events,
       COUNT(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 2592000000000 PRECEDING AND 1 PRECEDING) AS prior_events_30d,
       COUNT(*) FILTER (WHERE event_type = 'error') OVER w AS prior_errors,
       MAX(epoch_us(ts)) OVER w AS last_seen
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""


def q_outcome_label(spark, sf):
    stays = cleaned(spark, sf, "ed_stays")
    return stays.select(
        "stay_id",
        clinical.risk_target(F.col("hadm_id"), F.col("disposition")).alias("risk_target"),
        numeric.flag(clinical.is_icu_or_death(F.col("disposition"))).alias("icu_or_death"),
    )


O_OUTCOME_LABEL = with_ctes("""
SELECT f.stay_id, risk_target,
       CAST(regexp_matches(upper(coalesce(f.disposition, '')), 'ICU|DECEASED|EXPIRED|DIED') AS INT) AS icu_or_death
FROM f_stay f
""")


QUERIES = {
    "feature_store": q_feature_store,
    "star_features": q_star_features,
    "stage_features": q_stage_features,
    "vital_agg": q_vital_agg,
    "vital_events": q_vital_events,
    "first_last_slope": q_first_last_slope,
    "missing_rates": q_missing_rates,
    "event_stream_vitals": q_event_stream_vitals,
    "code_class_flags": q_code_class_flags,
    "distinct_counts": q_distinct_counts,
    "med_features": q_med_features,
    "visit_history": q_visit_history,
    "diagnosis_history": q_diagnosis_history,
    "prediction_history": q_prediction_history,
    "event_history": q_event_history,
    "outcome_label": q_outcome_label,
}
ORACLES = {
    "feature_store": with_ctes("SELECT * FROM feature_store"),
    "star_features": O_STAR_FEATURES,
    "stage_features": O_STAGE_FEATURES,
    "vital_agg": O_VITAL_AGG,
    "vital_events": O_VITAL_EVENTS,
    "first_last_slope": O_FIRST_LAST_SLOPE,
    "missing_rates": O_MISSING_RATES,
    "event_stream_vitals": _event_stream_sql(),
    "code_class_flags": with_ctes("SELECT * FROM f_dx"),
    "distinct_counts": O_DISTINCT_COUNTS,
    "med_features": O_MED_FEATURES,
    "visit_history": with_ctes("SELECT * FROM f_visits"),
    "diagnosis_history": with_ctes("SELECT * FROM f_dx_history"),
    "prediction_history": with_ctes("SELECT * FROM f_predictions"),
    "event_history": O_EVENT_HISTORY,
    "outcome_label": O_OUTCOME_LABEL,
}
