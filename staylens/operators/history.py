"""Totals over the strictly earlier rows of an entity.

The obvious forms are a self-join per entity (quadratic) or a window per
entity (one task per entity). Here time is cut into days. The rows of a day
are summed with map-side combine, the day sums are carried forward per entity
(at most one row per calendar day, however many rows the entity has), and only
inside a day are single rows ordered. An entity that holds a third of all rows
is thus spread over its days.

A look-back total over [t - L, t) is the difference of two totals "strictly
before", at t and at t - L, so no sliding frame is evaluated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions import clinical, numeric
from staylens.operators import aggregates, rows

DAY_MICROS = 86_400_000_000


@dataclass(frozen=True)
class Prior:
    """One output column: ``how`` over measure ``value`` of the earlier events.

    ``lookback`` is an SQL interval; only sums can look back.
    """

    name: str
    value: str
    how: str = "sum"
    lookback: str | None = None


def prior_totals(
    spine: DataFrame, events: DataFrame, key: str, entity: str, time: str, priors: list[Prior],
    moment: str | None = None,
) -> DataFrame:
    """One row per spine key with the totals of ``priors``, and with the asked time in
    microseconds if ``moment`` names a column for it.

    ``spine`` has key, entity and a timestamp; ``events`` has the entity, a
    bigint column ``at`` (microseconds) and one column per measure.
    """
    measures = {p.value: p.how for p in priors}
    lookbacks = [None] + sorted({p.lookback for p in priors if p.lookback})
    moments = F.array(
        *[
            F.struct(
                F.lit(i).alias("_ask"),
                numeric.micros(F.col(time) if b is None else F.expr(f"{time} - {b}")).alias("at"),
            )
            for i, b in enumerate(lookbacks)
        ]
    )
    asked = spine.select(key, entity, F.inline(moments))
    told = events.where(F.col("at").isNotNull() & F.col(entity).isNotNull()).select(
        entity, "at", *measures
    )
    placed = asked.where(F.col(entity).isNotNull() & F.col("at").isNotNull())
    timeline = placed.unionByName(told, allowMissingColumns=True).withColumn(
        "_day", F.expr(f"(at - pmod(at, {DAY_MICROS})) div {DAY_MICROS}")
    )
    # Dealt once: days are summed and rows ordered inside them where they lie.
    timeline = rows.held_together(timeline.repartition(entity, "_day"))

    def fold(how: str, col):
        return F.sum(col) if how == "sum" else F.max(col)

    by_day = timeline.groupBy(entity, "_day").agg(
        *[fold(how, F.col(m)).alias(m) for m, how in measures.items()]
    )
    earlier_days = Window.partitionBy(entity).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_day.select(
        entity,
        "_day",
        *[fold(how, F.col(m)).over(earlier_days).alias(f"_days_{m}") for m, how in measures.items()],
    )
    earlier_today = (
        Window.partitionBy(entity, "_day").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    )
    today = timeline.select(
        key,
        entity,
        "_day",
        "_ask",
        "at",
        *[fold(how, F.col(m)).over(earlier_today).alias(f"_today_{m}") for m, how in measures.items()],
    ).where(F.col("_ask").isNotNull())

    def both(m: str, how: str):
        parts = [F.col(f"_days_{m}"), F.col(f"_today_{m}")]
        return numeric.sum_zero(*parts) if how == "sum" else F.greatest(*parts)

    # Rows without entity or time have nothing before them; they need no grouping.
    unplaced = F.col(entity).isNull() | F.col("at").isNull()
    nothing = asked.where(unplaced).select(
        key, "_ask", "at", *[F.lit(0 if how == "sum" else None).alias(m) for m, how in measures.items()]
    )
    answers = today.join(carried, [entity, "_day"]).select(
        key, "_ask", "at", *[both(m, how).alias(m) for m, how in measures.items()]
    ).unionByName(nothing)

    def at(p: Prior, ask: int):
        return F.max(F.when(F.col("_ask") == ask, F.col(p.value)))

    outputs = []
    for p in priors:
        total = at(p, 0)
        if p.lookback is not None:
            total = total - at(p, lookbacks.index(p.lookback))
        outputs.append(total.alias(p.name))
    if moment:
        outputs.append(F.max(F.when(F.col("_ask") == 0, F.col("at"))).alias(moment))
    return answers.groupBy(key).agg(*outputs)


# --- the histories of the encounter model ------------------------------------

VISIT_PRIORS = [
    Prior("prior_ed_visit_count", "visits"),
    Prior("prior_ed_visit_count_30d", "visits", lookback="INTERVAL '30' DAY"),
    Prior("prior_ed_visit_count_90d", "visits", lookback="INTERVAL '90' DAY"),
    Prior("last_visit_at", "visit_at", "max"),
    Prior("prior_admission_count", "admissions"),
    Prior("prior_admission_count_1y", "admissions", lookback="INTERVAL '1' YEAR"),
    Prior("prior_icu_or_death_count", "icu_or_death"),
]
DIAGNOSIS_PRIORS = [
    *[Prior(f"prior_{c}_dx_count", f"{c}_dx") for c in clinical.CODE_CLASSES],
    Prior("prior_distinct_diagnosis_count", "new_codes"),
]
PREDICTION_PRIORS = [
    Prior("prior_high_risk_prediction_count", "high_scores"),
    Prior("last_score", "last_score", "max"),
    Prior("score_count", "score_count"),
    Prior("score_sum", "score_sum"),
    Prior("max_prior_risk_score", "score_max", "max"),
]


def visit_events(stays: DataFrame) -> DataFrame:
    at = numeric.micros(F.col("intime"))
    return stays.select(
        "subject_id",
        at.alias("at"),
        at.alias("visit_at"),
        F.lit(1).cast("bigint").alias("visits"),
        numeric.flag(clinical.is_admission(F.col("hadm_id"), F.col("disposition")))
        .cast("bigint").alias("admissions"),
        numeric.flag(clinical.is_icu_or_death(F.col("disposition"))).cast("bigint").alias("icu_or_death"),
    )


def diagnosis_events(stays: DataFrame, dx: DataFrame) -> DataFrame:
    """Class counts at the time of each stay, and each code once per patient at
    the time it was first seen (so distinct codes need no sets)."""
    when = stays.select("stay_id", "subject_id", numeric.micros(F.col("intime")).alias("at"))
    classes = clinical.code_classes(F.col("icd_code"))
    per_stay = aggregates.per_key(
        dx, "stay_id", *[F.count_if(hit).alias(f"{c}_dx") for c, hit in classes.items()]
    )
    first_seen = (
        dx.where("icd_code is not null")
        .select("stay_id", "icd_code")
        .distinct()
        .join(when, "stay_id")
        .groupBy("subject_id", "icd_code")
        .agg(F.min("at").alias("at"))
        .select("subject_id", "at", F.lit(1).cast("bigint").alias("new_codes"))
    )
    return (
        per_stay.join(when, "stay_id")
        .drop("stay_id")
        .unionByName(first_seen, allowMissingColumns=True)
    )


def prediction_events(predictions: DataFrame) -> DataFrame:
    latest = rows.keep_latest(predictions, ["stay_id"], "created_at", "risk_prediction_id")
    at = numeric.micros(F.col("created_at"))
    score = F.col("risk_score")
    return latest.select(
        "subject_id",
        at.alias("at"),
        numeric.flag(F.col("risk_label") == "HIGH").cast("bigint").alias("high_scores"),
        score.isNotNull().cast("bigint").alias("score_count"),
        score.cast("decimal(18,5)").alias("score_sum"),
        score.alias("score_max"),
        F.struct(at.alias("at"), F.col("stay_id"), score.alias("score")).alias("last_score"),
    )


def _finish(df: DataFrame, names: list[str]) -> DataFrame:
    """Readable columns from the raw totals."""
    outputs = []
    for name in names:
        if name == "time_since_last_ed_visit_days":
            gap = (F.col("_intime") - F.col("last_visit_at")).cast("decimal(38,12)")
            days = gap / F.lit(DAY_MICROS).cast("decimal(18,0)")
            outputs.append(numeric.to_decimal(days, 10, 4).alias(name))
        elif name == "last_risk_score":
            outputs.append(numeric.to_decimal(F.col("last_score")["score"], 8, 5).alias(name))
        elif name == "avg_prior_risk_score":
            mean = numeric.exact_mean(F.col("score_sum"), F.col("score_count"))
            outputs.append(numeric.to_decimal(mean, 8, 5).alias(name))
        elif name == "max_prior_risk_score":
            outputs.append(numeric.to_decimal(F.col(name), 8, 5).alias(name))
        else:
            outputs.append(F.coalesce(F.col(name), F.lit(0)).alias(name))
    return df.select("stay_id", *outputs)


def _history(stays: DataFrame, events: DataFrame, priors: list[Prior], names: list[str]) -> DataFrame:
    spine = stays.select("stay_id", "subject_id", "intime")
    totals = prior_totals(spine, events, "stay_id", "subject_id", "intime", priors, "_intime")
    return _finish(totals, names)


VISIT_COLUMNS = [
    "prior_ed_visit_count", "prior_ed_visit_count_30d", "prior_ed_visit_count_90d",
    "time_since_last_ed_visit_days", "prior_admission_count", "prior_admission_count_1y",
    "prior_icu_or_death_count",
]
DIAGNOSIS_COLUMNS = [p.name for p in DIAGNOSIS_PRIORS]
PREDICTION_COLUMNS = [
    "prior_high_risk_prediction_count", "last_risk_score", "avg_prior_risk_score",
    "max_prior_risk_score",
]


def visit_history(stays: DataFrame) -> DataFrame:
    return _history(stays, visit_events(stays), VISIT_PRIORS, VISIT_COLUMNS)


def diagnosis_history(stays: DataFrame, dx: DataFrame) -> DataFrame:
    return _history(stays, diagnosis_events(stays, dx), DIAGNOSIS_PRIORS, DIAGNOSIS_COLUMNS)


def prediction_history(stays: DataFrame, predictions: DataFrame) -> DataFrame:
    return _history(stays, prediction_events(predictions), PREDICTION_PRIORS, PREDICTION_COLUMNS)


def patient_history(stays: DataFrame, dx: DataFrame, predictions: DataFrame) -> DataFrame:
    """All three histories over one shared timeline."""
    events = (
        visit_events(stays)
        .unionByName(diagnosis_events(stays, dx), allowMissingColumns=True)
        .unionByName(prediction_events(predictions), allowMissingColumns=True)
    )
    return _history(
        stays,
        events,
        VISIT_PRIORS + DIAGNOSIS_PRIORS + PREDICTION_PRIORS,
        VISIT_COLUMNS + DIAGNOSIS_COLUMNS + PREDICTION_COLUMNS,
    )
