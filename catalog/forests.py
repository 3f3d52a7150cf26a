"""Queries over a fixed forest and over calibration, each beside its SQL."""

from __future__ import annotations

from itertools import combinations
from math import factorial

from pyspark.sql import functions as F

from catalog import bind
from catalog.modelling import _SCORED
from catalog.shape import plain
from staylens import schema as S
from staylens.functions import clinical
from staylens.plans import calibrate, forest, score, train

K, C = "o_orderkey", "o_custkey"
NAMES = ["acuity", "hr_min", "spo2_min", "fever_count", "sbp_min"]
MEDIANS = {"acuity": 2.0, "hr_min": 0.0, "spo2_min": 0.5, "fever_count": 1.0, "sbp_min": 0.0}
BASE, SLOPE, SHIFT = -0.25, 1.5, 0.25

# A forest made by hand: (feature, threshold, left, right, value, cover); a leaf has no
# feature. Paths ask for one feature twice, and one tree is a single leaf.
TREES = [
    [("acuity", 2, 1, 2, 0, 97), ("hr_min", 0, 3, 4, 0, 59), ("acuity", 3, 5, 6, 0, 38), (None, 0, 0, 0, -0.5, 23),
     ("spo2_min", 1, 7, 8, 0, 36), (None, 0, 0, 0, 0.25, 11), (None, 0, 0, 0, 0.75, 27), (None, 0, 0, 0, -0.125, 17), (None, 0, 0, 0, 0.375, 19)],
    [("sbp_min", -1.5, 1, 2, 0, 83), ("fever_count", 0.5, 3, 4, 0, 53), (None, 0, 0, 0, -0.625, 30), (None, 0, 0, 0, 0.5, 22), (None, 0, 0, 0, 1.0, 31)],
    [(None, 0, 0, 0, 0.125, 10)],
    [("spo2_min", -2, 1, 2, 0, 67), (None, 0, 0, 0, 0.25, 17), ("spo2_min", 3, 3, 4, 0, 50), ("acuity", 1, 5, 6, 0, 33),
     (None, 0, 0, 0, -0.25, 17), (None, 0, 0, 0, -0.75, 9), (None, 0, 0, 0, 0.625, 24)],
]


def bundle(features: list[str]) -> train.Bundle:
    place = {n: i for i, n in enumerate(features)}
    trees = [forest.tree([(place.get(f, -1), t, a, b, v, c, 0.0) for f, t, a, b, v, c in nodes]) for nodes in TREES]
    facts = {"model_name": "fixed", "model_version": "1", "classification_threshold": 0.4, "calibration_method": "sigmoid"}
    medians = {n: MEDIANS.get(n, 0.0) for n in features}
    return train.Bundle(forest.Forest(features, trees, BASE), calibrate.Sigmoid(SLOPE, SHIFT), medians, features, facts)


_VALUES = {
    "acuity": f"CAST({K} % 5 AS DOUBLE)", "hr_min": f"CAST({C} % 7 - 3 AS DOUBLE)", "spo2_min": f"CAST(({K} + {C}) % 11 - 5 AS DOUBLE)",
    "fever_count": f"CASE WHEN {C} % 3 <> 0 THEN CAST({K} % 3 AS DOUBLE) END", "sbp_min": f"CAST({K} % 13 - 6.5 AS DOUBLE)",
}
_ROWS = f"SELECT {K} AS stay_id, {C} AS subject_id, {', '.join(f'{e} AS {n}' for n, e in _VALUES.items())} FROM "


# --- the forest in SQL ---------------------------------------------------------------------

def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _value(nodes: list[tuple], known: set[str], at: int = 0) -> str:
    """A tree that asks the known features and averages over the others by cover."""
    f, cut, left, right, value, cover = nodes[at]
    if f is None:
        return _d(float(value))
    yes, no = _value(nodes, known, left), _value(nodes, known, right)
    if f in known:
        return f"(CASE WHEN x_{f} <= {_d(float(cut))} THEN {yes} ELSE {no} END)"
    return f"({_d(nodes[left][5] / cover)} * {yes} + {_d(nodes[right][5] / cover)} * {no})"


def _shapley(name: str) -> str:
    """The value of a feature by its definition, over all subsets of each tree's features."""
    terms = []
    for nodes in TREES:
        used = sorted({n[0] for n in nodes if n[0]})
        others = [f for f in used if f != name]
        if name not in used:
            continue
        for size in range(len(others) + 1):
            weight = factorial(size) * factorial(len(used) - size - 1) / factorial(len(used))
            for chosen in combinations(others, size):
                terms.append(f"{_d(weight)} * ({_value(nodes, {*chosen, name})} - {_value(nodes, set(chosen))})")
    return " + ".join(terms)


_FILLED = ", ".join(f"coalesce({n}, {_d(m)}) AS x_{n}" for n, m in MEDIANS.items())
_MARGIN = " + ".join([_d(BASE), *[_value(nodes, set(NAMES)) for nodes in TREES]])
_EXPECTED = " + ".join([_d(BASE), *[_value(nodes, set()) for nodes in TREES]])
_RAW = f"1 / (1 + exp(-({_MARGIN})))"
_SCORE = f"1 / (1 + exp(-({_d(SLOPE)} * raw + {_d(SHIFT)})))"
_BAND = "CASE WHEN score >= 0.7 THEN 'HIGH' WHEN score >= 0.4 THEN 'MODERATE' ELSE 'LOW' END"


def _store(spark, sf):
    return bind.run_sql(spark, sf, _ROWS + "{orders}")


def q_forest_scores(spark, sf):
    """Stored encounters, scored in generated code."""
    out = score.score_table(_store(spark, sf), bundle(NAMES))
    return plain(out.select("stay_id", "subject_id", "model_name", "model_version", "risk_score", "predicted_target", "risk_label", "threshold_used"))


O_FOREST_SCORES = f"""
SELECT stay_id, subject_id, 'fixed' AS model_name, '1' AS model_version, CAST(CAST(round(score, 5) AS DECIMAL(6,5)) AS DOUBLE) AS risk_score,
  CAST(score >= 0.4 AS INT) AS predicted_target, {_BAND} AS risk_label, CAST(0.4 AS DOUBLE) AS threshold_used
FROM (SELECT *, {_SCORE} AS score FROM (SELECT *, {_RAW} AS raw FROM (SELECT *, {_FILLED} FROM ({_ROWS}orders))))
"""


def q_shapley(spark, sf):
    """Each feature's contribution, and what they add up to."""
    model = bundle(NAMES)
    out = score.with_contributions(_store(spark, sf), model)
    total = F.aggregate("contributions", F.lit(model.model.expected), lambda a, x: a + x)
    return out.select("stay_id", *[F.round(F.col("contributions")[i], 9).alias(n) for i, n in enumerate(NAMES)], F.round(total, 9).alias("margin"), F.round(F.lit(model.model.expected), 9).alias("expected"))


O_SHAPLEY = f"""
SELECT stay_id, {', '.join(f'round({_shapley(n)}, 9) AS {n}' for n in NAMES)}, round({_MARGIN}, 9) AS margin, round({_EXPECTED}, 9) AS expected
FROM (SELECT stay_id, {_FILLED} FROM ({_ROWS}orders))
"""


def _requests(spark, sf):
    """Requests with all features of the contract: now one is missing, now one is unknown."""
    store = _store(spark, sf)
    pairs = [x for n in S.MODEL_FEATURES for x in (F.lit(n), F.col(n) if n in NAMES else F.lit(None).cast("double"))]
    whole = F.create_map(*pairs)
    less = F.map_filter(whole, lambda k, v: ~((F.col("stay_id") % 5 == 1) & (k == "acuity")))
    more = F.when(F.col("stay_id") % 11 == 4, F.map_concat(less, F.create_map(F.lit("extra"), F.lit(1.0)))).otherwise(less)
    subject = [F.lit(None).cast("string").alias(n) for n in ("patient_id", "encounter_id", "stay_id")]
    return store.select(F.col("stay_id").cast("string").alias("request_id"), F.struct(*subject, F.lit("orders").alias("source_system")).alias("subject"), more.alias("features"))


def q_forest_envelope(spark, sf):
    """Responses with their snapshot, and the requests that were turned away."""
    good, bad = score.score_requests(_requests(spark, sf), bundle(S.MODEL_FEATURES), include_snapshot=True)
    felt = F.filter("explanation.top_contributors", lambda c: c["contribution"] != 0)
    given = F.filter("explanation.feature_snapshot", lambda c: c["feature_value"].isNotNull())
    out = good.select(
        "request_id", "model.model_name", "model.feature_count", "prediction.risk_score", "prediction.predicted_target", "prediction.risk_label",
        F.array_join(F.transform(felt, lambda c: F.concat_ws(" ", c["feature_name"], F.round(c["contribution"] * 1e6).cast("bigint").cast("string"), c["contribution_direction"])), "|").alias("contributors"),
        F.array_join(F.transform(given, lambda c: F.concat_ws("=", c["feature_name"], (c["feature_value"] * 2).cast("bigint").cast("string"))), "|").alias("doubled_values"),
    )
    errors = bad.select("request_id", "error.error_code", F.array_join("error.missing_features", ",").alias("missing"), F.array_join("error.unknown_features", ",").alias("unknown"))
    return out.unionByName(errors, allowMissingColumns=True)


_IN_ORDER = sorted(NAMES, key=S.MODEL_FEATURES.index)
_ITEMS = ", ".join(f"{{'k': -abs(p_{n}), 'i': {i}, 'n': '{n}', 'c': p_{n}}}" for i, n in enumerate(_IN_ORDER))
O_FOREST_ENVELOPE = f"""
SELECT request_id, CASE WHEN ok THEN 'fixed' END AS model_name, CASE WHEN ok THEN CAST({len(S.MODEL_FEATURES)} AS INT) END AS feature_count,
  CASE WHEN ok THEN round(score, 6) END AS risk_score, CASE WHEN ok THEN CAST(score >= 0.4 AS INT) END AS predicted_target,
  CASE WHEN ok THEN {_BAND} END AS risk_label,
  CASE WHEN ok THEN array_to_string([x.n || ' ' || CAST(CAST(round(x.c * 1000000) AS BIGINT) AS VARCHAR) || CASE WHEN x.c >= 0 THEN ' increases_risk' ELSE ' decreases_risk' END
    for x in list_sort([{_ITEMS}]) if x.c <> 0], '|') END AS contributors,
  CASE WHEN ok THEN concat_ws('|', {', '.join(f"'{n}=' || CAST(CAST({n} * 2 AS BIGINT) AS VARCHAR)" for n in _IN_ORDER)}) END AS doubled_values,
  CASE WHEN NOT ok THEN 'invalid_feature_contract' END AS error_code, CASE WHEN NOT ok THEN CASE WHEN lacks THEN 'acuity' ELSE '' END END AS missing,
  CASE WHEN NOT ok THEN CASE WHEN odd THEN 'extra' ELSE '' END END AS unknown
FROM (SELECT *, NOT (lacks OR odd) AS ok, least({_SCORE}, CAST({clinical.SCORE_CAP} AS DOUBLE)) AS score FROM (
  SELECT *, CAST(stay_id AS VARCHAR) AS request_id, stay_id % 5 = 1 AS lacks, stay_id % 11 = 4 AS odd, {_RAW} AS raw,
    {', '.join(f'round_even(({_shapley(n)}) * 1000000, 0) / 1000000 AS p_{n}' for n in NAMES)}
  FROM (SELECT *, {_FILLED} FROM ({_ROWS}orders))))
"""


# --- calibration ------------------------------------------------------------------------------

def _calibrated(spark, sf, method):
    df = bind.run_sql(spark, sf, _SCORED + "{orders}")
    return df, train.fit_calibrator(df, "label", method, "score")


def q_isotonic(spark, sf):
    """The fit at every score that there is."""
    df, model = _calibrated(spark, sf, "isotonic")
    scores = df.select(F.col("score").alias("_raw_score")).distinct()
    return train.calibrate(model, scores, "calibrated").select(F.col("_raw_score").alias("score"), F.round("calibrated", 9).alias("calibrated"))


# The largest, over all starts, of the smallest mean up to any end.
O_ISOTONIC = f"""
WITH g AS MATERIALIZED (SELECT score, row_number() OVER (ORDER BY score) AS i, SUM(p) OVER w AS sp, SUM(n) OVER w AS sn, p, n
  FROM (SELECT score, SUM(label) AS p, COUNT(*) AS n FROM ({_SCORED}orders) GROUP BY score) WINDOW w AS (ORDER BY score)),
m AS (SELECT a.i AS a, b.i AS b, CAST(b.sp - a.sp + a.p AS DOUBLE) / CAST(b.sn - a.sn + a.n AS DOUBLE) AS mean FROM g a JOIN g b ON b.i >= a.i),
u AS (SELECT a, b, MIN(mean) OVER (PARTITION BY a ORDER BY b DESC ROWS UNBOUNDED PRECEDING) AS low FROM m)
SELECT score, round(MAX(low), 9) AS calibrated FROM u JOIN g ON g.i = u.b GROUP BY score
"""


def q_sigmoid(spark, sf):
    """Slope and shift, and the gradient of the loss at them, which is zero."""
    df, model = _calibrated(spark, sf, "sigmoid")
    size = df.agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") != 1).alias("n"))
    target = F.when(F.col("label") == 1, (F.col("p") + 1) / (F.col("p") + 2)).otherwise(1 / (F.col("n") + 2))
    off = model.column(F.col("score")) - target
    sums = df.crossJoin(F.broadcast(size)).agg(F.avg(off * F.col("score")).alias("g1"), F.avg(off).alias("g0"))  # one row of counts
    return sums.select(F.round(F.lit(model.slope), 5).alias("slope"), F.round(F.lit(model.shift), 5).alias("shift"), (F.greatest(F.abs("g1"), F.abs("g0")) < 1e-8).alias("settled"))


O_SIGMOID = f"""
WITH RECURSIVE g AS MATERIALIZED (SELECT score AS s, CAST(SUM(label) AS DOUBLE) AS p, CAST(COUNT(*) AS DOUBLE) AS n FROM ({_SCORED}orders) GROUP BY score),
t AS MATERIALIZED (SELECT s, n, p * (ones + 1) / (ones + 2) + (n - p) / (zeros + 2) AS w FROM g CROSS JOIN (SELECT SUM(p) AS ones, SUM(n - p) AS zeros FROM g)),
r AS (
  SELECT 0 AS k, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b
  UNION ALL
  SELECT k + 1, a - (h00 * g1 - h10 * g0) / (h11 * h00 - h10 * h10), b - (h11 * g0 - h10 * g1) / (h11 * h00 - h10 * h10) FROM (
    SELECT k, a, b, SUM((n * q - w) * s) AS g1, SUM(n * q - w) AS g0, SUM(n * q * (1 - q) * s * s) AS h11, SUM(n * q * (1 - q) * s) AS h10, SUM(n * q * (1 - q)) AS h00
    FROM (SELECT k, a, b, s, n, w, 1 / (1 + exp(-(a * s + b))) AS q FROM r CROSS JOIN t WHERE k < 25) GROUP BY k, a, b)
)
SELECT round(a, 5) AS slope, round(b, 5) AS shift, true AS settled FROM r WHERE k = 25
"""

QUERIES = {
    "forest_scores": q_forest_scores,
    "forest_envelope": q_forest_envelope,
    "shapley": q_shapley,
    "isotonic": q_isotonic,
    "sigmoid": q_sigmoid,
}
ORACLES = {
    "forest_scores": O_FOREST_SCORES,
    "forest_envelope": O_FOREST_ENVELOPE,
    "shapley": O_SHAPLEY,
    "isotonic": O_ISOTONIC,
    "sigmoid": O_SIGMOID,
}
