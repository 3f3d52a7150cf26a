"""Queries over splits, metrics, training and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bind
from catalog.features import feature_store
from catalog.oracle import with_ctes
from catalog.shape import plain
from staylens import schema as S
from staylens.operators import arrays, metrics, ranking, rows
from staylens.plans import score, train
from staylens.session import work_dir

K, C = "o_orderkey", "o_custkey"


# --- split, medians, weights -----------------------------------------------------------

def _labelled(spark, sf):
    return bind.run_sql(
        spark, sf, f"SELECT {K}, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM {{orders}}"
    )


def q_stratified_split(spark, sf):
    """Rows per class and share: the counts are exact, the choice is seeded."""
    split = ranking.stratified_split(_labelled(spark, sf), "label", K)
    return split.groupBy("label", "split").agg(F.count("*").alias("row_count"))


O_STRATIFIED_SPLIT = """
SELECT label, split, row_count FROM (
  SELECT label, t, v, n FROM (SELECT label, n, t, CAST(round_even((n - t) * 0.2::DOUBLE, 0) AS BIGINT) AS v
    FROM (SELECT label, n, CAST(round_even(n * 0.2::DOUBLE, 0) AS BIGINT) AS t
      FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, COUNT(*) AS n FROM orders GROUP BY 1)))
) CROSS JOIN LATERAL (VALUES ('test', t), ('validation', v), ('train', n - t - v)) AS s(split, row_count)
"""


def q_split_once(spark, sf):
    """Every key is in one share, whatever order the rows come in."""
    split = ranking.stratified_split(_labelled(spark, sf), "label", K)
    again = ranking.stratified_split(_labelled(spark, sf).orderBy(F.desc(K)), "label", K)
    return split.join(again.select(K, F.col("split").alias("other")), K).groupBy("label").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("split") != F.col("other")).alias("moved")
    )


O_SPLIT_ONCE = """
SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, COUNT(*) AS row_count, CAST(0 AS BIGINT) AS moved
FROM orders GROUP BY 1
"""

_MEDIAN_COLUMNS = [
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "sparse", "tied",
]
_MEDIAN_SQL = (
    "SELECT l_quantity, l_extendedprice, l_discount, l_tax, "
    "CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS sparse, "
    "CASE WHEN l_linenumber < 6 THEN CAST(1 AS DOUBLE) ELSE l_tax END AS tied FROM "
)


def q_median_impute(spark, sf):
    df = bind.run_sql(spark, sf, _MEDIAN_SQL + "{lineitem}")
    fills = train.fit_medians(df, _MEDIAN_COLUMNS)
    filled = train.impute(df, fills)
    return filled.agg(
        *[F.round(F.max(F.lit(fills[c])), 6).alias(f"median_{c}") for c in _MEDIAN_COLUMNS],
        F.count_if(F.col("sparse").isNull()).alias("nulls_left"),
        F.count("*").alias("row_count"),
    )


O_MEDIAN_IMPUTE = (
    "SELECT " + ", ".join(f"round(median({c}), 6) AS median_{c}" for c in _MEDIAN_COLUMNS)
    + ", CAST(0 AS BIGINT) AS nulls_left, COUNT(*) AS row_count FROM (" + _MEDIAN_SQL + "lineitem)"
)


def q_class_weight(spark, sf):
    df = _labelled(spark, sf)
    weight = train.class_weight(train.class_counts(df, "label"))
    return rows.value_counts(df, "label").withColumn("scale_pos_weight", F.round(F.lit(weight), 10))


O_CLASS_WEIGHT = """
SELECT label, COUNT(*) AS row_count,
  round((SELECT CAST(COUNT(*) FILTER (WHERE o_orderstatus <> 'F') AS DOUBLE) / COUNT(*) FILTER (WHERE o_orderstatus = 'F') FROM orders), 10) AS scale_pos_weight
FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders) GROUP BY label
"""


# --- metrics ---------------------------------------------------------------------------

# A score with ties that leans towards the label.
_SCORED = (
    f"SELECT {K}, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, "
    f"CAST((CAST(FLOOR(o_totalprice) AS BIGINT) % 701) + CASE WHEN o_orderstatus = 'F' THEN 250 ELSE 0 END AS DOUBLE) / 1000 AS score FROM "
)


def q_metrics(spark, sf):
    out = metrics.evaluate(bind.run_sql(spark, sf, _SCORED + "{orders}"), "score", "label", 0.4)
    rounded = [c for c, t in out.dtypes if t == "double"]
    return out.select(
        *[F.round(c, 10).alias(c) if c in rounded else F.col(c) for c in out.columns]
    )


O_METRICS = f"""
WITH s AS MATERIALIZED ({_SCORED}orders),
g AS (SELECT score, SUM(label) AS p, COUNT(*) - SUM(label) AS n FROM s GROUP BY score),
w AS (SELECT *, SUM(p) OVER (ORDER BY score DESC) AS tp, SUM(p + n) OVER (ORDER BY score DESC) AS seen FROM g),
c AS (SELECT COUNT(*) FILTER (WHERE score >= 0.4 AND label = 1) AS tp, COUNT(*) FILTER (WHERE score >= 0.4 AND label = 0) AS fp,
  COUNT(*) FILTER (WHERE score < 0.4 AND label = 1) AS fn, COUNT(*) FILTER (WHERE score < 0.4 AND label = 0) AS tn,
  AVG((score - label) * (score - label)) AS brier FROM s)
SELECT round((SELECT CAST(SUM(n * (2 * (tp - p) + p)) AS DOUBLE) / (2.0::DOUBLE * SUM(p) * SUM(n)) FROM w), 10) AS roc_auc,
  round((SELECT SUM(p * CAST(tp AS DOUBLE) / seen) / SUM(p) FROM w), 10) AS pr_auc, round(brier, 10) AS brier_score,
  tn AS confusion_matrix_tn, fp AS confusion_matrix_fp, fn AS confusion_matrix_fn, tp AS confusion_matrix_tp,
  round(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 10) AS accuracy, round(CAST(tp AS DOUBLE) / (tp + fp), 10) AS precision,
  round(CAST(tp AS DOUBLE) / (tp + fn), 10) AS recall, round(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), 10) AS f1_score
FROM c
"""


def q_calibration_table(spark, sf):
    out = metrics.calibration_table(bind.run_sql(spark, sf, _SCORED + "{orders}"), "score", "label")
    return out.select(
        "bin", "row_count", F.round("mean_predicted", 10).alias("mean_predicted"),
        F.round("observed_rate", 10).alias("observed_rate"),
    )


O_CALIBRATION_TABLE = f"""
WITH s AS MATERIALIZED ({_SCORED}orders),
e AS (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM s)
SELECT CAST(b AS INT) AS bin, COUNT(*) AS row_count, round(AVG(score), 10) AS mean_predicted, round(AVG(label), 10) AS observed_rate
FROM (SELECT score, label, len([x for x in (SELECT q FROM e) if x < score]) AS b FROM s) GROUP BY b
"""


# --- contract and contributors -------------------------------------------------------------

_NAMES = ["acuity", "hr_min", "spo2_min", "fever_count", "sbp_min"]
# The features of an order: now one is missing, now one is unknown.
_MAP_SQL = f"""SELECT CAST({K} AS STRING) AS request_id, map_from_entries(filter(array(
  struct(CASE WHEN {K} % 5 <> 1 THEN 'acuity' END, CAST({K} % 5 AS DOUBLE)),
  struct('hr_min', CAST({C} % 7 - 3 AS DOUBLE)),
  struct(CASE WHEN {K} % 7 <> 2 THEN 'spo2_min' ELSE 'spo2' END, CAST(({K} + {C}) % 11 - 5 AS DOUBLE)),
  struct('fever_count', CASE WHEN {C} % 3 = 0 THEN NULL ELSE CAST({K} % 3 AS DOUBLE) END),
  struct('sbp_min', CAST({K} % 13 - 6.5 AS DOUBLE)),
  struct(CASE WHEN {K} % 11 = 4 THEN 'extra' END, CAST(1 AS DOUBLE))), x -> x.col1 IS NOT NULL)) AS features
FROM {{orders}}"""


def q_contract_diff(spark, sf):
    requests = bind.run_sql(spark, sf, _MAP_SQL)
    good, bad = score.quarantine(requests, _NAMES)
    flat = good.select("request_id", *arrays.from_map(F.col("features"), _NAMES))
    reject = bad.select(
        "request_id", "error.error_code", F.array_join("error.missing_features", ",").alias("missing"),
        F.array_join("error.unknown_features", ",").alias("unknown"),
    )
    return flat.unionByName(reject, allowMissingColumns=True)


O_CONTRACT_DIFF = f"""
SELECT r AS request_id, CASE WHEN ok THEN a END AS acuity, CASE WHEN ok THEN h END AS hr_min, CASE WHEN ok THEN s END AS spo2_min,
  CASE WHEN ok THEN f END AS fever_count, CASE WHEN ok THEN b END AS sbp_min,
  CASE WHEN NOT ok THEN 'invalid_feature_contract' END AS error_code,
  CASE WHEN NOT ok THEN concat_ws(',', CASE WHEN m1 THEN 'acuity' END, CASE WHEN m2 THEN 'spo2_min' END) END AS missing,
  CASE WHEN NOT ok THEN concat_ws(',', CASE WHEN u THEN 'extra' END, CASE WHEN m2 THEN 'spo2' END) END AS unknown
FROM (SELECT *, NOT (m1 OR m2 OR u) AS ok FROM (
  SELECT CAST({K} AS VARCHAR) AS r, CAST({K} % 5 AS DOUBLE) AS a, CAST({C} % 7 - 3 AS DOUBLE) AS h, CAST(({K} + {C}) % 11 - 5 AS DOUBLE) AS s,
    CASE WHEN {C} % 3 <> 0 THEN CAST({K} % 3 AS DOUBLE) END AS f, CAST({K} % 13 - 6.5 AS DOUBLE) AS b,
    {K} % 5 = 1 AS m1, {K} % 7 = 2 AS m2, {K} % 11 = 4 AS u FROM orders))
"""


def q_topk_contributors(spark, sf):
    df = bind.source(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    value = {c: F.col(c) for c in cols}
    value["l_discount"] = -F.col("l_discount") * 1e6
    items = F.array(*[F.struct(F.lit(c).alias("name"), value[c].alias("v")) for c in cols])
    top = df.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        F.transform(arrays.top_k_array(items, "v", 2), lambda x: x["name"]).alias("top"),
        arrays.dedupe_cap(F.array("l_returnflag", "l_linestatus", "l_returnflag"), 6).alias("flags"),
    )
    return plain(top)


O_TOPK_CONTRIBUTORS = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
  array_to_string([x.name for x in list_sort([{'k': -abs(q), 'i': 0, 'name': 'l_quantity'}, {'k': -abs(e), 'i': 1, 'name': 'l_extendedprice'},
    {'k': -abs(d), 'i': 2, 'name': 'l_discount'}, {'k': -abs(t), 'i': 3, 'name': 'l_tax'}])[1:2]], '|') AS top,
  l_returnflag || CASE WHEN l_linestatus <> l_returnflag THEN '|' || l_linestatus ELSE '' END AS flags
FROM (SELECT *, l_quantity AS q, l_extendedprice AS e, -l_discount * 1e6 AS d, l_tax AS t FROM lineitem)
"""


def q_top_parts(spark, sf):
    """Global top-k with a full order."""
    per = bind.source(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("row_count"))
    return rows.top_k(per, [F.desc("row_count"), F.col("l_partkey")], 20)


O_TOP_PARTS = """
SELECT l_partkey, COUNT(*) AS row_count FROM lineitem GROUP BY l_partkey ORDER BY row_count DESC, l_partkey LIMIT 20
"""


# --- training and scoring (weaker check: rows only) ---------------------------------------------

PARAMS = train.Params()


def trained(spark, sf) -> tuple[train.Training, str]:
    def build():
        result = train.train(feature_store(spark, sf), "gbt_risk_v2", "check", PARAMS)
        return result, train.save_bundle(result.bundle, work_dir(spark, "bundle"))

    return bind.once(spark, sf, "trained", build)


def q_gbt_scores(spark, sf):
    result, _ = trained(spark, sf)
    return result.scored


def q_model_metrics(spark, sf):
    result, _ = trained(spark, sf)
    return result.metrics


def q_calibrated_scores(spark, sf):
    """Sigmoid calibration of the trained model, on its validation rows."""
    result, _ = trained(spark, sf)
    b = result.bundle
    matrix = train.load_matrix(feature_store(spark, sf), b.features, "risk_target", ["stay_id"])
    split = ranking.stratified_split(matrix, "risk_target", "stay_id")
    raw = train.raw_scores(b.model, train._filled(split, b.features, b.medians))
    sigmoid = train.fit_calibrator(raw.where("split = 'validation'"), "risk_target", "sigmoid")
    return train.calibrate(sigmoid, raw, "score").select("stay_id", "risk_target", "split", "score")


def q_top_importance(spark, sf):
    result, _ = trained(spark, sf)
    return train.importances(result.bundle, spark)


def q_contributions(spark, sf):
    result, _ = trained(spark, sf)
    explained = score.with_contributors(feature_store(spark, sf), result.bundle)
    return arrays.rows_of_array(explained, "top_contributors", "stay_id")


def q_batch_score(spark, sf):
    _, path = trained(spark, sf)
    bundle = train.load_bundle(spark, path)
    top = train.features_json(train.importances(bundle, spark))
    return plain(score.score_table(feature_store(spark, sf), bundle, top).drop("created_at"))


def requests_of(spark, sf):
    """A scoring request per stay of the feature store, in the request schema."""
    fs = feature_store(spark, sf)
    pairs = [x for n in S.MODEL_FEATURES for x in (F.lit(n), F.col(n).cast("double"))]
    return fs.select(
        F.col("stay_id").cast("string").alias("request_id"),
        F.struct(
            F.col("subject_id").cast("string").alias("patient_id"),
            F.lit(None).cast("string").alias("encounter_id"),
            F.col("stay_id").cast("string").alias("stay_id"),
            F.lit("store").alias("source_system"),
        ).alias("subject"),
        F.create_map(*pairs).alias("features"),
    )


def q_envelope(spark, sf):
    result, _ = trained(spark, sf)
    responses, _ = score.score_requests(requests_of(spark, sf), result.bundle)
    return responses.select("request_id", F.to_json(F.struct("*")).alias("response"))


QUERIES = {
    "stratified_split": q_stratified_split,
    "split_once": q_split_once,
    "median_impute": q_median_impute,
    "class_weight": q_class_weight,
    "metrics": q_metrics,
    "calibration_table": q_calibration_table,
    "contract_diff": q_contract_diff,
    "topk_contributors": q_topk_contributors,
    "top_parts": q_top_parts,
    "gbt_scores": q_gbt_scores,
    "model_metrics": q_model_metrics,
    "calibrated_scores": q_calibrated_scores,
    "top_importance": q_top_importance,
    "contributions": q_contributions,
    "batch_score": q_batch_score,
    "envelope": q_envelope,
}
ORACLES = {
    "stratified_split": O_STRATIFIED_SPLIT,
    "split_once": O_SPLIT_ONCE,
    "median_impute": O_MEDIAN_IMPUTE,
    "class_weight": O_CLASS_WEIGHT,
    "metrics": O_METRICS,
    "calibration_table": O_CALIBRATION_TABLE,
    "contract_diff": O_CONTRACT_DIFF,
    "topk_contributors": O_TOPK_CONTRIBUTORS,
    "top_parts": O_TOP_PARTS,
}
