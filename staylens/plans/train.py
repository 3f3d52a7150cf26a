"""Training, calibration and evaluation of the risk model."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens import schema as S
from staylens.functions import clinical
from staylens.functions.text import finite
from staylens.operators import metrics, ranking, rows
from staylens.plans import boosting, forest
from staylens.plans.calibrate import Sigmoid, fit_isotonic, fit_sigmoid, score_counts
from staylens.plans.forest import Forest
from staylens.session import cut_lineage


class TrainingInputError(ValueError):
    """The feature table cannot be trained on."""


class BundleError(ValueError):
    """A stored model does not match the serving contract."""


@dataclass
class Params:
    test_size: float = 0.20
    validation_size: float = 0.20
    seed: int = 42
    trees: int = 300
    patience: int = 50
    depth: int = 4
    learning_rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    calibration: str = "isotonic"
    threshold: float = clinical.DECISION_THRESHOLD


@dataclass
class Bundle:
    """Everything that scoring needs. ``metadata`` holds names and settings."""

    model: Forest
    calibrator: IsotonicRegressionModel | Sigmoid
    medians: dict[str, float]
    features: list[str]
    metadata: dict = field(default_factory=dict)


# --- inputs ------------------------------------------------------------------------

def load_matrix(df: DataFrame, features: list[str], label: str, keys: list[str]) -> DataFrame:
    """Keys, features as double and the label, where the label is known."""
    check_columns(df, features)
    return df.where(F.col(label).isNotNull()).select(
        *keys, *[finite(F.col(c).cast("double")).alias(c) for c in features],
        F.col(label).cast("int").alias(label),
    )


def check_columns(df: DataFrame, features: list[str]) -> None:
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise TrainingInputError(f"missing model features: {missing}")
    leaking = [c for c in features if c in S.EXCLUDED_COLUMNS]
    if leaking:
        raise TrainingInputError(f"excluded columns used as features: {leaking}")


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    return {r[label]: r["row_count"] for r in rows.value_counts(df, label).collect()}


def check_training(df: DataFrame, label: str, test_size: float) -> None:
    if not 0 < test_size < 1:
        raise TrainingInputError("test_size must be between 0 and 1")
    counts = class_counts(df, label)
    if len(counts) < 2:
        raise TrainingInputError("training needs both classes")
    if min(counts.values()) < 3:
        raise TrainingInputError("training needs at least 3 rows in each class")


def fit_medians(train: DataFrame, features: list[str]) -> dict[str, float]:
    """Medians of the training rows; a column without values is filled with 0."""
    return {c: 0.0 if m is None else m for c, m in ranking.medians(train, features).items()}


def impute(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(float(v))) for c, v in fills.items()})


def filled_with(column: str, median: float) -> Column:
    """The model's input, alike in training and serving: NULL, NaN and infinity give way to the median."""
    return F.coalesce(finite(F.col(column).cast("double")), F.lit(float(median)))


def class_weight(counts: dict[int, int]) -> float:
    return counts.get(0, 0) / counts[1] if counts.get(1) else 1.0


def _filled(df: DataFrame, features: list[str], medians: dict[str, float]) -> DataFrame:
    """Add the model's inputs as ``_x_`` columns."""
    return df.select("*", *[filled_with(c, medians[c]).alias(f"_x_{c}") for c in features])


def inputs(features: list[str]) -> list[str]:
    return [f"_x_{c}" for c in features]


# --- model ---------------------------------------------------------------------------

def best_iteration(losses: list[float], patience: int) -> int:
    """Number of trees with the least loss, looking no further once ``patience``
    trees in a row have not improved on it. One bad tree ends nothing."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def train_gbt(
    data: DataFrame, features: list[str], label: str, key: str, weight: float, params: Params
) -> Forest:
    """Boosted trees on the train rows, up to the one whose AUC on the validation rows is
    best. Trees grow one after the other and stop ``patience`` trees after the best."""
    settings = boosting.Settings(
        trees=params.trees, patience=params.patience, depth=params.depth, rate=params.learning_rate,
        row_share=params.row_share, column_share=params.column_share, seed=params.seed, weight=weight,
    )
    grown, areas = boosting.fit(data, inputs(features), label, key, settings, features)
    if areas:
        grown.trees = grown.trees[: best_iteration([-a for a in areas], params.patience)]
    return grown


def raw_scores(model: Forest, data: DataFrame, out: str = "_raw_score") -> DataFrame:
    """Uncalibrated probability from filled inputs, in generated code."""
    scored = forest.with_margin(data, model, inputs(model.features), "_margin")
    return scored.withColumn(out, forest.probability(F.col("_margin"))).drop("_margin")


def fit_calibrator(scored: DataFrame, label: str, method: str, score: str = "_raw_score"):
    """Fit on rows counted per score: the same fit on fewer rows."""
    counts = score_counts(scored, label, score)
    if method == "isotonic":
        return fit_isotonic(counts)
    if method != "sigmoid":
        raise TrainingInputError(f"unknown calibration method: {method}")
    return fit_sigmoid(counts)


def calibrate(calibrator, df: DataFrame, out: str) -> DataFrame:
    """Calibrated probability from ``_raw_score``."""
    if isinstance(calibrator, IsotonicRegressionModel):
        return calibrator.transform(df).withColumnRenamed("_calibrated", out)
    return df.withColumn(out, calibrator.column(F.col("_raw_score")))


def predict(bundle: Bundle, df: DataFrame, out: str = "score") -> DataFrame:
    """Impute, score and calibrate rows that hold the feature columns."""
    data = _filled(df, bundle.features, bundle.medians)
    scored = raw_scores(bundle.model, data).drop(*inputs(bundle.features))
    return calibrate(bundle.calibrator, scored, out).drop("_raw_score")


@dataclass
class Training:
    bundle: Bundle
    scored: DataFrame
    metrics: DataFrame


def train(
    store: DataFrame, model_name: str, model_version: str, params: Params | None = None,
    features: list[str] | None = None, label: str = "risk_target", key: str = "stay_id",
) -> Training:
    params, features = params or Params(), features or S.MODEL_FEATURES
    matrix = load_matrix(store, features, label, [key])
    check_training(matrix, label, params.test_size)
    split = ranking.stratified_split(
        matrix, label, key, params.test_size, params.validation_size, params.seed
    )
    split = cut_lineage(split)  # read again by every pass below
    train_rows = split.where("split = 'train'")
    fills = fit_medians(train_rows, features)
    counts = class_counts(train_rows, label)
    weight = class_weight(counts)
    data = _filled(split, features, fills)
    model = train_gbt(data, features, label, key, weight, params)
    scored_raw = cut_lineage(raw_scores(model, data).select(key, label, "split", "_raw_score"))
    sizes = {"train": 0, "validation": 0, "test": 0}
    sizes |= {r["split"]: r["n"] for r in scored_raw.groupBy("split").agg(F.count("*").alias("n")).collect()}
    calibrator = fit_calibrator(scored_raw.where("split = 'validation'"), label, params.calibration)
    bundle = Bundle(
        model, calibrator, fills, features,
        {
            "model_name": model_name,
            "model_version": model_version,
            "classification_threshold": params.threshold,
            "calibration_method": params.calibration,
            "risk_label_thresholds": clinical.RISK_THRESHOLDS,
            "excluded_columns": S.EXCLUDED_COLUMNS,
            "scale_pos_weight": weight,
            "positive_train_rows": counts.get(1, 0),
            "negative_train_rows": counts.get(0, 0),
            "tree_count": model.getNumTrees,
            "best_iteration": model.getNumTrees,
            "base_margin": model.base,
            "feature_count": len(features),
            **{f"{name}_rows": n for name, n in sizes.items()},
            "params": asdict(params),
        },
    )
    scored = calibrate(calibrator, scored_raw, "score").select(key, label, "split", "score")
    test = scored.where("split = 'test'")
    return Training(bundle, scored, metrics.evaluate(test, "score", label, params.threshold))


# --- importances ------------------------------------------------------------------

def importances(bundle: Bundle, spark: SparkSession, k: int = 20) -> DataFrame:
    values = bundle.model.importances()
    table = spark.createDataFrame(
        [(i, n, float(v)) for i, (n, v) in enumerate(zip(bundle.features, values))],
        "ordinal int, feature string, importance double",
    )
    ranked = rows.top_k(table, [F.desc("importance"), F.col("ordinal")], k)
    return ranked.select("feature", F.round("importance", 8).alias("importance"))


def features_json(ranked: DataFrame) -> str:
    """The ranked importances as one JSON text."""
    items = F.array_sort(
        F.collect_list(F.struct((-F.col("importance")).alias("_o"), "feature", "importance"))
    )
    json_col = F.to_json(F.transform(items, lambda x: F.struct(x["feature"].alias("feature"), x["importance"].alias("importance"))))
    return ranked.agg(json_col.alias("j")).first()["j"]


# --- storing -----------------------------------------------------------------------

_REQUIRED = ["model_name", "model_version", "classification_threshold", "feature_names", "medians"]
FULL_FEATURE_COUNT = len(S.MODEL_FEATURES)


def save_bundle(bundle: Bundle, path: str) -> str:
    spark = SparkSession.active()
    forest.save(bundle.model, spark, f"{path}/model")
    meta = {**bundle.metadata, "feature_names": bundle.features, "medians": bundle.medians, "base_margin": bundle.model.base}
    if isinstance(bundle.calibrator, Sigmoid):
        meta |= {"calibration_method": "sigmoid", "sigmoid": asdict(bundle.calibrator)}
    else:
        bundle.calibrator.write().overwrite().save(f"{path}/calibrator")
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/metadata")
    return path


def check_metadata(meta: dict) -> None:
    missing = sorted(k for k in _REQUIRED if k not in meta)
    if missing:
        raise BundleError(f"model metadata lacks: {missing}")
    unknown = [n for n in meta["feature_names"] if n not in S.FEATURE_SPECS]
    if unknown:
        raise BundleError(f"features outside the contract: {unknown}")
    count = len(meta["feature_names"])
    if meta["model_name"].endswith("_v2") and count != FULL_FEATURE_COUNT:
        raise BundleError(f"a v2 model has {FULL_FEATURE_COUNT} features, got {count}")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    meta = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    check_metadata(meta)
    features, medians = meta.pop("feature_names"), meta.pop("medians")
    sigmoid = meta.pop("sigmoid", None)
    calibrator = Sigmoid(**sigmoid) if sigmoid else IsotonicRegressionModel.load(f"{path}/calibrator")
    model = forest.load(spark, f"{path}/model", features, meta.get("base_margin", 0.0))
    return Bundle(model, calibrator, medians, features, meta)
