"""Which model is active, and how good the models are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUALITY_METRICS = [
    "mae",
    "rmse",
    "wmape",
    "bias",
    "calibration_factor",
    "prediction_rows",
    "uncalibrated_wmape",
    "uncalibrated_bias",
]


def latest_model(models: DataFrame) -> DataFrame:
    """The newest model, whether or not it has predictions."""
    return models.orderBy(F.desc("created_at"), F.desc("model_key")).limit(1)


def model_output(estimates: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Rows of every model in both model facts; small enough to be kept beside them."""
    estimated = estimates.groupBy("model_key").agg(F.count(F.lit(1)).alias("demand_estimate_rows"))
    recommended = recommendations.groupBy("model_key").agg(F.count(F.lit(1)).alias("recommendation_rows"))
    return estimated.join(recommended, "model_key", "full").fillna(0)


def latest_model_with_predictions(models: DataFrame, output: DataFrame) -> DataFrame:
    """The newest model that has demand estimates, with both row counts."""
    return latest_model(models.join(output.filter("demand_estimate_rows > 0"), "model_key"))


def active_model(models: DataFrame, output: DataFrame) -> Column:
    """The active model as a scalar (key, name, version); null when no model has estimates.

    A scalar subquery keeps rows when there is no model, without joining anything to the fact. The
    counts stand for the facts, which are not opened.
    """
    used = models.join(output.filter("demand_estimate_rows > 0"), "model_key", "left_semi")
    return latest_model(used).select(F.struct("model_key", "model_name", "model_version")).scalar()


def model_quality(models: DataFrame, evaluation: DataFrame) -> DataFrame:
    """Key-value metrics of the eval split as one row per model; models without metrics stay."""
    on_eval = F.col("evaluation_split") == "eval"

    def metric(name: str) -> Column:
        return F.max(F.when(on_eval & (F.col("metric_name") == name), F.col("metric_value")))

    measures = [metric("rows").alias("eval_rows"), *[metric(name).alias(name) for name in QUALITY_METRICS]]
    loaded = F.max("created_at").alias("metrics_loaded_at")
    pivoted = evaluation.groupBy("model_key").agg(*measures, loaded)
    return models.select("model_key", "model_name", "model_version", "created_at").join(
        pivoted, "model_key", "left"
    )


def newest_quality(quality: DataFrame, n: int = 5) -> DataFrame:
    return quality.orderBy(F.desc("created_at"), F.desc("model_key")).limit(n)


def model_quality_latest(
    models: DataFrame, evaluation: DataFrame, output: DataFrame
) -> DataFrame:
    """Quality of the active model, with its calibration factor before capping."""
    raw = (
        evaluation.filter((F.col("evaluation_split") == "eval") & (F.col("metric_name") == "raw_calibration_factor"))
        .groupBy("model_key")
        .agg(F.max("metric_value").alias("raw_calibration_factor"))
    )
    key = active_model(models, output)["model_key"]
    return (
        model_quality(models, evaluation)
        .filter(F.col("model_key") == key)
        .join(raw, "model_key", "left")
        .drop("created_at")
    )


def quality_guardrails(quality: DataFrame) -> DataFrame:
    """Warnings on how far a model's quantities can be trusted; a missing metric warns of nothing."""
    applied, raw = F.col("calibration_factor"), F.col("raw_calibration_factor")
    return quality.select(
        "model_key",
        F.coalesce(F.abs(raw - applied) > 0.0001, F.lit(False)).alias("calibration_capped"),
        F.coalesce(F.col("wmape") >= 0.8, F.lit(False)).alias("error_high"),
        F.coalesce(applied >= 5, F.lit(False)).alias("calibration_high"),
        (F.abs("bias") <= 0.05).alias("bias_within_limit"),
    )
