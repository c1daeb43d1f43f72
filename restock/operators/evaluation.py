"""Metrics and calibration of predictions. Rows carry ``demand_target`` and ``prediction``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock.operators.ordering import running_total

METRICS = ["rows", "mae", "rmse", "wmape", "bias"]
SEGMENTS = ["business_hour", "non_business_hour", "weekend", "weekday", "promo_or_discount"]


def predict_hurdle(
    probability: Column, log_amount: Column, prior: Column | None = None, prior_weight: float = 0.0
) -> Column:
    """Probability of a sale times its amount, blended with the prior and never negative."""
    expected = F.greatest(probability * F.expm1(log_amount), F.lit(0.0))
    if prior is not None and prior_weight > 0:
        expected = expected * (1 - prior_weight) + F.coalesce(prior, F.lit(0.0)) * prior_weight
    return F.greatest(expected, F.lit(0.0))


def _sums(factor) -> list[Column]:
    """Sums all metrics are made of; they add up over groups."""
    actual = F.col("demand_target")
    error = F.greatest(F.col("prediction") * factor, F.lit(0.0)) - actual
    return [
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.abs(error)).alias("_absolute"),
        F.sum(error * error).alias("_squared"),
        F.sum(error).alias("_signed"),
        F.sum(F.abs(actual)).alias("_actual"),
    ]


def _from_sums() -> list[Column]:
    rows, scale = F.col("_rows"), F.col("_actual")

    def relative(name: str) -> Column:
        return F.when(scale > 0, F.col(name) / scale).otherwise(0.0)

    return [
        rows.cast("double").alias("rows"),
        F.try_divide(F.col("_absolute"), rows).alias("mae"),
        F.sqrt(F.try_divide(F.col("_squared"), rows)).alias("rmse"),
        relative("_absolute").alias("wmape"),
        relative("_signed").alias("bias"),
    ]


def metrics(scored: DataFrame, factor=1.0) -> DataFrame:
    """One row: rows, mae, rmse, wmape, bias. Without any actual demand the relative ones are 0."""
    return scored.agg(*_sums(factor)).select(*_from_sums())


def segment_metrics(scored: DataFrame, factor=1.0) -> DataFrame:
    """The metrics of overlapping segments; empty segments are left out.

    Rows are summed by their three flags first; only those eight rows are assigned to segments.
    """
    flags = ["is_business_hour_6_22", "is_weekend", "is_promo_or_discount"]
    groups = scored.groupBy(*flags).agg(*_sums(factor))
    business, weekend, promo = (F.col(name) for name in flags)
    member = dict(zip(SEGMENTS, [business, ~business, weekend, ~weekend, promo]))
    names = F.array_compact(F.array(*[F.when(holds, name) for name, holds in member.items()]))
    totals = ["_rows", "_absolute", "_squared", "_signed", "_actual"]
    assigned = groups.select(F.explode(names).alias("segment"), *totals)
    summed = assigned.groupBy("segment").agg(*[F.sum(name).alias(name) for name in totals])
    return summed.select("segment", *_from_sums())


def bias_factor(scored: DataFrame) -> DataFrame:
    """Actual over predicted total; 1 when nothing was predicted."""
    predicted = F.sum("prediction")
    return scored.agg(F.when(predicted > 0, F.sum("demand_target") / predicted).otherwise(1.0).alias("bias_factor"))


MIN_PREDICTION = 1e-12


def wmape_factor(scored: DataFrame) -> DataFrame:
    """The factor with the least absolute error: the weighted median of actual / predicted.

    Equal ratios are summed first, so the running weight covers distinct ratios only.
    """
    usable = scored.filter(F.col("prediction") > MIN_PREDICTION)
    ratios = (
        usable.select((F.col("demand_target") / F.col("prediction")).alias("ratio"), F.col("prediction").alias("weight"))
        .groupBy("ratio")
        .agg(F.sum("weight").alias("weight"))
    )
    summed = running_total(ratios, ["ratio"], "weight", "_cumulative")
    half = summed.agg(F.sum("weight") / 2.0).scalar()
    crossing = F.min(F.when(F.col("_cumulative") >= half, F.col("ratio")))
    # Rounding may leave the last running weight a hair below the total.
    return summed.agg(F.coalesce(crossing, F.max("ratio"), F.lit(1.0)).alias("wmape_factor"))


def calibration_factor(
    scored: DataFrame,
    objective: str = "balanced",
    lower: float = 0.25,
    upper: float = 5.0,
    penalty: float = 0.25,
    steps: int = 121,
) -> DataFrame:
    """One row: the chosen factor, and the two factors it was chosen beside.

    ``balanced`` looks at a grid of factors, 1 and both factors for the least
    wmape + penalty * abs(bias); the smallest one wins ties. The error of a factor f changes its
    shape only where f passes a row's ratio of actual to predicted. So rows are summed by the
    interval between candidates that their ratio lies in: one pass, a hundred or so groups, and no
    copy of a row per candidate.
    """
    if not 0 < lower <= upper:
        raise ValueError("calibration bounds must satisfy 0 < lower <= upper")
    if objective not in ("bias", "wmape", "balanced"):
        raise ValueError(f"unknown calibration objective {objective}")
    raw = F.struct(
        bias_factor(scored).scalar().alias("bias"), wmape_factor(scored).scalar().alias("wmape")
    )
    single = scored.sparkSession.range(1).select(raw.alias("raw"))
    clipped = {name: F.least(F.greatest(F.col(f"raw.{name}"), F.lit(lower)), F.lit(upper)) for name in ("bias", "wmape")}
    bounded = single.select("raw", *[value.alias(name) for name, value in clipped.items()])
    named = [F.col("raw.bias").alias("raw_bias_factor"), F.col("raw.wmape").alias("raw_wmape_factor")]
    if objective != "balanced":
        return bounded.select(F.col(objective).alias("calibration_factor"), *named)

    count = max(steps, 3)
    width = (upper - lower) / (count - 1)
    grid = F.array(*[F.lit(lower + i * width if i < count - 1 else upper) for i in range(count)])
    extra = bounded.select(F.array(F.lit(1.0), F.col("bias"), F.col("wmape"))).scalar()
    ratio = F.col("demand_target") / F.when(F.col("prediction") > 0, F.col("prediction"))
    near = F.least(ratio, F.lit(upper + 2 * width + 1.0))
    slots = [F.floor((near - lower) / (width or 1.0))] + [ratio >= extra[i] for i in range(3)]
    in_grid = F.least(F.greatest(slots[0], F.lit(-1)), F.lit(count)).alias("_slot")
    keyed = scored.select("demand_target", "prediction", in_grid, *[s.alias(f"_over{i}") for i, s in enumerate(slots[1:])])
    intervals = keyed.groupBy("_slot", "_over0", "_over1", "_over2").agg(
        F.sum("demand_target").alias("y"), F.sum("prediction").alias("p")
    )
    # At most one row per interval between candidates, so the array is short.
    sums = intervals.agg(F.collect_list(F.struct("y", "p")).alias("sums"), F.sum("y").alias("y"), F.sum("p").alias("p"))
    candidates = bounded.select(
        *named, F.explode(F.array_distinct(F.concat(grid, extra))).alias("factor")
    ).withColumn("all", sums.select(F.struct("sums", "y", "p")).scalar())
    factor = F.col("factor")
    absolute = F.aggregate(
        F.col("all.sums"), F.lit(0.0), lambda total, s: total + F.abs(s["p"] * factor - s["y"])
    )
    signed = F.col("all.p") * factor - F.col("all.y")
    score = F.when(F.col("all.y") > 0, (absolute + penalty * F.abs(signed)) / F.col("all.y")).otherwise(0.0)
    best = F.struct(F.round(score, 12).alias("score"), factor.alias("factor"))
    chosen = candidates.groupBy("raw_bias_factor", "raw_wmape_factor").agg(F.min(best).alias("best"))
    return chosen.select(F.col("best.factor").alias("calibration_factor"), "raw_bias_factor", "raw_wmape_factor")


def comparison_metrics(scored: DataFrame) -> DataFrame:
    """Metrics of the comparison flow, with the mean predictor as its baseline."""
    actual = F.col("demand_target")
    predicted = F.greatest("prediction", F.lit(0.0))
    mean = scored.agg(F.avg("demand_target")).scalar()
    rows = scored.withColumn("_mean", mean)
    total = F.sum(actual) + F.lit(1e-10)
    mae, base = F.avg(F.abs(actual - predicted)), F.avg(F.abs(actual - F.col("_mean")))
    wmape = F.sum(F.abs(actual - predicted)) / total
    return rows.agg(
        mae.alias("mae"),
        F.sqrt(F.avg((actual - predicted) * (actual - predicted))).alias("rmse"),
        wmape.alias("wmape"),
        (wmape * 100).alias("wmape_percent"),
        ((F.sum(predicted) - F.sum(actual)) / total * 100).alias("bias_percent"),
        base.alias("baseline_mae"),
        F.when(base != 0, (base - mae) / base * 100).otherwise(0.0).alias("baseline_mae_improvement_percent"),
    )


def metric_rows(one_row: DataFrame, split: str, prefix: str = "", context: dict[str, str] | None = None) -> DataFrame:
    """A row of metrics as (evaluation_split, metric_name, metric_value, metric_context)."""
    names = one_row.columns
    renamed = one_row.select(*[F.col(name).cast("double").alias(f"{prefix}{name}") for name in names])
    pairs = [F.lit(part) for pair in (context or {}).items() for part in pair]
    described = F.create_map(*pairs).cast("map<string,string>")
    return renamed.unpivot([], renamed.columns, "metric_name", "metric_value").select(
        F.lit(split).alias("evaluation_split"), "metric_name", "metric_value", described.alias("metric_context")
    )


def segment_rows(segments: DataFrame) -> DataFrame:
    long = segments.unpivot(["segment"], METRICS, "metric_name", "metric_value")
    return long.select(
        F.concat(F.lit("segment:"), "segment").alias("evaluation_split"),
        "metric_name",
        "metric_value",
        F.create_map(F.lit("segment"), F.col("segment")).alias("metric_context"),
    )


def evaluation_rows(
    model_key: int,
    final: DataFrame,
    uncalibrated: DataFrame,
    segments: DataFrame,
    calibration: DataFrame | None = None,
    calibration_uncalibrated: DataFrame | None = None,
) -> DataFrame:
    """All metrics of a training run as rows of the evaluation fact."""
    tail = {"split": "train_calibration"}
    rows = (
        metric_rows(final, "eval")
        .unionByName(metric_rows(uncalibrated, "eval_uncalibrated"))
        .unionByName(metric_rows(uncalibrated, "eval", "uncalibrated_"))
        .unionByName(segment_rows(segments))
    )
    if calibration is not None:
        rows = rows.unionByName(metric_rows(calibration, "train_calibration", context=tail))
    if calibration_uncalibrated is not None:
        rows = rows.unionByName(
            metric_rows(calibration_uncalibrated, "train_calibration_uncalibrated", context=tail)
        )
    return rows.select(F.lit(model_key).cast("int").alias("model_key"), "*")


