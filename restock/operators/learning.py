"""Demand models of boosted trees."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from restock import schema as S
from restock.operators import boosting
from restock.operators.boosting import Boosted, BoostingOptions
from restock.operators.evaluation import predict_hurdle
from restock.operators.features import feature_columns, null_fill, numbers


@dataclass(frozen=True)
class TrainingOptions:
    trees: int = 20
    depth: int = 5
    bins: int = 32
    learning_rate: float = 0.1
    seed: int = 42
    positive_threshold: float = 0.0
    prior_weight: float = 0.35
    objective: str = "tweedie"
    variance_power: float = 1.4
    subsample: float = 0.9
    column_share: float = 0.9
    growth: str = "level"
    leaves: int = 31
    max_step: float | None = None

    def boosting(self, objective: str) -> BoostingOptions:
        return BoostingOptions(
            objective,
            self.variance_power,
            self.growth,
            self.trees,
            self.depth,
            self.leaves,
            self.bins,
            self.learning_rate,
            max_step=self.max_step,
            row_share=self.subsample,
            column_share=self.column_share,
            seed=self.seed,
        )


@dataclass
class DemandModel:
    """Fitted stages with what is needed to apply them."""

    strategy: str
    columns: list[str]
    stages: dict[str, Boosted]
    prior_weight: float = 0.0
    metadata: dict = field(default_factory=dict)

    def predict(self, features: DataFrame, factor: float = 1.0) -> DataFrame:
        """Add ``prediction``: never negative, scaled by the calibration factor.

        The rows keep plain columns, so those that nobody asks for are not read.
        """
        inputs = list(numbers(features, self.columns).values())
        rows = features.withColumns({f"_{name}": stage.response(inputs) for name, stage in self.stages.items()})
        if self.strategy == "hurdle":
            prior = F.col("baseline_demand_prior") if "baseline_demand_prior" in features.columns else None
            value = predict_hurdle(F.col("_classifier"), F.col("_amount"), prior, self.prior_weight)
        else:
            value = F.col("_regressor")
        return rows.select(*features.columns, F.greatest(value * factor, F.lit(0.0)).alias("prediction"))

    def save(self, path: str) -> None:
        """Writes the trees and what is known of the model as text; its size does not depend on the rows."""
        about = {
            "strategy": self.strategy,
            "columns": self.columns,
            "stages": {name: stage.to_json() for name, stage in self.stages.items()},
            "prior_weight": self.prior_weight,
            **self.metadata,
        }
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(about),)], "value string").write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, path: str) -> DemandModel:
        about = json.loads(SparkSession.active().read.text(f"{path}/about").first().value)
        stages = {name: Boosted.from_json(text) for name, text in about.pop("stages").items()}
        return cls(about.pop("strategy"), about.pop("columns"), stages, about.pop("prior_weight"), about)


def _inputs(train: DataFrame, columns: list[str], labels: dict[str, Column]) -> DataFrame:
    """The input vector's columns and the labels, nothing else."""
    labelled = null_fill(train.withColumns(labels), columns)
    return labelled.select(*labels, *[F.col(name).alias(f"_x_{name}") for name in columns])


def _fit(rows: DataFrame, columns: list[str], options: TrainingOptions, objective: str, label: str, weight: Column) -> Boosted:
    named = [f"_x_{name}" for name in columns]
    fitted = boosting.fit(rows, named, F.col(label), weight, options.boosting(objective))
    return replace(fitted, columns=columns)


def fit_direct(
    train: DataFrame, columns: list[str] | None = None, options: TrainingOptions = TrainingOptions()
) -> DemandModel:
    """One boosted regressor on ``demand_target`` and all inputs: Tweedie, Poisson or squared error."""
    columns = columns or feature_columns()
    rows = _inputs(train, columns, {"_label": F.col("demand_target")})
    return DemandModel("direct", columns, {"regressor": _fit(rows, columns, options, options.objective, "_label", F.lit(1.0))})


def fit_hurdle(train: DataFrame, columns: list[str], options: TrainingOptions = TrainingOptions()) -> DemandModel:
    """A classifier for any sale and a regressor for the logarithm of its size.

    Positives are weighted up to the number of zeros. With only one of the two classes it is a
    direct regression.
    """
    positive = F.col("demand_target") > options.positive_threshold
    counts = train.agg(F.count_if(positive).alias("positive"), F.count_if(~positive).alias("zero")).first()
    if counts.positive == 0 or counts.zero == 0:
        return fit_direct(train, columns, options)
    weight = max(counts.zero / counts.positive, 1.0)
    labels = {
        "_sold": positive.cast("double"),
        "_weight": F.when(positive, weight).otherwise(1.0),
        "_log_target": F.log1p("demand_target"),
    }
    rows = _inputs(train, columns, labels)
    stages = {
        "classifier": _fit(rows, columns, options, "logistic", "_sold", F.col("_weight")),
        "amount": _fit(rows.filter(F.col("_sold") == 1), columns, options, "squared", "_log_target", F.lit(1.0)),
    }
    with_prior = "baseline_demand_prior" in train.columns
    about = {"positive_rows": counts.positive, "zero_rows": counts.zero, "positive_weight": weight}
    return DemandModel("hurdle", columns, stages, options.prior_weight if with_prior else 0.0, about)


# The three regressors of the comparison: how trees grow, their loss and the bound of a step.
COMPARISON_KINDS = {
    "poisson": {"objective": "poisson", "growth": "level", "max_step": 1.0},
    "best_first": {"objective": "tweedie", "growth": "best_first", "variance_power": 1.5},
    "symmetric": {"objective": "tweedie", "growth": "symmetric", "variance_power": 1.5},
}


def fit_comparison(
    encoded_train: DataFrame, target: str, kind: str = "poisson", options: TrainingOptions = TrainingOptions()
) -> DemandModel:
    """One regressor of ``COMPARISON_KINDS`` on the encoded comparison inputs; targets below 0 count as 0."""
    rows = encoded_train.withColumn("demand_target", F.greatest(F.col(target), F.lit(0.0)))
    return fit_direct(rows, S.COMPARISON_NUMERIC + S.COMPARISON_CATEGORICAL, replace(options, **COMPARISON_KINDS[kind]))
