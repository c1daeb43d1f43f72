"""The warehouse of a folder of event tables, with two models' predictions loaded."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restock import fixtures
from restock import schema as S
from restock.operators import demand, evaluation, features
from restock.operators.metric_documents import metrics_document
from restock.plans.warehouse import Warehouse
from restock.session import materialise, never_broadcast, prepare, shared_folder

# Models with predictions; the newest registered model has none.
MODEL_KEYS = (1, 2)
ACTIVE_KEY = 2


class ExampleWarehouse(Warehouse):
    """Observations derived from the ``events`` table; estimates from two simple models."""

    def __init__(self, spark: SparkSession, folder: str, source_folder: str):
        events = lambda: fixtures.observations_from_events(
            spark.read.parquet(f"{source_folder}/events.parquet")
        )
        super().__init__(spark, folder, events)
        self.source_folder = source_folder
        self._scored: dict[tuple[int, str], DataFrame] = {}

    @cached_property
    def dim_model(self) -> DataFrame:
        return self._stored("dim_model", lambda: fixtures.model_registry(self.dim_date, self.observations))

    def predictions(self, model_key: int) -> DataFrame:
        return fixtures.predictions(self.fact_hourly, model_key)

    @cached_property
    def demand_estimates(self) -> DataFrame:
        first, second = (
            demand.as_estimates(demand.clamp_prediction(self.predictions(key)), key) for key in MODEL_KEYS
        )
        return self._stored("demand_estimates", lambda: first.unionByName(second))

    @cached_property
    def recommendations(self) -> DataFrame:
        return self._stored("recommendations", lambda: demand.recommendations(self.demand_estimates, self.fact_daily))

    def scored(self, model_key: int = ACTIVE_KEY, split: str = "eval") -> DataFrame:
        """A model's predictions beside the target of the trainable rows of one split.

        Many metrics read these rows, so they are computed once.
        """
        if (model_key, split) not in self._scored:
            self._scored[model_key, split] = materialise(self._score(model_key, split))
        return self._scored[model_key, split]

    def _score(self, model_key: int, split: str) -> DataFrame:
        usable = (F.col("source_split") == split) & F.col("is_trainable_demand_observation")
        rows = features.promo_weather(features.demand_target(self.training_features.filter(usable)))
        predicted = self.predictions(model_key).select(*S.HOURLY_KEY, F.col("predicted_demand").alias("prediction"))
        columns = ["demand_target", "is_business_hour_6_22", "is_weekend", "is_promo_or_discount", "prediction"]
        return rows.join(never_broadcast(predicted), S.HOURLY_KEY).select(*S.HOURLY_KEY, *columns)

    def evaluation_rows(self, model_key: int) -> DataFrame:
        """Evaluation rows of a model scaled by its factor from the train split."""
        test, tail = self.scored(model_key), self.scored(model_key, "train")
        raw, factor = self.train_factors(model_key)
        final = evaluation.metrics(test, factor).withColumns(
            {"calibration_factor": F.lit(factor), "raw_calibration_factor": F.lit(raw)}
        )
        return evaluation.evaluation_rows(
            model_key,
            final,
            evaluation.metrics(test),
            evaluation.segment_metrics(test, factor),
            evaluation.metrics(tail, factor),
            evaluation.metrics(tail),
        )

    def train_factors(self, model_key: int) -> tuple[float, float]:
        """The train split's bias factor, as it is and within its bounds."""
        raw = evaluation.bias_factor(self.scored(model_key, "train")).first().bias_factor
        return raw, min(max(raw, 0.25), 5.0)

    @cached_property
    def model_evaluation(self) -> DataFrame:
        rows = [self.evaluation_rows(key) for key in MODEL_KEYS]
        stamps = self.dim_model.select("model_key", "created_at")
        return self._stored("model_evaluation", lambda: rows[0].unionByName(rows[1]).join(stamps, "model_key"))

    def metrics_document(self) -> DataFrame:
        """The active model's eval metrics as JSON text."""
        test = self.scored()
        _, factor = self.train_factors(ACTIVE_KEY)
        return metrics_document(
            evaluation.metrics(test, factor),
            evaluation.metrics(test),
            evaluation.segment_metrics(test, factor),
            {"calibration_factor": factor, "calibrated": True, "calibration_source_split": "train"},
        )


class UnmodelledWarehouse(ExampleWarehouse):
    """The same observations with an empty model registry."""

    dim_model = Warehouse.dim_model
    demand_estimates = Warehouse.demand_estimates
    recommendations = Warehouse.recommendations
    model_evaluation = Warehouse.model_evaluation


_warehouses: dict[tuple, ExampleWarehouse] = {}


def example_warehouse(spark: SparkSession, source_folder: str, with_models: bool = True) -> ExampleWarehouse:
    """One warehouse per session and source folder; its tables are written on first use."""
    prepare(spark)
    key = (spark.sparkContext.applicationId, source_folder, with_models)
    if key not in _warehouses:
        kind = ExampleWarehouse if with_models else UnmodelledWarehouse
        folder = f"{shared_folder(spark)}/warehouse-{len(_warehouses)}"
        _warehouses[key] = kind(spark, folder, source_folder)
        if not with_models:
            # The base tables are the same, so they are written once.
            base = example_warehouse(spark, source_folder)
            for name in ("observations", "dim_date", "dim_time", "dim_city", "dim_store", "dim_product", "fact_daily"):
                setattr(_warehouses[key], name, getattr(base, name))
    return _warehouses[key]
