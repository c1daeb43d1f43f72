"""The three jobs: load observations, train and score, import predictions made elsewhere."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restock import schema as S
from restock.operators import demand, evaluation, features, learning, metric_documents, sampling
from restock.plans.warehouse import Warehouse
from restock.session import materialise
from restock.sources import files, observations

FILE_ORDER = ["dt", "store_id", "product_id"]


def sample_observations(
    obs: DataFrame,
    mode: str = "product-date-stratified",
    shared_cap: int | None = None,
    caps: dict[str, int] | None = None,
    seed: int = 42,
) -> DataFrame:
    """The rows to load. A panel takes whole histories of pairs and ignores the eval cap."""
    train = obs.filter(F.col("source_split") == "train")
    if mode == "store-product-panel":
        target = sampling.resolve_cap("train", shared_cap, caps)
        return sampling.panel_apply(obs, sampling.panel_select(train, target, seed))
    groups = {"product-date-stratified": ["dt", "product_id"], "date-stratified": ["dt"]}

    def capped(split: str) -> DataFrame:
        rows = obs.filter(F.col("source_split") == split)
        cap = sampling.resolve_cap(split, shared_cap, caps)
        if cap is None:
            return rows
        if mode in groups:
            order = [name for name in FILE_ORDER if name not in groups[mode]]
            return sampling.sample_stratified(rows, groups[mode], order, cap)
        if mode == "even":
            return sampling.sample_even(rows, FILE_ORDER, cap)
        if mode == "head":
            return sampling.sample_head(rows, FILE_ORDER, cap)
        raise ValueError(f"unknown sample mode {mode}")

    return capped("train").unionByName(capped("eval"))


def load_job(
    spark: SparkSession,
    source_folder: str,
    warehouse: Warehouse,
    reset: bool = False,
    hourly: bool = False,
    hourly_start=None,
    hourly_end=None,
    **sampling_options,
) -> None:
    """Read both files, choose rows, and bring them into the star schema."""
    if reset:
        warehouse.reset()
    obs = observations.read_observations(spark, source_folder)
    warehouse.load(materialise(sample_observations(obs, **sampling_options)))
    if hourly:
        warehouse.load_hourly(hourly_start, hourly_end)


ROW_KEY = ["date_key", "store_key", "product_key", "time_key"]


def sample_training_rows(
    rows: DataFrame,
    cap: int | None = None,
    rate: float | None = None,
    mode: str = "product-date-stratified",
    seed: int = 42,
) -> DataFrame:
    """The rows of one split to train or judge on: by rate, by cap, or all of them.

    A rate is drawn first and then cut at the cap; a cap alone is spread as the mode says.
    """
    if rate is not None:
        return sampling.sample_bernoulli(rows, ROW_KEY, rate, seed, cap)
    if cap is None:
        return rows
    groups = {"product-date-stratified": ["full_date", "product_id"], "date-stratified": ["full_date"]}
    if mode in groups:
        return sampling.sample_cap_per_group(rows, groups[mode], ROW_KEY, cap, seed)
    if mode == "random":
        return sampling.sample_cap_random(rows, ROW_KEY, cap, seed)
    if mode == "ordered":
        return sampling.sample_cap_ordered(rows, ROW_KEY, cap)
    raise ValueError(f"unknown sample mode {mode}")


@dataclass
class TrainingRun:
    """A fitted and calibrated model with the parts it was judged on."""

    model: learning.DemandModel
    factor: float
    raw_factor: float
    wmape_factor: float
    calibration: DataFrame
    held_out: DataFrame
    features: DataFrame

    def evaluation(self, model_key: int) -> DataFrame:
        """Rows of the evaluation fact; factors go with the eval metrics."""
        factors = {
            "calibration_factor": self.factor,
            "raw_calibration_factor": self.raw_factor,
            "wmape_calibration_factor": self.wmape_factor,
        }
        final = evaluation.metrics(self.held_out, self.factor)
        return evaluation.evaluation_rows(
            model_key,
            final.withColumns({name: F.lit(value) for name, value in factors.items()}),
            evaluation.metrics(self.held_out),
            evaluation.segment_metrics(self.held_out, self.factor),
            evaluation.metrics(self.calibration, self.factor),
            evaluation.metrics(self.calibration),
        )

    def predictions(self) -> DataFrame:
        """Clamped predictions of every hour, stockouts included."""
        scored = self.model.predict(self.features, self.factor)
        return demand.clamp_prediction(scored.withColumnRenamed("prediction", "predicted_demand"))

    def document(self) -> DataFrame:
        return metric_documents.metrics_document(
            evaluation.metrics(self.held_out, self.factor),
            evaluation.metrics(self.held_out),
            evaluation.segment_metrics(self.held_out, self.factor),
            {"calibration_factor": self.factor, "raw_calibration_factor": self.raw_factor},
        )


def train_job(
    training_features: DataFrame,
    options: learning.TrainingOptions = learning.TrainingOptions(),
    strategy: str = "hurdle",
    fraction: float = 0.15,
    advanced: bool = True,
    objective: str = "balanced",
    calibrate_on: str = features.CALIBRATION,
    prepared: DataFrame | None = None,
    judged_rows: int | None = None,
    **train_sample,
) -> TrainingRun:
    """Features once over the fact, fit on trainable rows, calibrate, judge on the eval split.

    Calibration looks at the tail of the train dates, or at the eval split when asked to. Without
    any eval rows the fit rows are judged instead, all or a sample of ``judged_rows``. ``train_sample``
    goes to :func:`sample_training_rows`; features are built before any row is left out.
    """
    if prepared is None:
        prepared = materialise(features.prepare_features(training_features, fraction, advanced))
    usable = prepared.filter(F.col("is_trainable_demand_observation"))
    fit = sample_training_rows(usable.filter(F.col("part") == features.FIT), **train_sample)
    if train_sample:
        fit = materialise(fit)
    columns = features.feature_columns(advanced)
    if strategy == "hurdle":
        model = learning.fit_hurdle(fit, columns, options)
    else:
        model = learning.fit_direct(fit, columns, options)

    judged = ["demand_target", "is_business_hour_6_22", "is_weekend", "is_promo_or_discount", "part", "prediction"]
    on_eval = usable.filter(F.col("part") == features.EVAL)
    held_eval = sampling.eval_or_train_sample(fit, on_eval, ROW_KEY, options.seed, judged_rows)
    held = usable.filter(F.col("part") == features.CALIBRATION).unionByName(
        held_eval.withColumn("part", F.lit(features.EVAL))
    )
    if not advanced:
        held = held.withColumn("is_promo_or_discount", F.lit(False))
    scored = materialise(model.predict(held).select(*S.HOURLY_KEY, *judged))
    tail = scored.filter(F.col("part") == features.CALIBRATION)
    held_out = scored.filter(F.col("part") == features.EVAL)
    judge = held_out if calibrate_on == features.EVAL else tail
    factors = (1.0, 1.0, 1.0) if judge.isEmpty() else tuple(evaluation.calibration_factor(judge, objective).first())
    return TrainingRun(model, *factors, tail, held_out, prepared)


def publish_run(
    warehouse: Warehouse, run: TrainingRun, name: str, version: str, created_at, artifact_folder: str | None = None
) -> int:
    """Register a run, load its metrics, estimates and recommendations, and save its artifacts."""
    span = run.features.filter(F.col("part") == features.FIT).agg(F.min("full_date"), F.max("full_date")).first()
    key = warehouse.register_model(name, version, created_at, span[0], span[1])
    warehouse.load_evaluation(run.evaluation(key), created_at)
    warehouse.load_estimates(demand.as_estimates(run.predictions(), key))
    warehouse.load_recommendations(key)
    if artifact_folder is not None:
        stem = f"{artifact_folder}/{name}_{version}"
        run.model.save(f"{stem}_model")
        features.Preparation.of(run.features).save(f"{stem}_model")
        files.write_document(run.document(), f"{stem}_metrics.json")
        files.export_predictions(run.predictions(), f"{stem}_predictions.parquet")
    return key


def score_job(spark: SparkSession, model_path: str, features_of_days: DataFrame, factor: float = 1.0) -> DataFrame:
    """Predictions for rows of the hourly feature view by a saved model and its saved preparation.

    Nothing of the rows the model was fitted on is read.
    """
    rows = features.Preparation.load(spark, model_path).apply(features_of_days)
    return learning.DemandModel.load(model_path).predict(rows, factor)


def import_job(
    warehouse: Warehouse,
    predictions_path: str,
    name: str,
    version: str,
    created_at,
    service_level: float = S.SERVICE_LEVEL,
    replace: bool = False,
    recommend: bool = True,
) -> int:
    """Bring a prediction file and its sidecars into the model facts."""
    spark = warehouse.spark
    key = warehouse.register_model(name, version, created_at)
    if replace:
        warehouse.delete_model_output(key)
    warehouse.load_estimates(demand.import_predictions(spark.read.parquet(predictions_path), key))
    warehouse.refresh_training_dates(key)
    documents = files.read_document(spark, files.sidecar_path(predictions_path, "_metrics.json"))
    if documents is not None:
        metadata = files.read_document(spark, files.sidecar_path(predictions_path, "_metadata.json"))
        warehouse.load_evaluation(metric_documents.metrics_import(documents, metadata, key), created_at)
    if recommend:
        warehouse.load_recommendations(key, service_level)
    return key
