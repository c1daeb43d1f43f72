"""Every query by name: (session, folder of the given tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from restock import fixtures
from restock import schema as S
from restock.functions.hours import array_total
from restock.operators import (
    boosting,
    comparison,
    decisions,
    demand,
    dims,
    drilldown,
    evaluation,
    facts,
    features,
    kpi,
    learning,
    merge,
    metric_documents,
    models,
    quality,
    queue,
    sampling,
)
from restock.plans.examples import ACTIVE_KEY, ExampleWarehouse, example_warehouse
from restock.plans.jobs import score_job, train_job
from restock.session import materialise, never_broadcast, shared_folder
from restock.sources import files, observations

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = 42
OBS_ORDER = ["store_id", "product_id", "dt"]
OBS_COLUMNS = ["source_split", *OBS_ORDER, "sale_amount"]
HOUR_COLUMNS = [*S.HOURLY_KEY, "observed_sales_amount"]
DAY_IN_FOCUS = date(2024, 1, 20)


def six_digits(name: str) -> Column:
    """A double to six digits; the offset keeps values on a rounding tie together.

    ``round`` goes through decimal text, which took most of the time of wide rows. A whole number of
    millionths divided by a million is the same double, as long as the millionths are exact; other
    values, infinite and missing ones among them, are left to ``round``.
    """
    value = F.col(name) + 1e-9
    millionths = F.floor(F.abs(value) * 1e6 + 0.5)
    signed = F.when(value < 0, -millionths).otherwise(millionths)
    return F.when(F.abs(value) < 1e5, signed / 1e6).otherwise(F.round(value, 6)).alias(name)


def published(df: DataFrame) -> DataFrame:
    """Doubles to six digits."""
    return df.select(*[six_digits(name) if kind == "double" else F.col(name) for name, kind in df.dtypes])


def query(build: Callable[[ExampleWarehouse], DataFrame]) -> Callable[[ExampleWarehouse], DataFrame]:
    """Register a function of the example warehouse under its own name."""

    @wraps(build)
    def run(spark: SparkSession, source_folder: str) -> DataFrame:
        return published(build(example_warehouse(spark, source_folder)))

    QUERIES[build.__name__] = run
    return build


def scratch(w: ExampleWarehouse, name: str) -> str:
    return f"{w.tables.path}/files/{name}"


# Sources and sinks.


@query
def observations_from_files(w):
    folder = scratch(w, "observations")
    observations.write_observation_files(w.observations, folder)
    obs = observations.read_observations(w.spark, folder)
    weighted = F.aggregate(
        F.zip_with("hours_sale", F.sequence(F.lit(1), F.size("hours_sale")), lambda x, i: x * i),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    return obs.withColumns(
        {
            "hours_total": array_total(F.col("hours_sale")),
            "hours_weighted": weighted,
            "stock_flags": F.array_join(F.col("hours_stock_status").cast("array<string>"), ""),
        }
    ).drop("hours_sale", "hours_stock_status")


@query
def feature_scan(w):
    return files.feature_scan(
        w.training_features,
        split="train",
        start=date(2024, 1, 8),
        end=date(2024, 1, 21),
        first_category_id=1,
        trainable_only=True,
    )


@query
def feature_scan_limited(w):
    return files.feature_scan(w.training_features, store_id=3, limit=1000)


@query
def feature_export(w):
    return files.export_features(w.training_features, scratch(w, "model_features.parquet"))


@query
def prediction_export(w):
    path = scratch(w, "demand_2_predictions.parquet")
    return files.export_predictions(demand.clamp_prediction(w.predictions(ACTIVE_KEY)), path)


@query
def prediction_import(w):
    """A file with only the required columns, where some predictions do not read as numbers."""
    text = F.when(F.col("time_key") == 3, "n/a").otherwise(F.col("predicted_demand").cast("string"))
    given = w.predictions(ACTIVE_KEY).withColumn("predicted_demand", text)
    return demand.import_predictions(given, 4)


@query
def prediction_import_full(w):
    """A file with its own demand, lost sales and bounds."""
    given = w.predictions(ACTIVE_KEY).withColumns(
        {
            "estimated_true_demand": F.col("predicted_demand") * 0.5,
            "estimated_lost_sales": F.lit(0.3),
            "prediction_lower_bound": F.lit(0.1),
        }
    )
    return demand.import_predictions(given, 5)


@query
def metrics_flatten(w):
    return metric_documents.metrics_flatten(w.metrics_document())


@query
def metrics_export(w):
    path = scratch(w, "demand_2_metrics.json")
    files.write_document(w.metrics_document(), path)
    return metric_documents.metrics_flatten(files.read_document(w.spark, path))


@query
def metrics_import(w):
    """Metrics and metadata found beside the prediction file."""
    predictions = scratch(w, "import_predictions.parquet")
    described = w.scored().agg(
        F.to_json(
            F.struct(
                F.lit("constant").alias("model_type"),
                F.lit("cpu").alias("device"),
                F.lit(True).alias("advanced_features_enabled"),
                F.array(*[F.lit(name) for name in S.BASE_FEATURES]).alias("feature_columns"),
                F.count(F.lit(1)).alias("rows"),
            )
        ).alias("value")
    )
    paths = [files.sidecar_path(predictions, suffix) for suffix in ("_metrics.json", "_metadata.json")]
    for document, path in zip((w.metrics_document(), described), paths):
        files.write_document(document, path)
    read = [files.read_document(w.spark, path) for path in paths]
    rows = metric_documents.metrics_import(*read, ACTIVE_KEY)
    context = [F.col("metric_context")[key].alias(key) for key in ("model_type", "device", "feature_count")]
    return rows.select("model_key", "evaluation_split", "metric_name", "metric_value", *context)


@query
def queue_csv(w):
    return files.export_queue(published(queue.queue_highest(recent(w))), scratch(w, "actions.csv"))


@query
def table_counts(w):
    return kpi.table_counts(w.all_tables())


@query
def data_status(w):
    named = {
        "staging": w.observations,
        "daily_fact": w.fact_daily,
        "hourly_fact": w.fact_hourly,
        "demand_estimate": w.demand_estimates,
        "recommendation": w.recommendations,
    }
    return kpi.data_status(named, w.dim_date)


@query
def filter_options(w):
    return kpi.filter_options(w.dim_product, w.dim_store)


# Sampling.


def train_obs(w: ExampleWarehouse) -> DataFrame:
    return w.observations.filter(F.col("source_split") == "train")


def trainable(w: ExampleWarehouse, split: str = "train") -> DataFrame:
    usable = (F.col("source_split") == split) & F.col("is_trainable_demand_observation")
    return w.training_features.filter(usable).select("full_date", "product_id", *HOUR_COLUMNS)


@query
def split_caps(w):
    return sampling.split_caps(w.observations.select(*OBS_COLUMNS), OBS_ORDER, 700, {"train": 1500})


@query
def sample_head(w):
    return sampling.sample_head(train_obs(w).select(*OBS_COLUMNS), OBS_ORDER, 1000)


def _event_file(w: ExampleWarehouse) -> DataFrame:
    return w.spark.read.parquet(f"{w.source_folder}/events.parquet").select("event_id", "user_id", "event_type", "value")


@query
def sample_file_head(w):
    """The first rows as they lie in the file."""
    return sampling.sample_file_head(_event_file(w), 1500)


@query
def sample_file_blocks(w):
    """Random blocks of 400 rows of the file, until there are 1500 rows."""
    return sampling.sample_file_blocks(_event_file(w), 1500, block_rows=400)


@query
def sample_head_nulls(w):
    """More rows than a top-n takes, of an order whose leading column is null for one store in four."""
    rows = train_obs(w).select(*OBS_COLUMNS).withColumn("lead", F.when(F.col("store_id") % 4 > 0, F.col("store_id") % 3))
    return sampling.sample_head(rows, ["lead", *OBS_ORDER], 2500)


@query
def sample_bernoulli_capped(w):
    return sampling.sample_bernoulli(w.fact_hourly.select(*HOUR_COLUMNS), S.HOURLY_KEY, 0.2, SEED, cap=3000)


@query
def feature_scan_sampled(w):
    return files.feature_scan(w.training_features, split="train", sample_rate=0.5, seed=SEED, limit=4000)


@query
def sample_even(w):
    return sampling.sample_even(train_obs(w).select(*OBS_COLUMNS), OBS_ORDER, 1000)


@query
def stratified_quota(w):
    sizes = sampling.group_sizes(train_obs(w), ["dt", "product_id"])
    return sampling.stratified_quota(sizes, ["dt", "product_id"], 2500)


@query
def sample_date_stratified(w):
    return sampling.sample_stratified(train_obs(w).select(*OBS_COLUMNS), ["dt"], ["store_id", "product_id"], 1000)


@query
def sample_product_date_stratified(w):
    return sampling.sample_stratified(train_obs(w).select(*OBS_COLUMNS), ["dt", "product_id"], ["store_id"], 2500)


@query
def panel_select(w):
    return sampling.panel_select(train_obs(w), 1000, SEED)


@query
def panel_apply(w):
    return sampling.panel_apply(w.observations.select(*OBS_COLUMNS), sampling.panel_select(train_obs(w), 1000, SEED))


@query
def sample_bernoulli(w):
    return sampling.sample_bernoulli(w.fact_hourly.select(*HOUR_COLUMNS), S.HOURLY_KEY, 0.2, SEED)


@query
def sample_cap_random(w):
    return sampling.sample_cap_random(trainable(w), S.HOURLY_KEY, 5000, SEED)


@query
def sample_cap_ordered(w):
    order = ["date_key", "store_key", "product_key", "time_key"]
    return sampling.sample_cap_ordered(trainable(w), order, 5000)


@query
def sample_cap_product_date(w):
    return sampling.sample_cap_per_group(trainable(w), ["full_date", "product_id"], S.HOURLY_KEY, 5000, SEED)


@query
def sample_cap_date(w):
    return sampling.sample_cap_per_group(trainable(w), ["full_date"], S.HOURLY_KEY, 5000, SEED)


@query
def sample_rank(w):
    return sampling.sample_rank(trainable(w), ["full_date", "product_id"], S.HOURLY_KEY, SEED)


@query
def sample_exact_n(w):
    return sampling.sample_exact_n(w.observations.select(*OBS_COLUMNS), S.OBSERVATION_GRAIN, 1000, SEED)


@query
def eval_or_train_sample(w):
    """No evaluation rows reach the dates of the train split, so a training sample stands in."""
    train = trainable(w)
    none = trainable(w, "eval").filter(F.col("full_date") < train.agg(F.min("full_date")).scalar())
    return sampling.eval_or_train_sample(train, none, S.HOURLY_KEY, SEED, 50_000)


# Dimensions and facts.


@query
def dim_date(w):
    return dims.dim_date(w.observations)


@query
def dim_time(w):
    """The hours of the day, each with its rows in the hourly fact."""
    used = w.fact_hourly.groupBy("time_key").agg(F.count(F.lit(1)).alias("hourly_rows"))
    return w.dim_time.join(used, "time_key", "left")


@query
def dim_city(w):
    return dims.dim_city(w.observations)


@query
def dim_store(w):
    return dims.dim_store(w.observations, w.dim_city)


@query
def dim_product(w):
    return dims.dim_product(w.observations)


@query
def fact_daily(w):
    return facts.fact_daily(w.observations, w.dim_date, w.dim_store, w.dim_product)


@query
def fact_hourly(w):
    return facts.fact_hourly(w.observations, w.dim_date, w.dim_store, w.dim_product)


@query
def fact_hourly_window(w):
    return facts.fact_hourly(
        w.observations, w.dim_date, w.dim_store, w.dim_product, date(2024, 1, 10), date(2024, 1, 16)
    )


@query
def dim_model_upsert(w):
    """A known model gets a new stamp, a new one the next key."""
    stamp = w.dim_date.agg(F.date_add(F.max("full_date"), 10)).scalar()
    first = w.dim_date.agg(F.min("full_date")).scalar()
    again = dims.register_model(w.dim_model, "demand_2", "v1", stamp)
    return dims.register_model(again, "demand_4", "v1", stamp, first, stamp)


@query
def model_training_dates(w):
    return dims.with_training_dates(w.dim_model, w.demand_estimates, w.dim_date, 1)


def _corrections(w: ExampleWarehouse) -> DataFrame:
    """The eval rows and a late correction of the last train dates."""
    rows = w.fact_daily.filter(F.col("date_key") >= 20240120)
    return rows.withColumn("observed_daily_sales_amount", F.col("observed_daily_sales_amount") * 2)


@query
def upsert(w):
    existing = w.fact_daily.filter(F.col("source_split") == "train")
    return merge.upsert(existing, _corrections(w), S.DAILY_KEY)


@query
def upsert_columns(w):
    """Known dates change their holiday flag only."""
    existing = dims.dim_date(train_obs(w))
    incoming = w.dim_date.filter(F.col("date_key") >= 20240115).withColumns(
        {"holiday_flag": 1 - F.col("holiday_flag"), "day_name": F.lit("unused")}
    )
    return merge.upsert(existing, incoming, ["date_key"], update=["holiday_flag"])


@query
def upsert_keep(w):
    existing = dims.dim_date(train_obs(w))
    incoming = w.dim_date.filter(F.col("date_key") >= 20240115).withColumn("holiday_flag", F.lit(7))
    return merge.upsert(existing, incoming, ["date_key"], on_match="keep")


@query
def delete_model_output(w):
    left = merge.without_model(w.demand_estimates, 1)
    return left.groupBy("model_key", "date_key").agg(F.count(F.lit(1)).alias("estimate_rows"))


@query
def upsert_conflicts(w):
    """Stores in two cities, products in two categories, and keys in both splits."""
    obs = fixtures.conflicting_observations(w.observations)

    def clashes(kind: str, rows: DataFrame, keys: list[str]) -> DataFrame:
        found = merge.upsert_conflicts(rows, keys)
        return found.select(
            F.lit(kind).alias("table_name"),
            F.concat_ws("|", *[F.col(key).cast("string") for key in keys]).alias("key_text"),
            "incoming_rows",
        )

    parts = [
        clashes("dim_store", obs.select("store_id", "city_id").distinct(), ["store_id"]),
        clashes("dim_product", obs.select("product_id", *S.CATEGORY_LEVELS).distinct(), ["product_id"]),
        clashes("fact_daily", obs, ["dt", "store_id", "product_id"]),
    ]
    return reduce(DataFrame.unionByName, parts)


# Projections and filters.


def recent(w: ExampleWarehouse) -> DataFrame:
    return decisions.in_default_window(w.decision_scores, w.dim_date)


@query
def restock_monitor(w):
    return w.restock_monitor


@query
def training_features(w):
    return w.training_features


@query
def decision_filter(w):
    return decisions.decision_filter(
        w.decision_scores,
        date(2024, 1, 5),
        date(2024, 1, 25),
        first_category_id=1,
        store_id=4,
        action=S.RESTOCK,
    )


@query
def default_window(w):
    return decisions.default_window(w.dim_date)


@query
def restock_watchlist(w):
    return decisions.restock_watchlist(w.restock_monitor, F.lit(DAY_IN_FOCUS))


@query
def not_full_stockout(w):
    kept = queue.not_full_stockout(w.decision_scores)
    return kept.select(*drilldown.DAY, "stockout_hours_6_22", "observed_daily_sales_amount", "decision_action")


@query
def full_stockout_count(w):
    return queue.full_stockout_count(w.decision_scores)


@query
def hourly_status(w):
    return drilldown.hourly_status(drill(w)).select(*drilldown.DAY, "hour_of_day", "status")


@query
def hourly_evidence(w):
    return drilldown.hourly_evidence(drill(w))


@query
def urgency_breakdown(w):
    columns = ["stockout_contribution", "bias_contribution", "activity_contribution", "total_urgency"]
    return queue.urgency_breakdown(w.decision_scores).select(*drilldown.DAY, *columns)


@query
def category_band(w):
    return kpi.category_bands(kpi.category_pressure(w.decision_scores))


@query
def hour_class(w):
    return drilldown.hour_class(drill(w)).select(*drilldown.DAY, "hour_of_day", "hour_class")


@query
def full_business_stockout(w):
    return drilldown.full_business_stockout(drill(w))


# Aggregations.


@query
def stockout_rate_by_category(w):
    return kpi.stockout_rate_by_category(w.fact_daily, w.dim_product)


@query
def top_stockout_categories(w):
    return kpi.top_stockout_categories(kpi.stockout_rate_by_category(w.fact_daily, w.dim_product))


@query
def trainable_counts(w):
    return kpi.trainable_counts(w.training_features)


@query
def daily_trend(w):
    return kpi.daily_trend(w.fact_daily, w.dim_date)


@query
def kpi_by_day(w):
    return kpi.kpi_by(w.decision_scores, ["full_date"])


@query
def kpi_by_category(w):
    return kpi.kpi_by(w.decision_scores, S.CATEGORY_LEVELS)


@query
def action_distribution(w):
    return kpi.action_distribution(w.decision_scores)


@query
def action_counts(w):
    return kpi.action_counts(w.decision_scores)


@query
def category_pressure(w):
    return kpi.category_pressure(w.decision_scores)


@query
def summary(w):
    return kpi.summary(recent(w))


@query
def trend(w):
    return kpi.trend(recent(w))


@query
def what_if(w):
    return kpi.what_if(w.decision_scores, 0.5, 0.9)


@query
def action_lanes(w):
    return kpi.action_lanes(queue.queue_diverse(recent(w)))


@query
def model_quality(w):
    return models.model_quality(w.dim_model, w.model_evaluation)


@query
def newest_quality(w):
    return models.newest_quality(models.model_quality(w.dim_model, w.model_evaluation))


@query
def model_quality_latest(w):
    return models.model_quality_latest(w.dim_model, w.model_evaluation, w.model_output)


@query
def quality_guardrails(w):
    latest = models.model_quality_latest(w.dim_model, w.model_evaluation, w.model_output)
    return models.quality_guardrails(latest)


@query
def hourly_story(w):
    return drilldown.hourly_story(drill(w))


@query
def queue_saturation(w):
    return queue.queue_saturation(queue.queue_highest(recent(w)))


# Windows.


@query
def baseline_averages(w):
    rows = demand.with_baselines(w.fact_hourly, w.baseline_cells)
    return rows.select(*S.HOURLY_KEY, *demand.BASELINE_LEVELS)


@query
def product_avg(w):
    return decisions.product_average(w.fact_daily)


@query
def rank_per_action(w):
    columns = [*drilldown.DAY, "decision_action", "restock_urgency_score", "action_rank"]
    return queue.rank_per_action(w.decision_scores).select(*columns)


@query
def lag_1(w):
    return features.lag_one(w.training_features).select(*S.HOURLY_KEY, "product_sales_lag_1h")


@query
def rolling_sum_24(w):
    return features.rolling_sum(w.training_features).select(*S.HOURLY_KEY, "product_sales_lag_24h_sum")


@query
def days_since_previous_sale(w):
    rows = features.days_since_previous_sale(w.training_features)
    return rows.select(*S.HOURLY_KEY, "days_since_previous_sale")


@query
def days_since_last_sale(w):
    return features.days_since_last_sale(w.training_features).select(*S.HOURLY_KEY, "days_since_last_sale")


@query
def hour_ranges(w):
    return drilldown.stockout_hour_ranges(drill(w))


@query
def weighted_median(w):
    """The weighted median of each model's ratios, on the train split."""
    one = evaluation.wmape_factor(w.scored(1, "train")).select(F.lit(1).alias("model_key"), "wmape_factor")
    two = evaluation.wmape_factor(w.scored(2, "train")).select(F.lit(2).alias("model_key"), "wmape_factor")
    return one.unionByName(two)


# Sorts and top-k.


@query
def top_recommendations(w):
    return queue.top_recommendations(w.decision_scores)


@query
def queue_highest(w):
    return queue.queue_highest(recent(w))


@query
def queue_exclude_full(w):
    return queue.queue_exclude_full(recent(w))


@query
def queue_diverse(w):
    return queue.queue_diverse(recent(w))


@query
def priority_cards(w):
    columns = [*drilldown.DAY, "first_category_id", "card_position", "action_label", "total_urgency"]
    return queue.priority_cards(queue.queue_highest(recent(w))).select(*columns)


@query
def latest(w):
    return models.latest_model(w.dim_model)


@query
def quality_order(w):
    report = quality.data_quality_checks(fixtures.broken_observations(w.observations))
    return quality.quality_order(report)


@query
def melt(w):
    return drilldown.melt_amounts(drill(w))


# Data quality.


def _single_check(name: str, check: str) -> None:
    def build(w: ExampleWarehouse) -> DataFrame:
        return quality.single_check(fixtures.broken_observations(w.observations), check)

    build.__name__ = name
    query(build)


for _name, (_check, _, _) in zip(
    ("dq_sales_length", "dq_status_length", "dq_daily_sum", "dq_business_count", "dq_duplicates"), S.QUALITY_CHECKS
):
    _single_check(_name, _check)


@query
def data_quality_checks(w):
    return quality.data_quality_checks(w.observations)


@query
def failed_checks(w):
    return quality.failed_checks(quality.data_quality_checks(fixtures.broken_observations(w.observations)))


@query
def constraint_report(w):
    return quality.constraint_report(w.all_tables())


@query
def constraint_report_broken(w):
    """The constraints of tables built from conflicting and broken rows."""
    obs = fixtures.broken_observations(fixtures.conflicting_observations(w.observations))
    stores = materialise(obs.select("store_id", "city_id").distinct()).join(w.dim_city, "city_id")
    keyed = stores.join(w.dim_store.select("store_key", "store_id"), "store_id", "left")
    known_cities = w.dim_city.filter(F.col("city_key") > 1)
    return quality.constraint_report(
        {"observations": obs, "dim_city": known_cities, "dim_store": keyed.select(*S.DIM_STORE.names)}
    )


# Demand recovery and decisions.


@query
def fallback_choice(w):
    rows = demand.with_baselines(w.fact_hourly, w.baseline_cells)
    chosen = demand.fallback_choice(F.col("observed_sales_amount"))
    return rows.select(*S.HOURLY_KEY, chosen.alias("baseline"))


@query
def heuristic_demand(w):
    rows = demand.heuristic_demand(demand.with_baselines(w.fact_hourly, w.baseline_cells))
    return rows.select(*S.HOURLY_KEY, "heuristic_true_demand", "heuristic_lost_sales")


@query
def hourly_demand_estimate(w):
    return w.hourly_demand_estimate


@query
def clamp_prediction(w):
    return demand.clamp_prediction(w.predictions(ACTIVE_KEY)).select(*S.PREDICTION.names)


@query
def estimate_fact(w):
    return w.demand_estimates


@query
def estimate_fact_capped(w):
    """The first rows in key order, as in a short trial run."""
    order = ["date_key", "store_key", "product_key", "time_key"]
    capped = sampling.sample_cap_ordered(w.predictions(1), order, 5000)
    return demand.as_estimates(demand.clamp_prediction(capped), 1)


@query
def recommendations(w):
    return demand.recommendations(w.demand_estimates, w.fact_daily)


@query
def recommendations_for_level(w):
    return demand.recommendations(w.demand_estimates, w.fact_daily, 0.9)


@query
def decision_scores(w):
    return w.decision_scores


@query
def waste_risk(w):
    columns = [*drilldown.DAY, "has_stockout", "product_avg_daily_sales", "waste_risk_score"]
    return decisions.with_scores(w.decision_inputs).select(*columns)


@query
def urgency(w):
    columns = [*drilldown.DAY, "stockout_rate_6_22", "demand_bias_rate", "restock_urgency_score"]
    return decisions.with_scores(w.decision_inputs).select(*columns)


@query
def decision_action(w):
    return w.decision_scores.select(*drilldown.DAY, "decision_action", "decision_reason")


@query
def order_proxies(w):
    proxies = ["recommended_order_qty", "service_level_target", "expected_waste_qty"]
    return decisions.with_order_proxies(w.decision_inputs).select(*drilldown.DAY, *proxies)


def drill(w: ExampleWarehouse) -> DataFrame:
    return drilldown.hourly_drilldown(
        w.fact_hourly, w.dim_date, w.dim_store, w.dim_product, w.demand_estimates, w.active_model
    )


@query
def hourly_drilldown(w):
    return drill(w)


@query
def hourly_drilldown_day(w):
    return drilldown.select_day(drill(w), F.lit(DAY_IN_FOCUS), 3, 7)


@query
def hourly_drilldown_view(w):
    return drilldown.hourly_drilldown_view(w.hourly_demand_estimate, w.dim_date, w.dim_store, w.dim_product)


@query
def story_readout(w):
    return drilldown.story_readout(drill(w), w.decision_scores)


@query
def latest_model(w):
    return models.latest_model(w.dim_model)


@query
def latest_model_with_predictions(w):
    return models.latest_model_with_predictions(w.dim_model, w.model_output)


def _unmodelled(spark: SparkSession, source_folder: str) -> DataFrame:
    """Daily KPIs while no model is registered."""
    w = example_warehouse(spark, source_folder, with_models=False)
    return published(kpi.kpi_by(w.decision_scores, ["full_date"]))


QUERIES["kpi_by_day_unmodelled"] = _unmodelled


# Features.


@query
def demand_target(w):
    return features.demand_target(w.training_features).select(*S.HOURLY_KEY, "demand_target")


@query
def temporal_holdout(w):
    return features.temporal_holdout(w.training_features).select(*S.HOURLY_KEY, "part")


@query
def cyclic_time(w):
    return features.cyclic_time(w.training_features).select(*S.HOURLY_KEY, *S.CALENDAR_FEATURES)


@query
def promo_weather(w):
    return features.promo_weather(w.training_features).select(*S.HOURLY_KEY, *S.PROMO_FEATURES)


@query
def lags(w):
    return features.lags(w.training_features).select(*S.HOURLY_KEY, *S.TEMPORAL_FEATURES[2:])


@query
def store_traffic_lag_1h(w):
    return features.store_traffic(w.training_features).select(*S.HOURLY_KEY, "store_traffic_lag_1h")


@query
def category_momentum_24h(w):
    return features.category_momentum(w.training_features).select(*S.HOURLY_KEY, "category_momentum_24h")


def parts(w: ExampleWarehouse) -> DataFrame:
    return features.temporal_holdout(w.training_features)


def _prior_names() -> list[str]:
    return [f"{group}_{kind}" for group in S.PRIOR_GROUPS for kind in ("mean", "count_log1p")]


@query
def demand_priors(w):
    return features.demand_priors(parts(w)).select(*S.HOURLY_KEY, *_prior_names())


@query
def stockout_priors(w):
    return features.stockout_priors(parts(w)).select(*S.HOURLY_KEY, *S.STOCKOUT_FEATURES)


@query
def baseline_prior(w):
    rows = features.baseline_prior(features.demand_priors(parts(w)))
    return rows.select(*S.HOURLY_KEY, "baseline_demand_prior")


@query
def null_fill(w):
    names = ["is_weekend", "target_observed_sales_amount", "unknown_feature"]
    return features.null_fill(w.training_features, names).select(*S.HOURLY_KEY, *names)


@query
def prepare_features(w):
    return features.prepare_features(w.training_features).select(
        *S.HOURLY_KEY, "part", "demand_target", *S.ADVANCED_FEATURES
    )


@query
def prepare_features_saved(w):
    """The eval rows alone, prepared with the stored state of the fit part."""
    path = f"{shared_folder(w.spark)}/models/preparation"
    features.Preparation.of(prepared(w)).save(path)
    new_rows = w.training_features.filter(F.col("source_split") == "eval")
    again = features.Preparation.load(w.spark, path).apply(new_rows)
    return again.select(*S.HOURLY_KEY, "part", "demand_target", *S.ADVANCED_FEATURES)


def comparison_hours(w: ExampleWarehouse) -> DataFrame:
    return comparison.comparison_hourly(w.observations)


COMPARISON_KEY = ["source_split", "store_id", "product_id", "dt", "hour"]


@query
def comparison_hourly(w):
    return comparison_hours(w)


@query
def comparison_context(w):
    added = ["days_since_last_sale", "store_traffic_lag_1h", "category_momentum"]
    return comparison.comparison_context(comparison_hours(w)).select(*COMPARISON_KEY, *added)


@query
def comparison_baselines(w):
    return comparison.comparison_baselines(comparison_hours(w))


@query
def latent_target(w):
    return comparison.latent_target(comparison_hours(w)).select(*COMPARISON_KEY, "true_demand")


@query
def latent_target_observed(w):
    return comparison.latent_target(comparison_hours(w), "observed").select(*COMPARISON_KEY, "true_demand")


def _comparison_clean(w: ExampleWarehouse) -> DataFrame:
    """Comparison inputs with an infinite and a missing value put in."""
    rows = comparison.comparison_context(comparison_hours(w))
    damaged = rows.withColumns(
        {
            "discount": F.when(F.col("hour") == 5, float("inf")).otherwise(F.col("discount")),
            "product_subcategory": F.when(F.col("hour") != 6, F.col("product_subcategory")),
        }
    )
    kept = damaged.withColumns({f"key_{name}": F.col(name) for name in COMPARISON_KEY})
    return comparison.comparison_clean(kept, [f"key_{name}" for name in COMPARISON_KEY])


@query
def comparison_clean(w):
    return _comparison_clean(w)


@query
def comparison_encode(w):
    """Codes are fitted on all train rows; weeks that only the eval split reaches are unknown."""
    clean = _comparison_clean(w)
    return comparison.comparison_encode(clean, clean.filter(F.col("key_source_split") == "train"))


@query
def comparison_encode_saved(w):
    """The eval rows alone, encoded with stored codes and scales."""
    path = f"{shared_folder(w.spark)}/models/encoding"
    clean = _comparison_clean(w)
    comparison.Encoding.fit(clean.filter(F.col("key_source_split") == "train")).save(path)
    return comparison.Encoding.load(w.spark, path).apply(clean.filter(F.col("key_source_split") == "eval"))


# Models, evaluation and calibration.


@query
def predict_hurdle(w):
    rows = features.baseline_prior(features.demand_priors(parts(w)))
    value = evaluation.predict_hurdle(
        F.col("hour_of_day") / 24.0, F.log1p("observed_sales_amount"), F.col("baseline_demand_prior"), 0.35
    )
    return rows.select(*S.HOURLY_KEY, value.alias("prediction"))


@query
def metrics(w):
    return evaluation.metrics(w.scored())


@query
def bias_factor(w):
    return evaluation.bias_factor(w.scored())


@query
def wmape_factor(w):
    return evaluation.wmape_factor(w.scored())


@query
def calibration_factor(w):
    return evaluation.calibration_factor(w.scored(split="train"))


@query
def calibration_factor_bias(w):
    return evaluation.calibration_factor(w.scored(split="train"), "bias", upper=0.8)


@query
def calibration_factor_wmape(w):
    return evaluation.calibration_factor(w.scored(split="train"), "wmape")


@query
def segment_metrics(w):
    return evaluation.segment_metrics(w.scored())


@query
def comparison_metrics(w):
    return evaluation.comparison_metrics(w.scored())


@query
def evaluation_rows(w):
    context = F.array_join(
        F.transform(F.map_entries("metric_context"), lambda e: F.concat_ws("=", e["key"], e["value"])), ","
    )
    return w.model_evaluation.withColumn("metric_context", context)


def prepared(w: ExampleWarehouse) -> DataFrame:
    if not hasattr(w, "prepared_features"):
        w.prepared_features = materialise(features.prepare_features(w.training_features))
    return w.prepared_features


def fit_rows(w: ExampleWarehouse) -> DataFrame:
    return prepared(w).filter((F.col("part") == features.FIT) & F.col("is_trainable_demand_observation"))


def _once(w: ExampleWarehouse, name: str, fit: Callable[[], learning.DemandModel]) -> learning.DemandModel:
    """A model of the warehouse, fitted on first use."""
    models_of = w.__dict__.setdefault("fitted_models", {})
    if name not in models_of:
        models_of[name] = fit()
    return models_of[name]


def _predicted(w: ExampleWarehouse, model: learning.DemandModel) -> DataFrame:
    held_out = prepared(w).filter(F.col("part") == features.EVAL)
    return model.predict(held_out).select(*S.HOURLY_KEY, "demand_target", "prediction")


def _facts(predicted: DataFrame, keys: list[str]) -> DataFrame:
    """What holds for any sound model: every row is scored once and no prediction is missing or negative."""
    return predicted.agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_distinct(*keys).alias("keys_scored"),
        F.count_if(F.col("prediction") < 0).alias("negative_rows"),
        F.count_if(F.col("prediction").isNull()).alias("missing_rows"),
    )


def _fits_better(model: learning.DemandModel, fit: DataFrame, objective: str, target: str = "demand_target", power: float = 1.4) -> Column:
    """Whether the deviance on the fit rows is below that of their mean, the best constant there is."""
    label = F.greatest(F.col(target), F.lit(0.0))
    constant = fit.agg(F.avg(label)).scalar()
    both = [F.sum(boosting.deviance(objective, label, p, power)) for p in (F.col("prediction"), constant)]
    return model.predict(fit).agg((both[0] < both[1]).alias("better")).scalar()


def hurdle_model(w: ExampleWarehouse) -> learning.DemandModel:
    return _once(w, "hurdle", lambda: learning.fit_hurdle(fit_rows(w), features.feature_columns()))


def direct_model(w: ExampleWarehouse, objective: str) -> learning.DemandModel:
    options = learning.TrainingOptions(objective=objective)
    return _once(w, objective, lambda: learning.fit_direct(fit_rows(w), options=options))


@query
def fit_hurdle(w):
    return _predicted(w, hurdle_model(w))


@query
def fit_hurdle_facts(w):
    """With the class sizes and the weight of positive rows that the fit has used."""
    model = hurdle_model(w)
    used = {name: F.lit(value) for name, value in model.metadata.items()}
    return _facts(_predicted(w, model), S.HOURLY_KEY).withColumns(used)


@query
def fit_direct(w):
    return _predicted(w, direct_model(w, "tweedie"))


@query
def fit_direct_facts(w):
    model = direct_model(w, "tweedie")
    better = _fits_better(model, fit_rows(w), "tweedie")
    return _facts(_predicted(w, model), S.HOURLY_KEY).withColumn("fits_better", better)


@query
def fit_direct_poisson(w):
    return _predicted(w, direct_model(w, "poisson"))


@query
def fit_direct_poisson_facts(w):
    model = direct_model(w, "poisson")
    better = _fits_better(model, fit_rows(w), "poisson")
    return _facts(_predicted(w, model), S.HOURLY_KEY).withColumn("fits_better", better)


@query
def fit_direct_squared(w):
    return _predicted(w, direct_model(w, "squared"))


@query
def fit_direct_squared_facts(w):
    model = direct_model(w, "squared")
    better = _fits_better(model, fit_rows(w), "squared")
    return _facts(_predicted(w, model), S.HOURLY_KEY).withColumn("fits_better", better)


def comparison_encoded(w: ExampleWarehouse) -> DataFrame:
    if not hasattr(w, "encoded_comparison"):
        rows = comparison.latent_target(comparison.comparison_context(comparison_hours(w)))
        kept = rows.withColumns({f"key_{name}": F.col(name) for name in COMPARISON_KEY})
        clean = materialise(comparison.comparison_clean(kept, [f"key_{name}" for name in COMPARISON_KEY] + ["true_demand"]))
        train = clean.filter(F.col("key_source_split") == "train")
        w.encoded_comparison = materialise(comparison.comparison_encode(clean, train))
    return w.encoded_comparison


def _comparison_model(w: ExampleWarehouse, kind: str) -> learning.DemandModel:
    train = comparison_encoded(w).filter(F.col("key_source_split") == "train")
    return _once(w, f"comparison_{kind}", lambda: learning.fit_comparison(train, "true_demand", kind))


def _comparison_predicted(w: ExampleWarehouse, kind: str) -> DataFrame:
    held_out = comparison_encoded(w).filter(F.col("key_source_split") == "eval")
    names = [f"key_{name}" for name in COMPARISON_KEY] + ["true_demand"]
    return _comparison_model(w, kind).predict(held_out).select(*names, "prediction")


def _comparison_facts(w: ExampleWarehouse, kind: str) -> DataFrame:
    train = comparison_encoded(w).filter(F.col("key_source_split") == "train")
    objective = learning.COMPARISON_KINDS[kind]["objective"]
    better = _fits_better(_comparison_model(w, kind), train, objective, "true_demand", 1.5)
    return _facts(_comparison_predicted(w, kind), [f"key_{name}" for name in COMPARISON_KEY]).withColumn("fits_better", better)


@query
def fit_comparison(w):
    """The Poisson regressor with bounded steps."""
    return _comparison_predicted(w, "poisson")


@query
def fit_comparison_facts(w):
    return _comparison_facts(w, "poisson")


@query
def fit_comparison_best_first(w):
    return _comparison_predicted(w, "best_first")


@query
def fit_comparison_best_first_facts(w):
    return _comparison_facts(w, "best_first")


@query
def fit_comparison_symmetric(w):
    return _comparison_predicted(w, "symmetric")


@query
def fit_comparison_symmetric_facts(w):
    return _comparison_facts(w, "symmetric")


def base_model(w: ExampleWarehouse) -> learning.DemandModel:
    options = learning.TrainingOptions(objective="squared")
    return _once(w, "base", lambda: learning.fit_direct(fit_rows(w), S.BASE_FEATURES, options))


@query
def save_and_load_model(w):
    path = f"{shared_folder(w.spark)}/models/base"
    base_model(w).save(path)
    return _predicted(w, learning.DemandModel.load(path))


@query
def save_and_load_model_facts(w):
    """Rows that the loaded model scores, and how many of them unlike the saved one."""
    path = f"{shared_folder(w.spark)}/models/base_again"
    base_model(w).save(path)
    again = _predicted(w, learning.DemandModel.load(path)).withColumnRenamed("prediction", "again")
    both = _predicted(w, base_model(w)).join(never_broadcast(again.drop("demand_target")), S.HOURLY_KEY)
    return both.agg(F.count(F.lit(1)).alias("rows_scored"), F.count_if(F.col("prediction") != F.col("again")).alias("differing_rows"))


@query
def score_new_days(w):
    """A saved model and preparation, and rows that the same model scores otherwise after preparing everything at once."""
    path = f"{shared_folder(w.spark)}/models/scored"
    model = direct_model(w, "tweedie")
    model.save(path)
    features.Preparation.of(prepared(w)).save(path)
    again = score_job(w.spark, path, w.training_features.filter(F.col("source_split") == "eval"))
    later = again.select(*S.HOURLY_KEY, F.col("prediction").alias("again"))
    both = _predicted(w, model).join(never_broadcast(later), S.HOURLY_KEY)
    apart = F.abs(F.col("prediction") - F.col("again")) > 1e-6
    return both.agg(F.count(F.lit(1)).alias("rows_scored"), F.count_if(apart).alias("differing_rows"))


def training_run(w: ExampleWarehouse):
    if not hasattr(w, "run_once"):
        w.run_once = train_job(w.training_features, prepared=prepared(w))
    return w.run_once


@query
def train_job_metrics(w):
    """A whole training run; the result is its rows of the evaluation fact."""
    return training_run(w).evaluation(3)


@query
def train_job_facts(w):
    """Rows judged in both parts, and whether the factor keeps to its bounds."""
    run = training_run(w)
    bounded = 0.25 <= run.factor <= 5.0
    sizes = run.calibration.agg(F.count(F.lit(1)).alias("calibration_rows"))
    judged = run.held_out.agg(F.count(F.lit(1))).scalar()
    return sizes.select("calibration_rows", judged.alias("judged_rows"), F.lit(bounded).alias("factor_bounded"))


@query
def temporal_holdout_one_date(w):
    """A share that leaves one date: the last train date calibrates, the others fit."""
    rows = features.temporal_holdout(w.training_features, 0.0001)
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("hourly_rows"), F.count_distinct("full_date").alias("dates"))


from restock.plans import stored  # noqa: E402, F401 - registers the queries on stored tables
