"""Queries on stored tables: what loads, reloads, imports and resets leave behind."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock import schema as S
from restock.operators import features, kpi, metric_documents
from restock.operators.boundary import Boundary
from restock.operators.demand import BASELINE_LEVELS
from restock.plans.catalog import query, scratch
from restock.plans.examples import ExampleWarehouse
from restock.plans.jobs import import_job
from restock.plans.warehouse import Warehouse
from restock.sources import files

STAMP = "2024-02-01 00:00:00"
RELOADED = (date(2024, 1, 24), date(2024, 1, 27))


def _no_source() -> DataFrame:
    raise AssertionError("everything is stored or loaded")


def _new(w: ExampleWarehouse) -> Warehouse:
    return Warehouse(w.spark, f"{w.tables.path}-stored-{uuid.uuid4().hex}", _no_source)


def reopened(stored: Warehouse) -> Warehouse:
    """The same folder as a later session finds it: nothing but what is stored is known."""
    return Warehouse(stored.spark, stored.tables.path, _no_source)


def reloaded(w: ExampleWarehouse) -> Warehouse:
    """All observations loaded, then in a reopened warehouse the eval split again with promotions turned round; of the
    hours, four dates again.
    """
    if not hasattr(w, "reloaded_warehouse"):
        stored = _new(w)
        stored.load(w.observations)
        stored.load_hourly()
        stored = reopened(stored)
        turned = (1 - F.col("activity_flag")).cast("int")
        stored.load(w.observations.filter(F.col("source_split") == "eval").withColumn("activity_flag", turned))
        stored.load_hourly(*RELOADED)
        w.reloaded_warehouse = stored
    return reopened(w.reloaded_warehouse)


@query
def stored_daily_reload(w):
    return reloaded(w).fact_daily


@query
def stored_hourly_reload(w):
    """Hours of the reloaded dates follow the new observations, the others keep the first ones."""
    return reloaded(w).fact_hourly


def _prediction_files(w: ExampleWarehouse, name: str) -> tuple[str, str]:
    """A file over all hours and one over the first date only, under one stem each."""
    folder = scratch(w, f"stored-{uuid.uuid4().hex}")
    paths = f"{folder}/{name}_predictions.parquet", f"{folder}/{name}_short_predictions.parquet"
    hours = w.fact_hourly.select(*S.HOURLY_KEY, "observed_sales_amount", "stockout_flag")
    # A missing flag counts as a stockout.
    flag = F.when(F.col("time_key") != 5, F.col("stockout_flag"))
    given = hours.withColumn("stockout_flag", flag)
    given.withColumn("predicted_demand", F.lit(1.5)).write.parquet(paths[0])
    first = given.filter(F.col("date_key") == hours.agg(F.min("date_key")).scalar())
    first.withColumn("predicted_demand", F.lit(2.5)).write.parquet(paths[1])
    return paths


def _estimates_of(stored: Warehouse, key: int) -> DataFrame:
    return stored.demand_estimates.filter(F.col("model_key") == key).drop("model_key")


@query
def stored_import(w):
    """A second, shorter file of a model without replacement: its rows change, the others stay."""
    stored = reloaded(w)
    for path in _prediction_files(w, "kept"):
        key = import_job(stored, path, "kept", "1", STAMP)
    return _estimates_of(stored, key)


@query
def stored_import_replaced(w):
    """The same with replacement: only the second file's rows are left."""
    stored = reloaded(w)
    for path in _prediction_files(w, "replaced"):
        key = import_job(stored, path, "replaced", "1", STAMP, replace=True)
    return _estimates_of(stored, key)


@query
def stored_import_counts(w):
    """Recommendations and training dates of an imported model, and the counts kept beside the facts."""
    stored = reloaded(w)
    path = _prediction_files(w, "counted")[0]
    key = import_job(stored, path, "counted", "1", STAMP, service_level=0.9)
    of_model = F.col("model_key") == key
    days = stored.recommendations.filter(of_model).agg(F.sum("expected_demand")).scalar()
    kept = stored.model_output.filter(of_model).join(stored.dim_model, "model_key")
    return kept.select(
        "demand_estimate_rows", "recommendation_rows", "training_start_date", "training_end_date", days.alias("expected_demand")
    )


@query
def stored_metric_import(w):
    """Metrics five levels deep beside a prediction file, with one name given twice."""
    stored = reloaded(w)
    path = _prediction_files(w, "measured")[1]
    rows = w.fact_hourly.agg(F.count(F.lit(1)).alias("n"))
    text = F.format_string(
        '{"rows": %d, "on": true, "name": "x", "a_b": 1, "a": {"b": 2, "c": {"d": {"e": {"f": 3.5}}}}, "list": [1]}', "n"
    )
    files.write_document(rows.select(text.alias("value")), files.sidecar_path(path, "_metrics.json"))
    key = import_job(stored, path, "measured", "1", STAMP)
    kept = stored.model_evaluation.filter(F.col("model_key") == key)
    return kept.select("evaluation_split", "metric_name", "metric_value", F.col("created_at").cast("date").alias("loaded_on"))


@query
def stored_reset(w):
    """Rows of every table after a reset."""
    stored = _new(w)
    stored.load(w.observations)
    stored = reopened(stored)
    stored.reset()
    return kpi.table_counts(stored.all_tables())


def _two_models(w: ExampleWarehouse) -> Warehouse:
    """A model loaded in one session, another one registered in the next, and a third object that reads both."""
    stored = _new(w)
    stored.load(w.observations)
    stored.load_hourly()
    import_job(stored, _prediction_files(w, "old")[0], "old", "1", STAMP)
    later = reopened(stored)
    later.register_model("new", "1", STAMP)
    # The first object does not know of it, and still must not give its key again.
    stored.register_model("newest", "1", STAMP)
    later.register_model("old", "1", STAMP)
    return reopened(later)


@query
def stored_reopened_models(w):
    """Models with their stored rows: the old one keeps key and estimates, later ones get the next keys."""
    stored = _two_models(w)
    rows = stored.demand_estimates.groupBy("model_key").agg(F.count(F.lit(1)).alias("estimate_rows"))
    return stored.dim_model.join(rows, "model_key", "left").select("model_key", "model_name", "estimate_rows")


@query
def stored_reopened_reload(w):
    """Daily sums of views and facts in a reopened warehouse after one date is loaded again, read by another one."""
    stored = _new(w)
    stored.load(w.observations)
    stored.load_hourly()
    again = reopened(stored)
    again.load(w.observations.filter(F.col("dt") == RELOADED[0]).withColumn("sale_amount", F.col("sale_amount") * 2))
    again.load_hourly(RELOADED[0], RELOADED[0])
    seen = reopened(again)
    monitor = seen.restock_monitor.groupBy("full_date").agg(F.count(F.lit(1)).alias("monitor_rows"))
    daily = seen.fact_daily.join(seen.dim_date, "date_key").groupBy("full_date")
    hours = seen.training_features.groupBy("full_date").agg(F.count(F.lit(1)).alias("hourly_rows"))
    sums = daily.agg(F.sum("observed_daily_sales_amount").alias("sales"))
    return sums.join(monitor, "full_date").join(hours, "full_date")


def _rehoured(w: ExampleWarehouse) -> Warehouse:
    """Sums by period stored, then four dates loaded again in a reopened warehouse: sales doubled, stockouts turned."""
    if not hasattr(w, "rehoured_warehouse"):
        stored = _new(w)
        stored.load(w.observations)
        stored.load_hourly()
        stored.hour_sums  # noqa: B018 - stored by its first use
        again = reopened(stored)
        changed = w.observations.filter(F.col("dt").between(*RELOADED)).withColumns(
            {
                "hours_sale": F.transform("hours_sale", lambda sale: sale * 2),
                "hours_stock_status": F.transform("hours_stock_status", lambda status: 1 - status),
            }
        )
        again.load(changed)
        again.load_hourly(*RELOADED)
        w.rehoured_warehouse = again
    return reopened(w.rehoured_warehouse)


@query
def stored_baselines(w):
    """The averages of every cell after a reload, rolled up from stored sums of which the reload replaced one period."""
    return _rehoured(w).baseline_cells.select(*BASELINE_LEVELS["store_product_hour_avg"], *BASELINE_LEVELS)


def _last_fit(parts: DataFrame) -> date:
    return parts.filter(F.col("part") == features.FIT).agg(F.max("full_date").alias("day")).first().day


@query
def stored_priors(w):
    """Priors and stockout rates after a reload, from stored sums and the one period that the end of the fit part cuts."""
    stored = _rehoured(w)
    parts = features.temporal_holdout(stored.training_features)
    cells = stored.prior_cells(_last_fit(parts))
    priors = features.stockout_priors(features.demand_priors(parts, cells), cells)
    means = [f"{group}_{kind}" for group in S.PRIOR_GROUPS for kind in ("mean", "count_log1p")]
    return priors.select(*S.HOURLY_KEY, *means, *S.STOCKOUT_FEATURES)


def _boundary(w: ExampleWarehouse, rows: DataFrame, *ends: date) -> Boundary:
    """The state after the last of the dates, brought forward from one to the next and stored at each."""
    folder = scratch(w, f"boundary-{uuid.uuid4().hex}")
    state = None
    for end in ends:
        day = F.col("full_date")
        if state is None:
            found = Boundary.of(rows.filter(day <= F.lit(end)))
        else:
            found = state.advance(rows.filter((day > F.lit(start)) & (day <= F.lit(end))))
        found.save(f"{folder}/{end}")
        state, start = Boundary.load(w.spark, f"{folder}/{end}"), end
    return state


LAGGED = (date(2024, 1, 9), date(2024, 1, 10), date(2024, 1, 20))


@query
def stored_lags(w):
    """Lags of the dates after a stored state, from these dates and the state alone."""
    rows = w.training_features
    state = _boundary(w, rows, *LAGGED)
    lagged = state.lags(rows.filter(F.col("full_date") > F.lit(LAGGED[-1])))
    return lagged.select(
        *S.HOURLY_KEY, "product_sales_lag_1h", "product_sales_lag_24h_sum", "days_since_previous_sale"
    )


@query
def prepare_features_continued(w):
    """The calibration days as days that come in later: prepared with what the fit part has left behind, no row of it."""
    rows = w.training_features
    parts = features.prepare_features(rows)
    last = _last_fit(features.temporal_holdout(rows))
    state = features.Preparation.of(parts)
    new = rows.filter((F.col("source_split") == "train") & (F.col("full_date") > F.lit(last)))
    prepared = state.apply(new, features.CALIBRATION, _boundary(w, rows.filter("source_split = 'train'"), last))
    return prepared.select(*S.HOURLY_KEY, "demand_target", *S.ADVANCED_FEATURES)


@query
def metrics_flatten_deep(w):
    rows = w.fact_hourly.groupBy("time_key").agg(F.count(F.lit(1)).alias("n"))
    text = F.format_string('{"hour_%d": {"x": {"y": {"z": {"rows": %d, "none": null}}}, "x_y": 1}}', "time_key", "n")
    return metric_documents.metrics_flatten(rows.select(text.alias("value")))
