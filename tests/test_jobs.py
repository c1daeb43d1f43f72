"""The load, training and import jobs on their own warehouses."""

import pytest
from pyspark.sql import functions as F

from restock import schema as S
from restock.operators import demand, learning
from restock.operators.merge import DuplicateKeyError
from restock.plans import jobs
from restock.plans.warehouse import Warehouse
from restock.sources import files, observations

STAMP = "2024-02-01 00:00:00"


@pytest.fixture(scope="module")
def source(spark, warehouse, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("source"))
    few = warehouse.observations.filter(F.col("store_id") < 4)
    observations.write_observation_files(few, folder)
    return folder


@pytest.fixture(scope="module")
def loaded(spark, source, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("loaded")), lambda: None)
    jobs.load_job(spark, source, w, hourly=True)
    return w


def test_load_builds_the_star_schema(loaded):
    assert loaded.fact_hourly.count() == 24 * loaded.fact_daily.count() == 24 * loaded.observations.count()
    assert loaded.dim_store.count() == 4 and loaded.dim_date.count() == 30


def test_repeated_load_changes_nothing(spark, source, loaded):
    before = {name: getattr(loaded, name).collect() for name in ("dim_store", "dim_product", "fact_daily")}
    jobs.load_job(spark, source, loaded)
    for name, rows in before.items():
        assert sorted(map(str, rows)) == sorted(map(str, getattr(loaded, name).collect()))


def test_new_stores_are_numbered_after_those_in_use(spark, warehouse, loaded):
    keys = {r.store_id: r.store_key for r in loaded.dim_store.collect()}
    loaded.load(warehouse.observations.filter(F.col("store_id").isin(3, 5, 6)))
    after = {r.store_id: r.store_key for r in loaded.dim_store.collect()}
    assert {k: after[k] for k in keys} == keys
    assert sorted(after.values()) == list(range(1, 7))


def test_conflicting_rows_are_refused(warehouse, loaded):
    obs = warehouse.observations.filter(F.col("store_id") == 1)
    moved = obs.withColumn("city_id", F.when(F.col("dt") > F.lit("2024-01-20").cast("date"), 9).otherwise(F.col("city_id")))
    with pytest.raises(DuplicateKeyError):
        loaded.load(moved)


@pytest.mark.parametrize("mode", ["product-date-stratified", "date-stratified", "even", "head"])
def test_sample_modes_give_exactly_their_caps(spark, source, mode):
    obs = observations.read_observations(spark, source)
    rows = jobs.sample_observations(obs, mode, shared_cap=200, caps={"eval": 70})
    assert {r.source_split: r["count"] for r in rows.groupBy("source_split").count().collect()} == {"train": 200, "eval": 70}


def test_panel_keeps_whole_histories(spark, source):
    obs = observations.read_observations(spark, source)
    rows = jobs.sample_observations(obs, "store-product-panel", shared_cap=230)
    per_pair = rows.groupBy("store_id", "product_id").count().collect()
    assert {r["count"] for r in per_pair} == {30} and len(per_pair) == 10


def test_hourly_reload_leaves_other_dates_alone(loaded):
    from datetime import date

    before = loaded.fact_hourly.count()
    loaded.load_hourly(date(2024, 1, 3), date(2024, 1, 4))
    assert loaded.fact_hourly.filter(~F.col("date_key").isin(20240103, 20240104)).count() > 0
    assert loaded.fact_hourly.count() >= before
    with pytest.raises(ValueError):
        loaded.load_hourly(date(2024, 1, 5), date(2024, 1, 4))


def test_import_with_sidecars_and_replacement(spark, loaded, tmp_path):
    path = str(tmp_path / "elsewhere_predictions.parquet")
    hourly = loaded.fact_hourly
    hourly.select(*S.HOURLY_KEY, "observed_sales_amount", "stockout_flag", F.lit(1.5).alias("predicted_demand")).write.parquet(path)
    for suffix, text in (("_metrics.json", '{"mae": 0.5, "on": true, "name": "x", "segments": {"weekend": {"mae": 2}}}'), ("_metadata.json", '{"model_type": "t", "feature_columns": ["a", "b"]}')):
        files.write_document(spark.createDataFrame([(text,)], "value string"), files.sidecar_path(path, suffix))
    key = jobs.import_job(loaded, path, "elsewhere", "1", STAMP, service_level=0.9)
    assert loaded.demand_estimates.filter(F.col("model_key") == key).count() == hourly.count()
    metrics = {r.metric_name: r.metric_value for r in loaded.model_evaluation.collect()}
    assert metrics == {"mae": 0.5, "on": 1.0, "segments_weekend_mae": 2.0}
    assert loaded.model_evaluation.first().metric_context["feature_count"] == "2"
    row = loaded.dim_model.filter(F.col("model_key") == key).first()
    assert str(row.training_start_date) == "2024-01-01" and str(row.training_end_date) == "2024-01-30"
    assert loaded.recommendations.select("service_level_target").distinct().collect()[0][0] == 0.9

    # A shorter file under the same version: without replacement old rows stay, with it they go.
    short = str(tmp_path / "short_predictions.parquet")
    spark.read.parquet(path).filter(F.col("date_key") == 20240101).write.parquet(short)
    assert jobs.import_job(loaded, short, "elsewhere", "1", STAMP) == key
    assert loaded.demand_estimates.count() == hourly.count()
    jobs.import_job(loaded, short, "elsewhere", "1", STAMP, replace=True)
    assert loaded.demand_estimates.select("date_key").distinct().count() == 1


def test_import_needs_its_columns(warehouse):
    with pytest.raises(ValueError):
        demand.import_predictions(warehouse.predictions(1).drop("stockout_flag"), 1)
    with pytest.raises(ValueError):
        demand.import_predictions(warehouse.predictions(1).drop("predicted_demand"), 1)


def test_training_run_is_published(spark, loaded, tmp_path):
    run = jobs.train_job(loaded.training_features, learning.TrainingOptions(trees=2, depth=3))
    assert 0.25 <= run.factor <= 5.0
    key = jobs.publish_run(loaded, run, "hurdle", "1", "2024-03-01 00:00:00", str(tmp_path))
    mine = loaded.demand_estimates.filter(F.col("model_key") == key)
    assert mine.count() == loaded.fact_hourly.count()
    assert mine.filter(F.col("estimated_true_demand") < F.col("observed_sales_amount")).isEmpty()
    assert loaded.decision_scores.select("model_name").distinct().first().model_name == "hurdle"
    rows = run.features.limit(50).cache()
    again = learning.DemandModel.load(f"{tmp_path}/hurdle_1_model").predict(rows)
    assert sorted(r.prediction for r in again.collect()) == pytest.approx(sorted(r.prediction for r in run.model.predict(rows).collect()))


def test_reset_empties_everything(spark, source, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), lambda: None)
    jobs.load_job(spark, source, w, mode="head", shared_cap=50)
    assert w.fact_daily.count() == 100
    w.reset()
    assert all(df.isEmpty() for df in w.all_tables().values())
    jobs.load_job(spark, source, w, mode="head", shared_cap=20)
    assert w.fact_daily.count() == 40


@pytest.mark.parametrize("mode", ["product-date-stratified", "date-stratified", "random", "ordered"])
def test_training_caps(loaded, mode):
    rows = loaded.training_features.filter("source_split = 'train' AND NOT stockout_flag")
    taken = jobs.sample_training_rows(rows, cap=1500, mode=mode)
    assert taken.count() == taken.select(*jobs.ROW_KEY).distinct().count() == 1500


def test_training_without_eval_rows_judges_a_sample(loaded):
    only_train = loaded.training_features.filter("source_split = 'train'")
    options = learning.TrainingOptions(trees=2, depth=2, objective="squared")
    run = jobs.train_job(only_train, options, "direct", advanced=False, objective="bias", calibrate_on="eval", cap=2000, mode="random")
    assert run.held_out.count() == 2000
    assert run.factor == pytest.approx(min(max(run.raw_factor, 0.25), 5.0))


def test_steps_can_be_cleared(spark, loaded):
    """A job leaves steps for lazy readers; nothing of them is left after they are cleared."""
    import os

    from restock.session import clear_steps, materialise, shared_folder

    steps = f"{shared_folder(spark)}/steps"
    rows = materialise(spark.range(5))
    assert rows.count() == 5 and os.listdir(steps)
    kept = f"{steps}-kept"
    os.rename(steps, kept)
    os.makedirs(steps)
    materialise(spark.range(3))
    clear_steps(spark)
    assert not os.path.exists(steps)
    os.rename(kept, steps)
