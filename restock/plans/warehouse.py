"""The warehouse: observations in, star schema, model facts and views out.

Base tables are written once to a folder, partitioned by date, and read back, so every query
prunes dates and columns at the scan. Views are lazy DataFrames over them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from restock import schema as S
from restock.operators import decisions, demand, dims, facts, hour_sums, models
from restock.operators.merge import require_unique
from restock.session import read_in_small_parts
from restock.sources.tables import TableFolder

SCHEMAS = {
    "observations": S.OBSERVATION,
    "dim_date": S.DIM_DATE,
    "dim_time": S.DIM_TIME,
    "dim_city": S.DIM_CITY,
    "dim_store": S.DIM_STORE,
    "dim_product": S.DIM_PRODUCT,
    "dim_model": S.DIM_MODEL,
    "fact_daily": S.FACT_DAILY,
    "fact_hourly": S.FACT_HOURLY,
    "demand_estimates": S.DEMAND_ESTIMATE,
    "recommendations": S.RECOMMENDATION,
    "model_evaluation": S.MODEL_EVALUATION,
}

PARTITIONS = {
    "observations": ("source_split", "dt"),
    "fact_daily": ("date_key",),
    "fact_hourly": ("date_key",),
    "demand_estimates": ("model_key", "date_key"),
    "recommendations": ("model_key", "date_key"),
}

# Rows of a date lie together by store and product, so a drill-down skips most of its file.
ORDERS = {name: ("store_key", "product_key") for name in PARTITIONS if name != "observations"}

VIEWS = ("training_features", "restock_monitor", "hourly_demand_estimate", "decision_inputs", "decision_scores")


class Warehouse:
    """Tables of one folder.

    A table that is stored is read, whichever session stored it. Others are built on first use, from
    the observations that ``source`` gives if these are not stored either; model tables start empty.
    """

    def __init__(self, spark: SparkSession, folder: str, source: Callable[[], DataFrame]):
        self.spark = spark
        read_in_small_parts(spark)
        self.tables = TableFolder(spark, folder)
        self._source = source

    def _stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored table; the first time it is built and stored."""
        if self.tables.exists(name):
            return self.tables.read(name, SCHEMAS[name])
        return self.tables.write(build(), name, SCHEMAS[name], PARTITIONS.get(name, ()), ORDERS.get(name, ()))

    @cached_property
    def observations(self) -> DataFrame:
        return self._stored("observations", self._source)

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._stored("dim_date", lambda: dims.dim_date(self.observations))

    @cached_property
    def dim_time(self) -> DataFrame:
        return self._stored("dim_time", lambda: dims.dim_time(self.spark))

    @cached_property
    def dim_city(self) -> DataFrame:
        return self._stored("dim_city", lambda: dims.dim_city(self.observations))

    @cached_property
    def dim_store(self) -> DataFrame:
        return self._stored("dim_store", lambda: dims.dim_store(self.observations, self.dim_city))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._stored("dim_product", lambda: dims.dim_product(self.observations))

    @cached_property
    def fact_daily(self) -> DataFrame:
        inputs = lambda: (self.observations, self.dim_date, self.dim_store, self.dim_product)
        return self._stored("fact_daily", lambda: facts.fact_daily(*inputs()))

    @cached_property
    def fact_hourly(self) -> DataFrame:
        inputs = lambda: (self.observations, self.dim_date, self.dim_store, self.dim_product)
        return self._stored("fact_hourly", lambda: facts.fact_hourly(*inputs()))

    # Model tables start empty; a model run or an import fills them.

    def _empty(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], SCHEMAS[name])

    def _stored_or_empty(self, name: str) -> DataFrame:
        return self.tables.read(name, SCHEMAS[name]) if self.tables.exists(name) else self._empty(name)

    @cached_property
    def dim_model(self) -> DataFrame:
        return self._stored_or_empty("dim_model")

    @cached_property
    def demand_estimates(self) -> DataFrame:
        return self._stored_or_empty("demand_estimates")

    @cached_property
    def recommendations(self) -> DataFrame:
        return self._stored_or_empty("recommendations")

    @cached_property
    def model_evaluation(self) -> DataFrame:
        return self._stored_or_empty("model_evaluation")

    @cached_property
    def model_output(self) -> DataFrame:
        """Rows per model in the model facts, stored so that views need not open the facts."""
        if self.tables.exists("model_output"):
            return self.tables.read("model_output", S.MODEL_OUTPUT)
        return self._counted()

    def _counted(self) -> DataFrame:
        counts = models.model_output(self.demand_estimates, self.recommendations)
        return self.tables.write(counts, "model_output", S.MODEL_OUTPUT)

    def _recount(self) -> None:
        """Bring the stored counts up to date after a change; only footers of the facts are read."""
        self.model_output = self._counted()

    # Views.

    @cached_property
    def training_features(self) -> DataFrame:
        return facts.training_features(
            self.fact_hourly, self.dim_date, self.dim_time, self.dim_store, self.dim_city, self.dim_product
        )

    @cached_property
    def restock_monitor(self) -> DataFrame:
        return decisions.restock_monitor(
            self.fact_daily, self.dim_date, self.dim_store, self.dim_city, self.dim_product
        )

    @property
    def active_model(self) -> Column:
        return models.active_model(self.dim_model, self.model_output)

    @cached_property
    def baseline_cells(self) -> DataFrame:
        """The averages behind the heuristic, rolled up once for all views until hours or products change."""
        return demand.baseline_cells_of_sums(self.hour_sums, self.dim_product)

    @cached_property
    def hour_sums(self) -> DataFrame:
        """Sums of the hourly fact by period. Periods that are not stored are summed up and stored first.

        A reload of hours removes the periods of its dates ahead of its first write, so one that
        breaks off leaves no sums behind that differ from the fact.
        """
        calendar = hour_sums.periods(self.dim_date)
        loaded = {row.date_key for row in self.fact_hourly.select("date_key").distinct().collect()}
        stored = set()
        if self.tables.exists("hour_sums"):
            stored = {row.period for row in self.tables.read("hour_sums", S.HOUR_SUMS).select("period").distinct().collect()}
        missing = [keys for period, keys in calendar.items() if period not in stored and loaded.intersection(keys)]
        if missing or not stored:
            dates = [key for keys in missing for key in keys]
            rows = hour_sums.hour_sums(self.fact_hourly.filter(F.col("date_key").isin(dates)), self.dim_date)
            return self.tables.write(rows, "hour_sums", S.HOUR_SUMS, ("period",), ("store_key", "product_key"))
        return self.tables.read("hour_sums", S.HOUR_SUMS)

    def prior_cells(self, last_fit) -> DataFrame:
        """The cells behind the priors of train hours up to a date, from the stored sums."""
        places = self.dim_time, self.dim_store, self.dim_product
        return hour_sums.fit_cells(self.hour_sums, self.fact_hourly, self.dim_date, *places, last_fit)

    @cached_property
    def hourly_demand_estimate(self) -> DataFrame:
        return demand.hourly_demand_estimate(
            self.fact_hourly, self.baseline_cells, self.demand_estimates, self.active_model
        )

    @cached_property
    def decision_inputs(self) -> DataFrame:
        return decisions.decision_inputs(
            self.fact_daily,
            self.dim_date,
            self.dim_store,
            self.dim_city,
            self.dim_product,
            self.recommendations,
            self.active_model,
        )

    @cached_property
    def decision_scores(self) -> DataFrame:
        return decisions.decision_scores(self.decision_inputs)

    def all_tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in SCHEMAS}

    # Changes.

    def _upsert(self, name: str, incoming: DataFrame, keys: list[str], **rules) -> None:
        partitions = PARTITIONS.get(name, ())
        table = self.tables.upsert(incoming, name, SCHEMAS[name], keys, partitions, ORDERS.get(name, ()), **rules)
        self._forget(VIEWS)
        if name in ("fact_hourly", "dim_product"):
            self._forget(["baseline_cells"])
        setattr(self, name, table)

    def _forget(self, names) -> None:
        for name in names:
            self.__dict__.pop(name, None)

    def load(self, obs: DataFrame) -> None:
        """Add observations: upsert them, the dimensions and the daily fact.

        Known dates only get a new holiday flag, known stores a new city, known products new
        categories; new ones are numbered after those in use.
        """
        self._upsert("observations", obs, S.OBSERVATION_GRAIN)
        self._upsert("dim_date", dims.dim_date(obs), ["date_key"], update=["holiday_flag"])
        self._upsert("dim_time", dims.dim_time(self.spark), ["time_key"], on_match="keep")
        self._extend("dim_city", obs.select("city_id"), ["city_id"], "city_key")
        stores = obs.select("store_id", "city_id").distinct().join(self.dim_city, "city_id")
        self._extend("dim_store", stores.drop("city_id"), ["store_id"], "store_key")
        products = obs.select("product_id", *S.CATEGORY_LEVELS).distinct()
        self._extend("dim_product", products, ["product_id"], "product_key")
        daily = facts.fact_daily(obs, self.dim_date, self.dim_store, self.dim_product)
        self._upsert("fact_daily", daily, S.DAILY_KEY)

    def _extend(self, name: str, incoming: DataFrame, natural: list[str], key: str) -> None:
        known = self._stored_or_empty(name)
        attributes = [column for column in SCHEMAS[name].names if column not in (key, *natural)]
        require_unique(incoming.distinct(), natural)
        extended = dims.extend_dimension(known, incoming, natural, key)
        if attributes:
            patch = incoming.distinct().join(extended.select(key, *natural), natural)
            self._upsert(name, patch.select(*SCHEMAS[name].names), natural)
        else:
            self._upsert(name, extended, natural)

    def load_hourly(self, start=None, end=None) -> None:
        """Load or reload the hourly fact for a range of dates; other dates are left alone."""
        hours = facts.fact_hourly(
            self.observations, self.dim_date, self.dim_store, self.dim_product, start, end
        )
        self._drop_sums(start, end)
        self._upsert("fact_hourly", hours, S.HOURLY_KEY)

    def _drop_sums(self, start=None, end=None) -> None:
        days = self.dim_date
        if start is not None:
            days = days.filter(F.col("full_date") >= F.lit(start))
        if end is not None:
            days = days.filter(F.col("full_date") <= F.lit(end))
        if self.tables.exists("hour_sums"):
            for period in hour_sums.periods(days):
                self.tables.drop_partition("hour_sums", "period", period)
        self._forget(["hour_sums"])

    def register_model(self, name: str, version: str, created_at, start=None, end=None) -> int:
        # Read anew: another session may have registered models since.
        self._forget(["dim_model"])
        registered = dims.register_model(self.dim_model, name, version, created_at, start, end)
        self._upsert("dim_model", registered, ["model_key"])
        same = (F.col("model_name") == name) & (F.col("model_version") == version)
        return self.dim_model.filter(same).first().model_key

    def load_estimates(self, estimates: DataFrame) -> None:
        self._upsert("demand_estimates", estimates, S.ESTIMATE_KEY)
        self._recount()

    def load_recommendations(self, model_key: int, service_level: float = S.SERVICE_LEVEL) -> None:
        """Daily recommendations of one model, all dates in one job."""
        of_model = self.demand_estimates.filter(F.col("model_key") == model_key)
        rows = demand.recommendations(of_model, self.fact_daily, service_level)
        self._upsert("recommendations", rows, S.RECOMMENDATION_KEY)
        self._recount()

    def refresh_training_dates(self, model_key: int) -> None:
        self._forget(["dim_model"])
        updated = dims.with_training_dates(self.dim_model, self.demand_estimates, self.dim_date, model_key)
        self._upsert("dim_model", updated, ["model_key"])

    def load_evaluation(self, rows: DataFrame, created_at) -> None:
        stamp = created_at if hasattr(created_at, "cast") else F.lit(created_at)
        stamped = rows.withColumn("created_at", stamp.cast("timestamp_ntz"))
        self._upsert("model_evaluation", stamped, S.EVALUATION_KEY)

    def delete_model_output(self, model_key: int) -> None:
        """Remove a model's estimates and recommendations, which are whole partitions, before a reimport."""
        for name in ("demand_estimates", "recommendations"):
            if self.tables.exists(name):
                self.tables.drop_partition(name, "model_key", model_key)
                setattr(self, name, self.tables.read(name, SCHEMAS[name]))
        self._recount()
        self._forget(VIEWS)

    def reset(self) -> None:
        """Empty all tables."""
        self.tables.truncate(SCHEMAS)
        self._forget([*SCHEMAS, *VIEWS, "baseline_cells", "hour_sums"])
        self.tables.drop("hour_sums")
        for name in SCHEMAS:
            setattr(self, name, self.tables.read(name, SCHEMAS[name]))
        self.tables.truncate({"model_output": S.MODEL_OUTPUT})
        self.model_output = self.tables.read("model_output", S.MODEL_OUTPUT)
