"""Table schemas, keys and fixed values of the retail model."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_int, _long, _double = IntegerType(), LongType(), DoubleType()
_string, _bool, _date = StringType(), BooleanType(), DateType()


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Hours 6..21 are business hours: 16 of the 24.
HOURS_PER_DAY = 24
FIRST_BUSINESS_HOUR = 6
LAST_BUSINESS_HOUR = 21
BUSINESS_HOURS = LAST_BUSINESS_HOUR - FIRST_BUSINESS_HOUR + 1

SPLITS = ("train", "eval")

OBSERVATION_GRAIN = ["source_split", "store_id", "product_id", "dt"]

OBSERVATION = _table(
    source_split=_string,
    city_id=_long,
    store_id=_long,
    management_group_id=_long,
    first_category_id=_long,
    second_category_id=_long,
    third_category_id=_long,
    product_id=_long,
    dt=_date,
    sale_amount=_double,
    hours_sale=ArrayType(_double),
    stock_hour6_22_cnt=_int,
    hours_stock_status=ArrayType(_int),
    discount=_double,
    holiday_flag=_int,
    activity_flag=_int,
    precpt=_double,
    avg_temperature=_double,
    avg_humidity=_double,
    avg_wind_level=_double,
)

DIM_DATE = _table(
    date_key=_int,
    full_date=_date,
    day_of_week=_int,
    day_name=_string,
    week_of_year=_int,
    month_number=_int,
    month_name=_string,
    quarter_number=_int,
    year_number=_int,
    is_weekend=_bool,
    holiday_flag=_int,
)

DIM_TIME = _table(time_key=_int, hour_of_day=_int, is_business_hour_6_22=_bool, day_part=_string)
DIM_CITY = _table(city_key=_int, city_id=_long)
DIM_STORE = _table(store_key=_int, store_id=_long, city_key=_int)

DIM_PRODUCT = _table(
    product_key=_int,
    product_id=_long,
    management_group_id=_long,
    first_category_id=_long,
    second_category_id=_long,
    third_category_id=_long,
)

DIM_MODEL = _table(
    model_key=_int,
    model_name=_string,
    model_version=_string,
    training_start_date=_date,
    training_end_date=_date,
    created_at=TimestampNTZType(),
)

FACT_DAILY = _table(
    date_key=_int,
    store_key=_int,
    product_key=_int,
    source_split=_string,
    observed_daily_sales_amount=_double,
    stockout_hours_6_22=_int,
    stockout_hours_total=_int,
    has_stockout=_bool,
    discount_rate=_double,
    holiday_flag=_int,
    activity_flag=_int,
    precpt=_double,
    avg_temperature=_double,
    avg_humidity=_double,
    avg_wind_level=_double,
)

FACT_HOURLY = _table(
    date_key=_int,
    time_key=_int,
    store_key=_int,
    product_key=_int,
    source_split=_string,
    observed_sales_amount=_double,
    stockout_flag=_bool,
    is_censored_observation=_bool,
    discount_rate=_double,
    activity_flag=_int,
    precpt=_double,
    avg_temperature=_double,
    avg_humidity=_double,
    avg_wind_level=_double,
)

DEMAND_ESTIMATE = _table(
    date_key=_int,
    time_key=_int,
    store_key=_int,
    product_key=_int,
    model_key=_int,
    observed_sales_amount=_double,
    estimated_true_demand=_double,
    estimated_lost_sales=_double,
    stockout_flag=_bool,
    is_censored_observation=_bool,
    prediction_lower_bound=_double,
    prediction_upper_bound=_double,
)

RECOMMENDATION = _table(
    date_key=_int,
    store_key=_int,
    product_key=_int,
    model_key=_int,
    recommended_order_qty=_double,
    expected_demand=_double,
    expected_lost_sales=_double,
    stockout_risk_score=_double,
    expected_waste_qty=_double,
    service_level_target=_double,
)

MODEL_OUTPUT = _table(model_key=_int, demand_estimate_rows=_long, recommendation_rows=_long)

HOUR_SUMS = _table(
    period=_int,
    source_split=_string,
    store_key=_int,
    product_key=_int,
    time_key=_int,
    day_of_week=_int,
    sold_sum=_double,
    sold_count=_long,
    flagged=_long,
    hours=_long,
)

MODEL_EVALUATION = _table(
    model_key=_int,
    evaluation_split=_string,
    metric_name=_string,
    metric_value=_double,
    metric_context=MapType(_string, _string),
    created_at=TimestampNTZType(),
)

PREDICTION = _table(
    date_key=_int,
    time_key=_int,
    store_key=_int,
    product_key=_int,
    source_split=_string,
    observed_sales_amount=_double,
    stockout_flag=_bool,
    predicted_demand=_double,
    estimated_true_demand=_double,
    estimated_lost_sales=_double,
    prediction_lower_bound=_double,
    prediction_upper_bound=_double,
)

# Layout of the exported hourly feature file.
FEATURE = _table(
    date_key=_long,
    full_date=_date,
    time_key=_int,
    hour_of_day=_int,
    is_business_hour_6_22=_bool,
    store_key=_long,
    store_id=_long,
    city_id=_long,
    product_key=_long,
    product_id=_long,
    management_group_id=_long,
    first_category_id=_long,
    second_category_id=_long,
    third_category_id=_long,
    source_split=_string,
    observed_sales_amount=_double,
    stockout_flag=_bool,
    is_censored_observation=_bool,
    is_trainable_demand_observation=_bool,
    target_observed_sales_amount=_double,
    discount_rate=_double,
    activity_flag=_int,
    precpt=_double,
    avg_temperature=_double,
    avg_humidity=_double,
    avg_wind_level=_double,
    day_of_week=_int,
    is_weekend=_bool,
    holiday_flag=_int,
)

DAILY_KEY = ["date_key", "store_key", "product_key"]
HOURLY_KEY = ["date_key", "time_key", "store_key", "product_key"]
ESTIMATE_KEY = HOURLY_KEY + ["model_key"]
RECOMMENDATION_KEY = DAILY_KEY + ["model_key"]
EVALUATION_KEY = ["model_key", "evaluation_split", "metric_name"]
CATEGORY_LEVELS = ["management_group_id", "first_category_id", "second_category_id", "third_category_id"]

# Decision actions, first match wins, and the texts shown with them.
RESTOCK = "Restock immediately"
INCREASE = "Increase next order"
REDUCE = "Reduce order or markdown"
REVIEW = "Review censored demand"
MAINTAIN = "Maintain plan"

DECISION_REASONS = {
    RESTOCK: "High stockout/lost-sales signal; prioritize replenishment.",
    INCREASE: "Repeated business-hour stockouts indicate understocking.",
    REDUCE: "Low sales with no stockout suggests overstock or spoilage risk.",
    REVIEW: "Observed sales likely understate true customer demand.",
    MAINTAIN: "No strong intervention signal from current criteria.",
}

ACTION_LABELS = {
    RESTOCK: "Restock immediately",
    INCREASE: "Increase next replenishment",
    REDUCE: "Reduce order / markdown",
    REVIEW: "Review censored demand",
    MAINTAIN: "Maintain plan",
}

# Order of the action lanes on the management view.
LANE_ORDER = [RESTOCK, INCREASE, REDUCE, REVIEW, MAINTAIN]

# Order of the actions in the diverse queue.
DIVERSE_ORDER = [RESTOCK, INCREASE, REVIEW, REDUCE, MAINTAIN]

INVENTORY_NOTE = (
    "recommended_order_qty and waste_risk_score are DSS proxies because source data has no "
    "stock_on_hand, expiry date, lead time, or supplier constraint."
)

# Weights and thresholds of the daily scores.
URGENCY_STOCKOUT_WEIGHT = 0.55
URGENCY_BIAS_WEIGHT = 0.35
URGENCY_ACTIVITY_BONUS = 0.10
URGENCY_THRESHOLD = 0.65
STOCKOUT_RATE_THRESHOLD = 0.20
WASTE_THRESHOLD = 0.70
BIAS_THRESHOLD = 0.20
WASTE_SLACK = 1.25
SERVICE_LEVEL = 0.95
LOWER_BOUND_FACTOR = 0.85
UPPER_BOUND_FACTOR = 1.15

# Explanation texts of the hourly estimates.
HOURLY_EXPLANATIONS = {
    "model": "Trained model estimate from latest model in dw.dim_model.",
    "stockout": (
        "Fallback heuristic: stockout hour demand estimated from non-stockout sales using "
        "store-product-hour, product-hour, category-hour, product, then global-hour fallback."
    ),
    "observed": "Fallback heuristic: non-stockout hour uses observed sales as demand.",
}

DRILLDOWN_EXPLANATIONS = {
    "model": "Latest model prediction fact joined directly for selected store-product-date.",
    "stockout": "Hourly stockout observed, but no model prediction fact exists for this row.",
    "observed": "Non-stockout hour uses observed sales as demand.",
}

# Data quality checks as (name, severity, text).
QUALITY_CHECKS = [
    ("hours_sale_length_24", "critical", "Every source row must contain 24 hourly sales values."),
    ("hours_stock_status_length_24", "critical", "Every source row must contain 24 hourly stockout flags."),
    (
        "daily_sales_equals_hourly_sum",
        "warning",
        "Daily sales should equal the sum of hours_sale within floating-point tolerance.",
    ),
    (
        "business_hour_stockout_count_matches",
        "critical",
        "stock_hour6_22_cnt should equal stockout flags from hours 6 through 21.",
    ),
    (
        "duplicate_staging_grain",
        "critical",
        "The staging grain must be source_split, store_id, product_id, dt.",
    ),
]

# Model inputs read straight from the feature view.
BASE_FEATURES = [
    "hour_of_day",
    "is_business_hour_6_22",
    "day_of_week",
    "is_weekend",
    "holiday_flag",
    "activity_flag",
    "discount_rate",
    "precpt",
    "avg_temperature",
    "avg_humidity",
    "avg_wind_level",
    "city_id",
    "store_id",
    "product_id",
    "management_group_id",
    "first_category_id",
    "second_category_id",
    "third_category_id",
]

CALENDAR_FEATURES = ["hour_sin", "hour_cos", "dow_sin", "dow_cos"]
PROMO_FEATURES = ["discount_depth", "is_discounted", "is_promo_or_discount", "temperature_humidity_index"]

# Demand priors from the most specific grouping to the most general: name -> grouping keys.
PRIOR_GROUPS = {
    "store_product_hour": ["store_id", "product_id", "hour_of_day"],
    "product_hour": ["product_id", "hour_of_day"],
    "category_hour": ["first_category_id", "hour_of_day"],
    "product_dow": ["product_id", "day_of_week"],
    "category_dow": ["first_category_id", "day_of_week"],
    "store_product": ["store_id", "product_id"],
    "product": ["product_id"],
    "category": ["first_category_id"],
    "global_hour": ["hour_of_day"],
    "global_dow": ["day_of_week"],
}

STOCKOUT_GROUPS = {
    "store_product": ["store_id", "product_id"],
    "product": ["product_id"],
    "category": ["first_category_id"],
}

# The two global groupings enter the model with their means only.
PRIOR_FEATURES = [
    column
    for group in PRIOR_GROUPS
    for column in (
        [f"{group}_mean"] if group.startswith("global") else [f"{group}_mean", f"{group}_count_log1p"]
    )
] + ["baseline_demand_prior"]

STOCKOUT_FEATURES = [f"{group}_stockout_rate" for group in STOCKOUT_GROUPS]

TEMPORAL_FEATURES = [
    "store_traffic_lag_1h",
    "category_momentum_24h",
    "product_sales_lag_1h",
    "product_sales_lag_24h_sum",
    "days_since_previous_sale",
]

ADVANCED_FEATURES = (
    CALENDAR_FEATURES + PROMO_FEATURES + PRIOR_FEATURES + STOCKOUT_FEATURES + TEMPORAL_FEATURES
)

# Inputs of the comparison flow.
COMPARISON_NUMERIC = [
    "discount",
    "stock_on_hand",
    "selling_price",
    "product_price",
    "store_traffic_lag_1h",
    "category_momentum",
    "days_since_last_sale",
]

COMPARISON_CATEGORICAL = [
    "product_id",
    "location",
    "store_id",
    "product_category",
    "product_subcategory",
    "holiday",
    "is_promotion",
    "day_of_week",
    "week_of_year",
    "month",
    "year",
    "hour",
    "stockout_flag",
]
