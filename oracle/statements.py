"""One statement per query, as (SQL, names of its double columns)."""

import re

from oracle.base import RELATIONS

STATEMENTS: dict[str, tuple[str, str]] = {}


def add(name: str, sql: str, doubles: str = "") -> None:
    STATEMENTS[name] = (sql, doubles)


WEATHER = "precpt avg_temperature avg_humidity avg_wind_level"
FEATURE_DOUBLES = "observed_sales_amount target_observed_sales_amount discount_rate " + WEATHER
ESTIMATE_DOUBLES = (
    "observed_sales_amount estimated_true_demand estimated_lost_sales prediction_lower_bound prediction_upper_bound"
)
KEY = "date_key, time_key, store_key, product_key"

# Sources and sinks.
add(
    "observations_from_files",
    """SELECT * EXCLUDE (hours_sale, hours_stock_status), list_sum(hours_sale) AS hours_total,
       list_sum(list_transform(hours_sale, lambda x, i: x * i)) AS hours_weighted,
       array_to_string(hours_stock_status, '') AS stock_flags FROM obs""",
    "sale_amount discount hours_total hours_weighted " + WEATHER,
)
add(
    "feature_scan",
    """SELECT * FROM features WHERE source_split = 'train' AND first_category_id = 1 AND NOT stockout_flag
       AND full_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'""",
    FEATURE_DOUBLES,
)
add(
    "feature_scan_limited",
    """SELECT * FROM features WHERE store_id = 3
       ORDER BY date_key, source_split, store_key, product_key, time_key LIMIT 1000""",
    FEATURE_DOUBLES,
)
add(
    "feature_export",
    """SELECT * REPLACE (CAST(date_key AS BIGINT) AS date_key, CAST(store_key AS BIGINT) AS store_key,
       CAST(product_key AS BIGINT) AS product_key) FROM features""",
    FEATURE_DOUBLES,
)
CLAMPED = f"""SELECT {KEY}, source_split, observed_sales_amount, stockout_flag, predicted_demand,
       demand AS estimated_true_demand, CAST(lost AS DOUBLE) AS estimated_lost_sales, low AS prediction_lower_bound,
       high AS prediction_upper_bound FROM clamped WHERE model_key = 2"""
add("prediction_export", CLAMPED, "predicted_demand " + ESTIMATE_DOUBLES)
add("clamp_prediction", CLAMPED, "predicted_demand " + ESTIMATE_DOUBLES)
add(
    "prediction_import",
    f"""SELECT {KEY}, CAST(4 AS INT) AS model_key, observed_sales_amount, d AS estimated_true_demand,
       CASE WHEN stockout_flag THEN d - observed_sales_amount ELSE 0 END AS estimated_lost_sales,
       stockout_flag, stockout_flag AS is_censored_observation,
       CASE WHEN stockout_flag THEN GREATEST(d * 0.85::DOUBLE, observed_sales_amount) ELSE observed_sales_amount END AS prediction_lower_bound,
       CASE WHEN stockout_flag THEN GREATEST(d * 1.15::DOUBLE, observed_sales_amount) ELSE observed_sales_amount END AS prediction_upper_bound
       FROM (SELECT *, CASE WHEN stockout_flag THEN GREATEST(CASE WHEN time_key = 3 THEN 0 ELSE predicted_demand END, observed_sales_amount)
                            ELSE observed_sales_amount END AS d FROM pred2)""",
    ESTIMATE_DOUBLES,
)
add(
    "prediction_import_full",
    f"""SELECT {KEY}, CAST(5 AS INT) AS model_key, observed_sales_amount,
       CASE WHEN stockout_flag THEN GREATEST(d, observed_sales_amount) ELSE observed_sales_amount END AS estimated_true_demand,
       CASE WHEN stockout_flag THEN GREATEST(d - observed_sales_amount, 0.3::DOUBLE) ELSE 0 END AS estimated_lost_sales,
       stockout_flag, stockout_flag AS is_censored_observation, CAST(0.1 AS DOUBLE) AS prediction_lower_bound,
       CASE WHEN stockout_flag THEN GREATEST(d * 1.15::DOUBLE, observed_sales_amount) ELSE observed_sales_amount END AS prediction_upper_bound
       FROM (SELECT *, predicted_demand * 0.5::DOUBLE AS d FROM pred2)""",
    ESTIMATE_DOUBLES,
)

# Metrics of the scored rows, as long tables.
MEASURES = """CAST(COUNT(*) AS DOUBLE) AS rows, AVG(ABS(p - y)) AS mae, SQRT(AVG((p - y) * (p - y))) AS rmse,
       CASE WHEN SUM(ABS(y)) > 0 THEN SUM(ABS(p - y)) / SUM(ABS(y)) ELSE 0 END AS wmape,
       CASE WHEN SUM(ABS(y)) > 0 THEN SUM(p - y) / SUM(ABS(y)) ELSE 0 END AS bias"""
SEGMENTED = """(SELECT *, UNNEST([CASE WHEN is_business_hour_6_22 THEN 'business_hour' ELSE 'non_business_hour' END,
                    CASE WHEN is_weekend THEN 'weekend' ELSE 'weekday' END,
                    CASE WHEN promo THEN 'promo_or_discount' END]) AS segment FROM {0})"""


def metrics_sql(source: str, group: str = "") -> str:
    head = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return f"SELECT {head}{MEASURES} FROM {source}{tail}"


def melted(sql: str, keys: str = "") -> str:
    """Metric columns as rows of (metric_name, metric_value)."""
    return f"(UNPIVOT ({sql}) ON rows, mae, rmse, wmape, bias INTO NAME metric_name VALUE metric_value)"


FACTOR = "(SELECT LEAST(GREATEST(SUM(y) / SUM(p), 0.25), 5.0) FROM scored WHERE model_key = {0} AND source_split = 'train')"


def scaled(model: int, split: str) -> str:
    return (
        f"(SELECT * REPLACE (p * {FACTOR.format(model)} AS p) FROM scored "
        f"WHERE model_key = {model} AND source_split = '{split}')"
    )


def plain(model: int, split: str) -> str:
    return f"(SELECT * FROM scored WHERE model_key = {model} AND source_split = '{split}')"


ACTIVE_METRICS = f"""
SELECT metric_name, metric_value FROM {melted(metrics_sql(scaled(2, 'eval')))}
UNION ALL SELECT 'uncalibrated_' || metric_name, metric_value FROM {melted(metrics_sql(plain(2, 'eval')))}
UNION ALL SELECT 'segments_' || segment || '_' || metric_name, metric_value
  FROM {melted("SELECT * FROM (" + metrics_sql(SEGMENTED.format(scaled(2, 'eval')), 'segment') + ") WHERE segment IS NOT NULL")}
UNION ALL SELECT 'calibration_factor', {FACTOR.format(2)}
UNION ALL SELECT 'calibrated', 1.0"""
add("metrics_flatten", ACTIVE_METRICS, "metric_value")
add("metrics_export", ACTIVE_METRICS, "metric_value")
add(
    "metrics_import",
    f"""SELECT CAST(2 AS INT) AS model_key, 'eval' AS evaluation_split, metric_name, metric_value, 'constant' AS model_type,
       'cpu' AS device, '18' AS feature_count FROM ({ACTIVE_METRICS})""",
    "metric_value",
)


def evaluation_sql(model: int) -> str:
    raw = f"(SELECT SUM(y) / SUM(p) FROM scored WHERE model_key = {model} AND source_split = 'train')"
    tail = "'split=train_calibration'"
    segments = (
        "SELECT * FROM (" + metrics_sql(SEGMENTED.format(scaled(model, "eval")), "segment") + ") WHERE segment IS NOT NULL"
    )
    return f"""
SELECT {model} AS model_key, * FROM (
  SELECT 'eval' AS evaluation_split, metric_name, metric_value, '' AS metric_context FROM {melted(metrics_sql(scaled(model, 'eval')))}
  UNION ALL SELECT 'eval', 'calibration_factor', {FACTOR.format(model)}, ''
  UNION ALL SELECT 'eval', 'raw_calibration_factor', {raw}, ''
  UNION ALL SELECT 'eval_uncalibrated', metric_name, metric_value, '' FROM {melted(metrics_sql(plain(model, 'eval')))}
  UNION ALL SELECT 'eval', 'uncalibrated_' || metric_name, metric_value, '' FROM {melted(metrics_sql(plain(model, 'eval')))}
  UNION ALL SELECT 'segment:' || segment, metric_name, metric_value, 'segment=' || segment FROM {melted(segments)}
  UNION ALL SELECT 'train_calibration', metric_name, metric_value, {tail} FROM {melted(metrics_sql(scaled(model, 'train')))}
  UNION ALL SELECT 'train_calibration_uncalibrated', metric_name, metric_value, {tail} FROM {melted(metrics_sql(plain(model, 'train')))})"""


EVALUATION = f"{evaluation_sql(1)} UNION ALL {evaluation_sql(2)}"
add(
    "evaluation_rows",
    f"""SELECT CAST(v.model_key AS INT) AS model_key, evaluation_split, metric_name, metric_value, metric_context, created_at
        FROM ({EVALUATION}) v JOIN dim_model m ON m.model_key = v.model_key""",
    "metric_value",
)
add(
    "queue_csv",
    "SELECT * FROM top_queue",
    "observed_daily_sales_amount estimated_true_demand estimated_lost_sales recommended_order_qty stockout_rate_6_22 "
    "demand_bias_rate waste_risk_score restock_urgency_score service_level_target expected_waste_qty",
)
COUNTED = {
    "observations": "obs",
    "dim_date": "dim_date",
    "dim_time": "dim_time",
    "dim_city": "dim_city",
    "dim_store": "dim_store",
    "dim_product": "dim_product",
    "dim_model": "dim_model",
    "fact_daily": "daily",
    "fact_hourly": "hourly",
    "demand_estimates": "estimates",
    "recommendations": "recs",
    "model_evaluation": f"({EVALUATION})",
}
add(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {rel}" for name, rel in COUNTED.items()),
)
add(
    "data_status",
    """SELECT (SELECT COUNT(*) FROM obs) AS staging_rows, (SELECT COUNT(*) FROM daily) AS daily_fact_rows,
       (SELECT COUNT(*) FROM hourly) AS hourly_fact_rows, (SELECT COUNT(*) FROM estimates) AS demand_estimate_rows,
       (SELECT COUNT(*) FROM recs) AS recommendation_rows, MIN(full_date) AS min_date, MAX(full_date) AS max_date
       FROM dim_date""",
)
add(
    "filter_options",
    """SELECT DISTINCT 'category' AS option_kind, first_category_id AS option_value FROM dim_product
       UNION ALL SELECT 'store', store_id FROM dim_store UNION ALL SELECT 'product', product_id FROM dim_product""",
)

# Sampling.
OBS_COLUMNS = "source_split, store_id, product_id, dt, sale_amount"
TRAIN = "(SELECT * FROM obs WHERE source_split = 'train')"
TRAINABLE = (
    f"(SELECT full_date, product_id, {KEY}, observed_sales_amount FROM features "
    "WHERE source_split = '{0}' AND NOT stockout_flag)"
)
HASH = "md5('42|' || date_key || '|' || time_key || '|' || store_key || '|' || product_key)"
ORDER = "store_id, product_id, dt"
add(
    "split_caps",
    f"""SELECT {OBS_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY source_split ORDER BY {ORDER}) AS n FROM obs)
        WHERE n <= CASE source_split WHEN 'train' THEN 1500 ELSE 700 END""",
    "sale_amount",
)
add("sample_head", f"SELECT {OBS_COLUMNS} FROM {TRAIN} ORDER BY {ORDER} LIMIT 1000", "sale_amount")
add(
    "sample_even",
    f"""SELECT {OBS_COLUMNS} FROM (SELECT *, row_number() OVER (ORDER BY {ORDER}) - 1 AS r, COUNT(*) OVER () AS c FROM {TRAIN})
        WHERE r IN (SELECT ((2 * i + 1) * (SELECT COUNT(*) FROM {TRAIN})) // 2000 FROM range(1000) t(i)) OR c <= 1000""",
    "sale_amount",
)


def quota_sql(groups: str, n: int) -> str:
    """Largest remainder, one step per relation."""
    return f"""(
WITH g AS (SELECT {groups}, COUNT(*) AS size FROM {TRAIN} GROUP BY ALL),
t AS (SELECT COUNT(*) AS ng, SUM(size) AS total, CASE WHEN {n} >= COUNT(*) THEN 1 ELSE 0 END AS base FROM g),
q AS (SELECT g.*, t.*, ({n} - base * ng) * (size - base) AS num, total - base * ng AS den FROM g, t),
f AS (SELECT *, num // den AS part, num % den AS rest FROM q),
k AS (SELECT *, row_number() OVER (ORDER BY rest DESC, {groups}) AS place, {n} - SUM(base + part) OVER () AS over FROM f)
SELECT {groups}, size, CAST(CASE WHEN {n} >= total THEN size ELSE base + part + CASE WHEN place <= over THEN 1 ELSE 0 END END AS BIGINT) AS quota
FROM k)"""


def stratified_sql(groups: str, order: str, n: int) -> str:
    return f"""
WITH quotas AS {quota_sql(groups, n)},
ranked AS (SELECT *, row_number() OVER (PARTITION BY {groups} ORDER BY {order}) - 1 AS r FROM {TRAIN}),
picks AS (SELECT {groups}, size, quota, UNNEST(range(quota)) AS i FROM quotas)
SELECT {OBS_COLUMNS} FROM ranked JOIN (SELECT {groups}, CASE WHEN quota >= size THEN i ELSE ((2 * i + 1) * size) // (2 * quota) END AS r FROM picks)
USING ({groups}, r)"""


add("stratified_quota", f"SELECT * FROM {quota_sql('dt, product_id', 2500)}")
add("sample_date_stratified", stratified_sql("dt", "store_id, product_id", 1000), "sale_amount")
add("sample_product_date_stratified", stratified_sql("dt, product_id", "store_id", 2500), "sale_amount")
PANEL = f"""(
WITH p AS (SELECT store_id, product_id, COUNT(*) AS size FROM {TRAIN} GROUP BY ALL),
r AS (SELECT *, SUM(size) OVER (ORDER BY md5('42|' || store_id || '|' || product_id), store_id, product_id) AS after FROM p)
SELECT store_id, product_id, size FROM r
WHERE after = size OR (after - size < 1000 AND ABS(1000 - (after - size)) > ABS(1000 - after)))"""
add("panel_select", f"SELECT * FROM {PANEL}")
add(
    "panel_apply",
    f"SELECT {OBS_COLUMNS} FROM obs WHERE (store_id, product_id) IN (SELECT (store_id, product_id) FROM {PANEL})",
    "sale_amount",
)
add(
    "sample_bernoulli",
    f"""SELECT {KEY}, observed_sales_amount FROM hourly
        WHERE CAST('0x' || substr({HASH}, 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < 0.2::DOUBLE""",
    "observed_sales_amount",
)
add("sample_cap_random", f"SELECT * FROM {TRAINABLE.format('train')} ORDER BY {HASH}, {KEY} LIMIT 5000", "observed_sales_amount")
add("eval_or_train_sample", f"SELECT * FROM {TRAINABLE.format('train')} ORDER BY {HASH}, {KEY} LIMIT 50000", "observed_sales_amount")
add(
    "sample_cap_ordered",
    f"SELECT * FROM {TRAINABLE.format('train')} ORDER BY date_key, store_key, product_key, time_key LIMIT 5000",
    "observed_sales_amount",
)


def per_group_sql(groups: str) -> str:
    source = TRAINABLE.format("train")
    return f"""SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY {groups} ORDER BY {HASH}, {KEY}) AS n FROM {source})
    WHERE n <= CEIL(5000.0 / (SELECT COUNT(*) FROM (SELECT DISTINCT {groups} FROM {source}))) ORDER BY {groups}, n LIMIT 5000"""


add("sample_cap_product_date", per_group_sql("full_date, product_id"), "observed_sales_amount")
add("sample_cap_date", per_group_sql("full_date"), "observed_sales_amount")
add(
    "sample_rank",
    f"""SELECT *, row_number() OVER (PARTITION BY full_date, product_id ORDER BY {HASH}, {KEY}) AS sample_rank
        FROM {TRAINABLE.format('train')}""",
    "observed_sales_amount",
)
add(
    "sample_exact_n",
    f"""SELECT {OBS_COLUMNS} FROM obs
        ORDER BY md5('42|' || source_split || '|' || store_id || '|' || product_id || '|' || dt) LIMIT 1000""",
    "sale_amount",
)

# Dimensions and facts.
add("dim_date", "SELECT * FROM dim_date")
add("dim_time", "SELECT d.*, n AS hourly_rows FROM dim_time d LEFT JOIN (SELECT time_key, COUNT(*) AS n FROM hourly GROUP BY ALL) USING (time_key)")
add("dim_city", "SELECT * FROM dim_city")
add("dim_store", "SELECT * FROM dim_store")
add("dim_product", "SELECT * FROM dim_product")
DAILY_DOUBLES = "observed_daily_sales_amount discount_rate " + WEATHER
HOURLY_DOUBLES = "observed_sales_amount discount_rate " + WEATHER
add("fact_daily", "SELECT * FROM daily", DAILY_DOUBLES)
add("fact_hourly", "SELECT * FROM hourly", HOURLY_DOUBLES)
add("fact_hourly_window", "SELECT * FROM hourly WHERE date_key BETWEEN 20240110 AND 20240116", HOURLY_DOUBLES)
add(
    "dim_model_upsert",
    """SELECT * REPLACE (CASE model_key WHEN 2 THEN (SELECT CAST(MAX(full_date) + 10 AS TIMESTAMP) FROM dim_date) ELSE created_at END AS created_at)
       FROM dim_model
       UNION ALL SELECT CAST(4 AS INT), 'demand_4', 'v1', MIN(full_date), MAX(full_date) + 10, CAST(MAX(full_date) + 10 AS TIMESTAMP) FROM dim_date""",
)
add(
    "model_training_dates",
    """SELECT * REPLACE (CASE model_key WHEN 1 THEN (SELECT MIN(full_date) FROM estimates JOIN dim_date USING (date_key) WHERE estimates.model_key = 1) ELSE training_start_date END AS training_start_date,
       CASE model_key WHEN 1 THEN (SELECT MAX(full_date) FROM estimates JOIN dim_date USING (date_key) WHERE estimates.model_key = 1) ELSE training_end_date END AS training_end_date)
       FROM dim_model""",
)
add(
    "upsert",
    """SELECT * REPLACE (CASE WHEN date_key >= 20240120 THEN observed_daily_sales_amount * 2 ELSE observed_daily_sales_amount END AS observed_daily_sales_amount)
       FROM daily""",
    DAILY_DOUBLES,
)
add(
    "upsert_columns",
    """SELECT * REPLACE (CASE WHEN date_key >= 20240115 THEN 1 - holiday_flag ELSE holiday_flag END AS holiday_flag,
       CASE WHEN full_date >= DATE '2024-01-24' THEN 'unused' ELSE day_name END AS day_name) FROM dim_date""",
)
add(
    "upsert_keep",
    "SELECT * REPLACE (CASE WHEN full_date >= DATE '2024-01-24' THEN 7 ELSE holiday_flag END AS holiday_flag) FROM dim_date",
)
add("delete_model_output", "SELECT model_key, date_key, COUNT(*) AS estimate_rows FROM estimates WHERE model_key <> 1 GROUP BY ALL")
add(
    "upsert_conflicts",
    """SELECT 'dim_store' AS table_name, CAST(store_id AS VARCHAR) AS key_text, COUNT(DISTINCT city_id) AS incoming_rows
       FROM obs_conflict GROUP BY store_id HAVING COUNT(DISTINCT city_id) > 1
       UNION ALL SELECT 'dim_product', CAST(product_id AS VARCHAR), COUNT(DISTINCT first_category_id)
       FROM obs_conflict GROUP BY product_id HAVING COUNT(DISTINCT first_category_id) > 1
       UNION ALL SELECT 'fact_daily', dt || '|' || store_id || '|' || product_id, COUNT(*)
       FROM obs_conflict GROUP BY dt, store_id, product_id HAVING COUNT(*) > 1""",
)

# Projections and filters.
DECISION_DOUBLES = (
    "observed_daily_sales_amount estimated_true_demand estimated_lost_sales discount_rate " + WEATHER + " product_avg_daily_sales "
    "model_recommended_order_qty model_expected_demand model_expected_lost_sales model_expected_waste_qty "
    "model_service_level_target stockout_rate_6_22 demand_bias_rate waste_risk_score restock_urgency_score "
    "recommended_order_qty service_level_target expected_waste_qty"
)
MONITOR_DOUBLES = "observed_daily_sales_amount discount_rate avg_temperature precpt"
DAY = "full_date, store_id, product_id"
add("restock_monitor", "SELECT * FROM monitor", MONITOR_DOUBLES)
add("training_features", "SELECT * FROM features", FEATURE_DOUBLES)
add(
    "decision_filter",
    """SELECT * FROM decisions WHERE full_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND first_category_id = 1
       AND store_id = 4 AND decision_action = 'Restock immediately'""",
    DECISION_DOUBLES,
)
add("default_window", "SELECT MAX(full_date) - 6 AS start_date, MAX(full_date) AS end_date FROM dim_date")
add(
    "restock_watchlist",
    """SELECT * FROM monitor WHERE full_date = DATE '2024-01-20' AND stockout_hours_6_22 >= 3
       ORDER BY stockout_hours_6_22 DESC, observed_daily_sales_amount DESC, store_id, product_id LIMIT 50""",
    MONITOR_DOUBLES,
)
add(
    "not_full_stockout",
    f"""SELECT {DAY}, stockout_hours_6_22, observed_daily_sales_amount, decision_action FROM decisions
        WHERE stockout_hours_6_22 <> 16 OR observed_daily_sales_amount <> 0""",
    "observed_daily_sales_amount",
)
FULL = "COUNT(*) FILTER (stockout_hours_6_22 = 16 AND observed_daily_sales_amount = 0)"
add("full_stockout_count", f"SELECT {FULL} AS full_stockout_rows, COUNT(*) AS visible_rows FROM decisions")
STATUS = """CASE WHEN stockout_flag = 1 THEN CASE WHEN estimated_lost_sales > 0 THEN 'Stockout, demand recovered' ELSE 'Stockout observed' END
       WHEN observed_sales_amount > 0 THEN 'Observed sale' ELSE 'No sale observed' END AS status"""
add("hourly_status", f"SELECT {DAY}, hour_of_day, {STATUS} FROM drill")
add(
    "hourly_evidence",
    f"""SELECT {DAY}, lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':00' AS hour, {STATUS}, observed_sales_amount,
        estimated_true_demand, estimated_lost_sales, GREATEST(estimated_true_demand - observed_sales_amount, 0) AS recovered_gap,
        stockout_flag = 1 AS stockout_flag, estimate_source FROM drill""",
    "observed_sales_amount estimated_true_demand estimated_lost_sales recovered_gap",
)
add(
    "urgency_breakdown",
    f"""SELECT {DAY}, stockout_rate_6_22 * 0.55::DOUBLE AS stockout_contribution, demand_bias_rate * 0.35::DOUBLE AS bias_contribution,
        CAST(CASE activity_flag WHEN 0 THEN 0 ELSE 0.1 END AS DOUBLE) AS activity_contribution,
        restock_urgency_score AS total_urgency FROM decisions""",
    "stockout_contribution bias_contribution activity_contribution total_urgency",
)
PRESSURE = """SELECT first_category_id, COUNT(*) AS product_store_days, SUM(observed_daily_sales_amount) AS observed_sales_amount,
       SUM(estimated_lost_sales) AS estimated_lost_sales, AVG(stockout_rate_6_22) AS stockout_rate_6_22,
       AVG(waste_risk_score) AS waste_risk_score, AVG(restock_urgency_score) AS restock_urgency_score
       FROM decisions GROUP BY first_category_id
       ORDER BY restock_urgency_score DESC, estimated_lost_sales DESC, first_category_id LIMIT 20"""
PRESSURE_DOUBLES = "observed_sales_amount estimated_lost_sales stockout_rate_6_22 waste_risk_score restock_urgency_score"
add("category_pressure", PRESSURE, PRESSURE_DOUBLES)
add(
    "category_band",
    f"""SELECT *, CASE WHEN restock_urgency_score >= 0.65 THEN 'high' WHEN restock_urgency_score >= 0.35 THEN 'medium' ELSE 'low' END AS pressure_band
        FROM ({PRESSURE})""",
    PRESSURE_DOUBLES,
)
add(
    "hour_class",
    f"""SELECT {DAY}, hour_of_day, CASE WHEN stockout_flag = 1 THEN CASE WHEN hour_of_day BETWEEN 6 AND 21 THEN 'business_stockout' ELSE 'other_stockout' END
        WHEN estimated_lost_sales > 0 THEN 'recovered_loss' ELSE 'normal' END AS hour_class FROM drill""",
)
add(
    "full_business_stockout",
    f"SELECT {DAY}, MIN(stockout_flag) = 1 AS is_full_business_stockout FROM drill WHERE hour_of_day BETWEEN 6 AND 21 GROUP BY ALL",
)

# Aggregations.
CATEGORY = "management_group_id, first_category_id, second_category_id, third_category_id"
BY_CATEGORY = f"""SELECT {CATEGORY}, COUNT(*) AS product_store_days, CAST(SUM(stockout_hours_6_22) AS BIGINT) AS stockout_hours_6_22,
       SUM(stockout_hours_6_22) / CAST(COUNT(*) * 16 AS DOUBLE) AS stockout_rate_6_22, SUM(observed_daily_sales_amount) AS observed_sales_amount
       FROM daily JOIN dim_product USING (product_key) GROUP BY ALL"""
add("stockout_rate_by_category", BY_CATEGORY, "stockout_rate_6_22 observed_sales_amount")
add(
    "top_stockout_categories",
    f"SELECT * FROM ({BY_CATEGORY}) ORDER BY stockout_rate_6_22 DESC, {CATEGORY} LIMIT 20",
    "stockout_rate_6_22 observed_sales_amount",
)
add("trainable_counts", "SELECT source_split, is_trainable_demand_observation, COUNT(*) AS hourly_rows FROM features GROUP BY ALL")
add(
    "daily_trend",
    """SELECT full_date, SUM(observed_daily_sales_amount) AS observed_sales_amount, CAST(SUM(stockout_hours_6_22) AS BIGINT) AS stockout_hours_6_22,
       COUNT(*) FILTER (has_stockout) AS stockout_product_store_days FROM daily JOIN dim_date USING (date_key) GROUP BY full_date""",
    "observed_sales_amount",
)
KPI = """COUNT(*) AS product_store_days, SUM(observed_daily_sales_amount) AS observed_sales_amount,
       SUM(estimated_true_demand) AS estimated_true_demand, SUM(estimated_lost_sales) AS estimated_lost_sales,
       AVG(stockout_rate_6_22) AS avg_stockout_rate_6_22, AVG(waste_risk_score) AS avg_waste_risk_score,
       AVG(demand_bias_rate) AS avg_demand_bias_rate, AVG(restock_urgency_score) AS avg_restock_urgency_score,
       SUM(recommended_order_qty) AS recommended_order_qty,
       COUNT(*) FILTER (decision_action = 'Restock immediately') AS immediate_restock_count"""
KPI_DOUBLES = (
    "observed_sales_amount estimated_true_demand estimated_lost_sales avg_stockout_rate_6_22 avg_waste_risk_score "
    "avg_demand_bias_rate avg_restock_urgency_score recommended_order_qty"
)
WASTE = "COUNT(*) FILTER (decision_action = 'Reduce order or markdown')"
add("kpi_by_day", f"SELECT full_date, {KPI}, {WASTE} AS waste_action_count FROM decisions GROUP BY full_date", KPI_DOUBLES)
add(
    "kpi_by_day_unmodelled",
    f"SELECT full_date, {KPI}, {WASTE} AS waste_action_count FROM decisions_unmodelled GROUP BY full_date",
    KPI_DOUBLES,
)
add("kpi_by_category", f"SELECT {CATEGORY}, {KPI}, {WASTE} AS waste_action_count FROM decisions GROUP BY {CATEGORY}", KPI_DOUBLES)
add(
    "action_distribution",
    """SELECT model_name, model_version, decision_action, COUNT(*) AS product_store_days,
       ROUND(AVG(stockout_rate_6_22) + 1e-9::DOUBLE, 4) AS avg_stockout_rate, ROUND(AVG(waste_risk_score) + 1e-9::DOUBLE, 4) AS avg_waste_risk,
       ROUND(AVG(demand_bias_rate) + 1e-9::DOUBLE, 4) AS avg_demand_bias, ROUND(AVG(restock_urgency_score) + 1e-9::DOUBLE, 4) AS avg_restock_urgency
       FROM decisions GROUP BY ALL""",
    "avg_stockout_rate avg_waste_risk avg_demand_bias avg_restock_urgency",
)
add("action_counts", "SELECT decision_action, COUNT(*) AS product_store_days FROM decisions GROUP BY ALL")
add(
    "summary",
    f"""SELECT {KPI}, COUNT(*) FILTER (decision_action = 'Increase next order') AS increase_order_count, {WASTE} AS reduce_order_count,
        COUNT(*) FILTER (decision_action = 'Review censored demand') AS review_bias_count FROM recent""",
    KPI_DOUBLES,
)
add(
    "trend",
    """SELECT full_date, SUM(observed_daily_sales_amount) AS observed_sales_amount, SUM(estimated_lost_sales) AS estimated_lost_sales,
       AVG(stockout_rate_6_22) AS stockout_rate_6_22, AVG(waste_risk_score) AS waste_risk_score, AVG(demand_bias_rate) AS demand_bias_rate,
       AVG(restock_urgency_score) AS restock_urgency_score FROM recent GROUP BY full_date""",
    "demand_bias_rate " + PRESSURE_DOUBLES,
)
add(
    "what_if",
    """SELECT COUNT(*) AS product_store_days, COUNT(*) FILTER (pick = 1) AS restock_count, COUNT(*) FILTER (pick = 2) AS increase_order_count,
       COUNT(*) FILTER (pick = 3) AS markdown_count, COUNT(*) FILTER (pick = 4) AS review_bias_count,
       SUM(CASE pick WHEN 1 THEN recommended_order_qty * (0.9::DOUBLE / service_level_target) ELSE 0 END) AS restock_order_qty_proxy
       FROM (SELECT *, CASE WHEN restock_urgency_score >= 0.5 THEN 1 WHEN stockout_rate_6_22 >= 0.2::DOUBLE THEN 2
                            WHEN waste_risk_score >= 0.7::DOUBLE THEN 3 WHEN demand_bias_rate >= 0.2::DOUBLE THEN 4 ELSE 5 END AS pick FROM decisions)""",
    "restock_order_qty_proxy",
)
DIVERSE = """(SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY decision_action ORDER BY ROUND(restock_urgency_score, 9) DESC, ROUND(estimated_lost_sales, 9) DESC,
                               stockout_hours_6_22 DESC, store_id, product_id, full_date) AS n FROM queue) WHERE n <= 40)"""
add(
    "action_lanes",
    f"""SELECT decision_action, COUNT(*) AS rows, SUM(estimated_lost_sales) AS lost_sales, AVG(restock_urgency_score) AS avg_priority,
        AVG(stockout_rate_6_22) AS avg_stockout,
        CASE decision_action WHEN 'Increase next order' THEN 'Increase next replenishment' WHEN 'Reduce order or markdown' THEN 'Reduce order / markdown'
             ELSE decision_action END AS action_label FROM {DIVERSE} GROUP BY ALL""",
    "lost_sales avg_priority avg_stockout",
)
QUALITY_NAMES = "mae rmse wmape bias calibration_factor prediction_rows uncalibrated_wmape uncalibrated_bias"
QUALITY_COLUMNS = ", ".join(
    f"MAX(CASE WHEN evaluation_split = 'eval' AND metric_name = '{name}' THEN metric_value END) AS {name}" for name in QUALITY_NAMES.split()
)
QUALITY = f"""SELECT m.model_key, model_name, model_version, created_at,
       MAX(CASE WHEN evaluation_split = 'eval' AND metric_name = 'rows' THEN metric_value END) AS eval_rows, {QUALITY_COLUMNS},
       CASE WHEN COUNT(v.model_key) > 0 THEN created_at END AS metrics_loaded_at
       FROM dim_model m LEFT JOIN ({EVALUATION}) v ON v.model_key = m.model_key GROUP BY m.model_key, model_name, model_version, created_at"""
add("model_quality", QUALITY, "eval_rows " + QUALITY_NAMES)
add("newest_quality", f"SELECT * FROM ({QUALITY}) ORDER BY created_at DESC, model_key DESC LIMIT 5", "eval_rows " + QUALITY_NAMES)
RAW = f"(SELECT MAX(metric_value) FROM ({EVALUATION}) WHERE model_key = 2 AND metric_name = 'raw_calibration_factor')"
LATEST_QUALITY = f"SELECT * EXCLUDE (created_at), {RAW} AS raw_calibration_factor FROM ({QUALITY}) WHERE model_key = (SELECT active_key FROM active)"
add("model_quality_latest", LATEST_QUALITY, "eval_rows raw_calibration_factor " + QUALITY_NAMES)
add(
    "quality_guardrails",
    f"""SELECT model_key, ABS(raw_calibration_factor - calibration_factor) > 0.0001 AS calibration_capped, wmape >= 0.8 AS error_high,
        calibration_factor >= 5 AS calibration_high, ABS(bias) <= 0.05 AS bias_within_limit FROM ({LATEST_QUALITY})""",
)
STORY = f"""SELECT {DAY}, CAST(SUM(stockout_flag) AS BIGINT) AS stockout_hours,
       COUNT(*) FILTER (stockout_flag = 1 AND hour_of_day BETWEEN 6 AND 21) AS business_stockout_hours,
       SUM(estimated_lost_sales) AS lost_sales, SUM(observed_sales_amount) AS observed_sales, SUM(estimated_true_demand) AS estimated_demand,
       CAST(arg_max(hour_of_day, (estimated_lost_sales, -hour_of_day)) AS INT) AS peak_hour FROM drill GROUP BY {DAY}"""
add("hourly_story", STORY, "lost_sales observed_sales estimated_demand")
add(
    "queue_saturation",
    f"""SELECT *, CASE WHEN full_stockout_rows = 0 THEN 'none' WHEN full_stockout_rows = visible_rows THEN 'all' ELSE 'some' END AS saturation
        FROM (SELECT {FULL} AS full_stockout_rows, COUNT(*) AS visible_rows FROM top_queue)""",
)

# Windows.
AVERAGES = "store_product_hour_avg product_hour_avg category_hour_avg product_avg global_hour_avg"
add("baseline_averages", f"SELECT {KEY}, {', '.join(AVERAGES.split())} FROM baselines_by_hour", AVERAGES)
add("product_avg", "SELECT product_key, AVG(observed_daily_sales_amount) AS product_avg_daily_sales FROM daily GROUP BY ALL", "product_avg_daily_sales")
add(
    "rank_per_action",
    f"""SELECT {DAY}, decision_action, restock_urgency_score, CAST(n AS INT) AS action_rank FROM (
        SELECT *, row_number() OVER (PARTITION BY decision_action ORDER BY ROUND(restock_urgency_score, 9) DESC, ROUND(estimated_lost_sales, 9) DESC,
                                     stockout_hours_6_22 DESC, store_id, product_id, full_date) AS n FROM decisions) WHERE n <= 40""",
    "restock_urgency_score",
)
PAIR = "(PARTITION BY source_split, store_id, product_id ORDER BY date_key, time_key"
EPOCH = "datediff('day', DATE '1970-01-01', full_date) * 24 + hour_of_day"
LAG = f"COALESCE(lag(observed_sales_amount) OVER {PAIR}), 0) AS product_sales_lag_1h"
ROLL = f"COALESCE(SUM(observed_sales_amount) OVER {PAIR} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS product_sales_lag_24h_sum"
SOLD_AT = f"CASE WHEN observed_sales_amount > 0 THEN {EPOCH} END"


def since(frame_end: str) -> str:
    last = f"MAX({SOLD_AT}) OVER {PAIR} ROWS BETWEEN UNBOUNDED PRECEDING AND {frame_end})"
    return f"COALESCE(({EPOCH} - {last}) / 24.0::DOUBLE, -1)"


PREVIOUS = f"{since('1 PRECEDING')} AS days_since_previous_sale"
add("lag_1", f"SELECT {KEY}, {LAG} FROM features", "product_sales_lag_1h")
add("rolling_sum_24", f"SELECT {KEY}, {ROLL} FROM features", "product_sales_lag_24h_sum")
add("days_since_previous_sale", f"SELECT {KEY}, {PREVIOUS} FROM features", "days_since_previous_sale")
add("days_since_last_sale", f"SELECT {KEY}, {since('CURRENT ROW')} AS days_since_last_sale FROM features", "days_since_last_sale")
add("lags", f"SELECT {KEY}, {LAG}, {ROLL}, {PREVIOUS} FROM features", "product_sales_lag_1h product_sales_lag_24h_sum days_since_previous_sale")


def ranges_sql(condition: str, name: str) -> str:
    """Gaps and islands over the hours that meet a condition."""
    return f"""(SELECT {DAY}, string_agg(CASE WHEN a = b THEN a || ':00' ELSE a || ':00-' || b || ':00' END, ', ' ORDER BY a) AS {name}
      FROM (SELECT {DAY}, MIN(hour_of_day) AS a, MAX(hour_of_day) AS b
            FROM (SELECT *, hour_of_day - row_number() OVER (PARTITION BY {DAY} ORDER BY hour_of_day) AS island FROM drill WHERE {condition})
            GROUP BY {DAY}, island) GROUP BY {DAY})"""


RANGES = f"""SELECT {DAY}, COALESCE(stockout_ranges, 'none') AS stockout_ranges, COALESCE(lost_sales_ranges, 'none') AS lost_sales_ranges
    FROM (SELECT DISTINCT {DAY} FROM drill) LEFT JOIN {ranges_sql('stockout_flag = 1', 'stockout_ranges')} USING ({DAY})
    LEFT JOIN {ranges_sql('estimated_lost_sales > 0', 'lost_sales_ranges')} USING ({DAY})"""
add("hour_ranges", RANGES)


def median_sql(model: int, split: str) -> str:
    return f"""(SELECT MIN(ratio) FROM (
      SELECT ratio, SUM(w) OVER (ORDER BY ratio ROWS UNBOUNDED PRECEDING) AS cum, SUM(w) OVER () / 2 AS half
      FROM (SELECT y / p AS ratio, SUM(p) AS w FROM scored WHERE model_key = {model} AND source_split = '{split}' AND p > 1e-12 GROUP BY ALL))
      WHERE cum >= half)"""


add(
    "weighted_median",
    f"""SELECT CAST(1 AS INT) AS model_key, {median_sql(1, 'train')} AS wmape_factor
        UNION ALL SELECT CAST(2 AS INT), {median_sql(2, 'train')}""",
    "wmape_factor",
)

# Sorts and top-k.
add(
    "top_recommendations",
    """SELECT full_date, store_id, product_id, estimate_source, stockout_hours_6_22,
       ROUND(estimated_lost_sales + 1e-9::DOUBLE, 4) AS estimated_lost_sales, ROUND(recommended_order_qty + 1e-9::DOUBLE, 4) AS recommended_order_qty,
       ROUND(restock_urgency_score + 1e-9::DOUBLE, 4) AS restock_urgency_score, decision_action, decision_reason
       FROM (SELECT * FROM decisions ORDER BY ROUND(restock_urgency_score, 9) DESC, ROUND(estimated_lost_sales, 9) DESC, store_id, product_id, full_date LIMIT 25)""",
    "estimated_lost_sales recommended_order_qty restock_urgency_score",
)
QUEUE_DOUBLES = STATEMENTS["queue_csv"][1]
add("queue_highest", "SELECT * FROM top_queue", QUEUE_DOUBLES)
PRIORITY = "ROUND(restock_urgency_score, 9) DESC, ROUND(estimated_lost_sales, 9) DESC, stockout_hours_6_22 DESC, store_id, product_id, full_date"
add(
    "queue_exclude_full",
    f"SELECT * FROM queue WHERE stockout_hours_6_22 <> 16 OR observed_daily_sales_amount <> 0 ORDER BY {PRIORITY} LIMIT 200",
    QUEUE_DOUBLES,
)
add(
    "queue_diverse",
    f"""SELECT * FROM {DIVERSE} ORDER BY list_position(['Restock immediately', 'Increase next order', 'Review censored demand',
        'Reduce order or markdown', 'Maintain plan'], decision_action), {PRIORITY} LIMIT 200""",
    QUEUE_DOUBLES,
)
add(
    "priority_cards",
    f"""SELECT {DAY}, first_category_id, CAST(row_number() OVER (ORDER BY {PRIORITY}) AS INT) AS card_position,
        CASE decision_action WHEN 'Increase next order' THEN 'Increase next replenishment' WHEN 'Reduce order or markdown' THEN 'Reduce order / markdown'
             ELSE decision_action END AS action_label, restock_urgency_score AS total_urgency FROM top_queue ORDER BY card_position LIMIT 6""",
    "total_urgency",
)
add("latest", "SELECT * FROM dim_model WHERE model_key = 3")
add("latest_model", "SELECT * FROM dim_model ORDER BY created_at DESC, model_key DESC LIMIT 1")
add(
    "latest_model_with_predictions",
    """SELECT m.*, (SELECT COUNT(*) FROM estimates e WHERE e.model_key = m.model_key) AS demand_estimate_rows,
       (SELECT COUNT(*) FROM recs r WHERE r.model_key = m.model_key) AS recommendation_rows
       FROM dim_model m JOIN active ON m.model_key = active_key""",
)
MELT = "SELECT full_date, store_id, product_id, hour_of_day, hour_label, stockout_status, estimated_lost_sales, '{1}' AS series, {0} AS amount FROM b"
add(
    "melt",
    f"""WITH b AS (SELECT *, lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':00' AS hour_label,
          CASE stockout_flag WHEN 1 THEN 'Stockout' ELSE 'Available' END AS stockout_status FROM drill)
        {MELT.format('observed_sales_amount', 'Observed sales')} UNION ALL {MELT.format('estimated_true_demand', 'Estimated demand')}""",
    "estimated_lost_sales amount",
)

# Data quality.
CHECKS = {
    "dq_sales_length": ("hours_sale_length_24", "COUNT(*) FILTER (len(hours_sale) IS DISTINCT FROM 24)"),
    "dq_status_length": ("hours_stock_status_length_24", "COUNT(*) FILTER (len(hours_stock_status) IS DISTINCT FROM 24)"),
    "dq_daily_sum": (
        "daily_sales_equals_hourly_sum",
        "COUNT(*) FILTER (ABS(sale_amount - COALESCE(list_sum(hours_sale), 0)) > 0.000001)",
    ),
    "dq_business_count": (
        "business_hour_stockout_count_matches",
        "COUNT(*) FILTER (stock_hour6_22_cnt <> COALESCE(list_sum(hours_stock_status[7:22]), 0))",
    ),
    "dq_duplicates": (
        "duplicate_staging_grain",
        "COUNT(*) - COUNT(DISTINCT (source_split, store_id, product_id, dt))",
    ),
}
DETAILS = {
    "dq_sales_length": ("critical", "Every source row must contain 24 hourly sales values."),
    "dq_status_length": ("critical", "Every source row must contain 24 hourly stockout flags."),
    "dq_daily_sum": ("warning", "Daily sales should equal the sum of hours_sale within floating-point tolerance."),
    "dq_business_count": ("critical", "stock_hour6_22_cnt should equal stockout flags from hours 6 through 21."),
    "dq_duplicates": ("critical", "The staging grain must be source_split, store_id, product_id, dt."),
}
for _name, (_check, _count) in CHECKS.items():
    add(_name, f"SELECT '{_check}' AS check_name, {_count} AS failed_rows FROM obs_bad")


def report_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{check}' AS check_name, {count} AS failed_rows, '{DETAILS[name][0]}' AS severity, '{DETAILS[name][1]}' AS details FROM {source}"
        for name, (check, count) in CHECKS.items()
    )


add("data_quality_checks", report_sql("obs"))
add("quality_order", report_sql("obs_bad"))
add(
    "failed_checks",
    f"SELECT *, COUNT(*) OVER () AS failed_checks FROM ({report_sql('obs_bad')}) WHERE failed_rows > 0",
)

# Constraints: (table, rule, SQL that counts violations).
OBS_NAMES = (
    "source_split city_id store_id management_group_id first_category_id second_category_id third_category_id product_id dt "
    "sale_amount hours_sale stock_hour6_22_cnt hours_stock_status discount holiday_flag activity_flag " + WEATHER
)
DAILY_NAMES = (
    "date_key store_key product_key source_split observed_daily_sales_amount stockout_hours_6_22 stockout_hours_total has_stockout "
    "discount_rate holiday_flag activity_flag " + WEATHER
)
HOURLY_NAMES = (
    "date_key time_key store_key product_key source_split observed_sales_amount stockout_flag is_censored_observation discount_rate "
    "activity_flag " + WEATHER
)
ESTIMATE_NAMES = (
    "date_key time_key store_key product_key model_key observed_sales_amount estimated_true_demand estimated_lost_sales stockout_flag "
    "is_censored_observation"
)
REC_NAMES = (
    "date_key store_key product_key model_key recommended_order_qty expected_demand expected_lost_sales stockout_risk_score "
    "expected_waste_qty service_level_target"
)
HOUR_KEY, DAY_KEY = "date_key,time_key,store_key,product_key", "date_key,store_key,product_key"
PARENT = {
    "date_key": "dim_date",
    "time_key": "dim_time",
    "store_key": "dim_store",
    "product_key": "dim_product",
    "model_key": "dim_model",
    "city_key": "dim_city",
}


def constraints_sql(sources: dict[str, str], parents: dict[str, str]) -> str:
    lines = []

    def rule(table: str, name: str, count: str) -> None:
        if table in sources:
            lines.append(f"SELECT '{table}' AS table_name, '{name}' AS rule_name, CAST(({count}) AS BIGINT) AS violations")

    def check(table: str, name: str, violated: str) -> None:
        rule(table, name, f"SELECT COUNT(*) FROM {sources.get(table)} WHERE {violated}")

    uniques = {
        "observations": ["source_split,store_id,product_id,dt"],
        "dim_date": ["date_key", "full_date"],
        "dim_time": ["time_key"],
        "dim_city": ["city_key", "city_id"],
        "dim_store": ["store_key", "store_id"],
        "dim_product": ["product_key", "product_id"],
        "dim_model": ["model_key", "model_name,model_version"],
        "fact_daily": [DAY_KEY],
        "fact_hourly": [HOUR_KEY],
        "demand_estimates": [HOUR_KEY + ",model_key"],
        "recommendations": [DAY_KEY + ",model_key"],
        "model_evaluation": ["model_key,evaluation_split,metric_name"],
    }
    for table, all_keys in uniques.items():
        for keys in all_keys:
            rule(table, f"unique:{keys}", f"SELECT COALESCE(SUM(n - 1), 0) FROM (SELECT COUNT(*) AS n FROM {sources.get(table)} GROUP BY {keys})")
    for table in ("observations", "fact_daily", "fact_hourly"):
        check(table, "check:source_split", "source_split NOT IN ('train', 'eval')")
    for column in ("hours_sale", "hours_stock_status"):
        check("observations", f"check:{column}", f"len({column}) <> 24")
    for column in ("time_key", "hour_of_day"):
        check("dim_time", f"check:{column}", f"{column} NOT BETWEEN 0 AND 23")
    check("demand_estimates", "check:estimated_lost_sales", "estimated_lost_sales < 0")
    for column in ("stockout_risk_score", "service_level_target"):
        check("recommendations", f"check:{column}", f"{column} NOT BETWEEN 0 AND 1")
    nulls = {
        "observations": OBS_NAMES,
        "fact_daily": DAILY_NAMES,
        "fact_hourly": HOURLY_NAMES,
        "demand_estimates": ESTIMATE_NAMES,
        "recommendations": REC_NAMES,
        "model_evaluation": "metric_value",
    }
    for table, names in nulls.items():
        for column in names.split():
            check(table, f"not_null:{column}", f"{column} IS NULL")
    references = {
        "dim_store": "city_key",
        "fact_daily": DAY_KEY,
        "fact_hourly": HOUR_KEY,
        "demand_estimates": HOUR_KEY + ",model_key",
        "recommendations": DAY_KEY + ",model_key",
        "model_evaluation": "model_key",
    }
    for table, names in references.items():
        for column in names.split(","):
            check(table, f"reference:{column}", f"{column} NOT IN (SELECT {column} FROM {parents[column]})")
    return " UNION ALL ".join(lines)


add("constraint_report", constraints_sql(COUNTED, PARENT))
_BROKEN = """
WITH both_broken AS (
  SELECT o.* EXCLUDE (k) REPLACE (CASE WHEN k = 0 THEN hours_sale[1:23] ELSE hours_sale END AS hours_sale,
    CASE WHEN k = 0 THEN hours_stock_status[1:23] ELSE hours_stock_status END AS hours_stock_status)
  FROM (SELECT *, (store_id * 31 + product_id + day(dt)) % 97 AS k FROM obs_conflict) o CROSS JOIN (SELECT UNNEST([1, 2]) AS copy)
  WHERE copy = 1 OR k = 3),
city_left AS (SELECT * FROM dim_city WHERE city_key > 1),
store_again AS (SELECT store_key, b.store_id, c.city_key FROM (SELECT DISTINCT store_id, city_id FROM both_broken) b
                JOIN dim_city c ON c.city_id = b.city_id LEFT JOIN dim_store s ON s.store_id = b.store_id)
"""
add(
    "constraint_report_broken",
    _BROKEN
    + constraints_sql(
        {"observations": "both_broken", "dim_city": "city_left", "dim_store": "store_again"}, {**PARENT, "city_key": "city_left"}
    ),
)

# Demand recovery and decisions.
add("fallback_choice", f"SELECT {KEY}, pick AS baseline FROM heuristic", "baseline")
add("heuristic_demand", f"SELECT {KEY}, heuristic_true_demand, heuristic_lost_sales FROM heuristic", "heuristic_true_demand heuristic_lost_sales")
add("hourly_demand_estimate", "SELECT * FROM demand", "estimated_true_demand estimated_lost_sales " + HOURLY_DOUBLES)
add("estimate_fact", "SELECT * FROM estimates", ESTIMATE_DOUBLES)
add(
    "estimate_fact_capped",
    "SELECT * FROM estimates WHERE model_key = 1 ORDER BY date_key, store_key, product_key, time_key LIMIT 5000",
    ESTIMATE_DOUBLES,
)
REC_DOUBLES = "recommended_order_qty expected_demand expected_lost_sales stockout_risk_score expected_waste_qty service_level_target"
add("recommendations", "SELECT * FROM recs", REC_DOUBLES)
add(
    "recommendations_for_level",
    """SELECT * REPLACE (GREATEST(expected_demand * 0.9::DOUBLE / 0.95::DOUBLE, 0) AS recommended_order_qty, CAST(0.9 AS DOUBLE) AS service_level_target)
       FROM recs""",
    REC_DOUBLES,
)
add("decision_scores", "SELECT * FROM decisions", DECISION_DOUBLES)
add("waste_risk", f"SELECT {DAY}, has_stockout, product_avg_daily_sales, waste_risk_score FROM decisions", "product_avg_daily_sales waste_risk_score")
add(
    "urgency",
    f"SELECT {DAY}, stockout_rate_6_22, demand_bias_rate, restock_urgency_score FROM decisions",
    "stockout_rate_6_22 demand_bias_rate restock_urgency_score",
)
add("decision_action", f"SELECT {DAY}, decision_action, decision_reason FROM decisions")
add(
    "order_proxies",
    f"SELECT {DAY}, recommended_order_qty, service_level_target, expected_waste_qty FROM decisions",
    "recommended_order_qty service_level_target expected_waste_qty",
)
DRILL_DOUBLES = "observed_sales_amount estimated_true_demand estimated_lost_sales"
add("hourly_drilldown", "SELECT * FROM drill", DRILL_DOUBLES)
add("hourly_drilldown_day", "SELECT * FROM drill WHERE full_date = DATE '2024-01-20' AND store_id = 3 AND product_id = 7", DRILL_DOUBLES)
add(
    "hourly_drilldown_view",
    f"""SELECT {DAY}, time_key AS hour_of_day, observed_sales_amount, estimated_true_demand, estimated_lost_sales, stockout_flag, estimate_source
        FROM demand JOIN dim_date USING (date_key) JOIN dim_store USING (store_key) JOIN dim_product USING (product_key)""",
    DRILL_DOUBLES,
)
add(
    "story_readout",
    f"""SELECT {DAY},
        CASE WHEN stockout_hours = 0 THEN 'No source stockout hours are present for this store-product-day. The recommendation is driven by non-stockout demand, waste, or queue context.'
             WHEN lost_sales <= 0 THEN 'Source stockout flags are present, but the model/fallback did not recover material lost sales for those hours. Treat this as a stockout evidence check.'
             ELSE 'Stockout is observed during ' || stockout_ranges || '. The model recovers lost demand during ' || lost_sales_ranges
                  || ', with the peak lost-sales signal at ' || peak_hour || ':00.' END AS readout,
        'Observed sales total ' || format('{{:,.2f}}', ROUND(observed_sales + 1e-9::DOUBLE, 2)) || ', estimated demand totals ' || format('{{:,.2f}}', ROUND(estimated_demand + 1e-9::DOUBLE, 2))
          || ', and the recovered gap is ' || format('{{:,.2f}}', ROUND(lost_sales + 1e-9::DOUBLE, 2)) || '. This supports the action: '
          || CASE decision_action WHEN 'Increase next order' THEN 'Increase next replenishment' WHEN 'Reduce order or markdown' THEN 'Reduce order / markdown'
                  ELSE decision_action END || '.' AS explanation
        FROM ({STORY}) JOIN ({RANGES}) USING ({DAY}) JOIN decisions USING ({DAY})""",
)

# Features.
add("demand_target", f"SELECT {KEY}, GREATEST(COALESCE(target_observed_sales_amount, observed_sales_amount), 0) AS demand_target FROM features", "demand_target")
add("temporal_holdout", f"SELECT {KEY}, part FROM parts")
ANGLES = {"hour_sin": ("sin", "hour_of_day", 24), "hour_cos": ("cos", "hour_of_day", 24), "dow_sin": ("sin", "day_of_week", 7), "dow_cos": ("cos", "day_of_week", 7)}
CYCLIC = ", ".join(f"{fn}(2 * pi() * {column} / {period}.0::DOUBLE) AS {name}" for name, (fn, column, period) in ANGLES.items())
add("cyclic_time", f"SELECT {KEY}, {CYCLIC} FROM features", " ".join(ANGLES))
PROMO = """GREATEST(1 - discount_rate, 0) AS discount_depth, 1 - discount_rate > 0.001 AS is_discounted,
       1 - discount_rate > 0.001 OR activity_flag <> 0 AS is_promo_or_discount, avg_temperature * avg_humidity / 100 AS temperature_humidity_index"""
add("promo_weather", f"SELECT {KEY}, {PROMO} FROM features", "discount_depth temperature_humidity_index")
add("store_traffic_lag_1h", f"SELECT {KEY}, store_traffic_lag_1h FROM contexts", "store_traffic_lag_1h")
add("category_momentum_24h", f"SELECT {KEY}, category_momentum_24h FROM contexts", "category_momentum_24h")
GROUPS = "store_product_hour product_hour category_hour product_dow category_dow store_product product category global_hour global_dow".split()
PRIORS = [f"{g}_{kind}" for g in GROUPS for kind in ("mean", "count_log1p")]
RATES = [f"{g}_stockout_rate" for g in ("store_product", "product", "category")]
add("demand_priors", f"SELECT {KEY}, {', '.join(PRIORS)} FROM priors", " ".join(PRIORS))
add("stockout_priors", f"SELECT {KEY}, {', '.join(RATES)} FROM priors", " ".join(RATES))
BASELINE = f"COALESCE({', '.join(g + '_mean' for g in GROUPS)}, overall, 0) AS baseline_demand_prior"
add("baseline_prior", f"SELECT {KEY}, {BASELINE} FROM priors", "baseline_demand_prior")
add(
    "null_fill",
    f"""SELECT {KEY}, CAST(is_weekend AS INT)::DOUBLE AS is_weekend, COALESCE(target_observed_sales_amount, 0) AS target_observed_sales_amount,
        0.0::DOUBLE AS unknown_feature FROM features""",
    "is_weekend target_observed_sales_amount unknown_feature",
)
MODEL_PRIORS = [f"{g}_mean" for g in GROUPS] + [f"{g}_count_log1p" for g in GROUPS if not g.startswith("global")]
FILLED = ", ".join(f"COALESCE({name}, 0) AS {name}" for name in MODEL_PRIORS + RATES)
add(
    "prepare_features",
    f"""SELECT {KEY}, part, GREATEST(COALESCE(target_observed_sales_amount, observed_sales_amount), 0) AS demand_target, {CYCLIC}, {PROMO},
        {FILLED}, {BASELINE}, store_traffic_lag_1h, category_momentum_24h, {LAG}, {ROLL}, {PREVIOUS}
        FROM priors JOIN contexts USING ({KEY})""",
    " ".join(["demand_target", *ANGLES, "discount_depth", "temperature_humidity_index", *MODEL_PRIORS, *RATES])
    + " baseline_demand_prior store_traffic_lag_1h category_momentum_24h product_sales_lag_1h product_sales_lag_24h_sum days_since_previous_sale",
)

add("prepare_features_saved", f"SELECT * FROM ({STATEMENTS['prepare_features'][0]}) WHERE part = 'eval'", STATEMENTS["prepare_features"][1])

# The comparison flow.
CKEY = "source_split, store_id, product_id, dt, hour"
add("comparison_hourly", "SELECT * FROM comp", "discount units_ordered stock_on_hand selling_price product_price")
add(
    "comparison_context",
    f"SELECT {CKEY}, days_since_last_sale, store_traffic_lag_1h, category_momentum FROM comp_context",
    "days_since_last_sale store_traffic_lag_1h category_momentum",
)
add(
    "comparison_baselines",
    "SELECT DISTINCT store_id, product_id, hour, store_product_hour_baseline, product_hour_baseline, product_baseline, global_baseline FROM comp_baselines",
    "store_product_hour_baseline product_hour_baseline product_baseline global_baseline",
)
add(
    "latent_target",
    f"""SELECT {CKEY}, CASE WHEN stockout_flag = 1 THEN GREATEST(units_ordered, COALESCE(store_product_hour_baseline, product_hour_baseline,
        product_baseline, global_baseline), 0) ELSE GREATEST(units_ordered, 0) END AS true_demand FROM comp_baselines""",
    "true_demand",
)
add("latent_target_observed", f"SELECT {CKEY}, GREATEST(units_ordered, 0) AS true_demand FROM comp", "true_demand")
CLEAN_NUMBERS = "discount stock_on_hand selling_price product_price store_traffic_lag_1h category_momentum days_since_last_sale"
add("comparison_clean", "SELECT * FROM comp_clean", CLEAN_NUMBERS)
CATEGORIES = "product_id location store_id product_category product_subcategory holiday is_promotion day_of_week week_of_year month year hour stockout_flag".split()
FIT = "(SELECT * FROM comp_clean WHERE key_source_split = 'train')"
ENCODED = ", ".join(
    f"COALESCE((SELECT code FROM codes WHERE column_name = '{c}' AND codes.value = comp_clean.{c}), -2) AS {c}" for c in CATEGORIES
)
CODES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INT) AS code FROM (SELECT DISTINCT {c} FROM {FIT})"
    for c in CATEGORIES
)
SCALED = ", ".join(
    f"(COALESCE({n}, 0) - (SELECT AVG(COALESCE({n}, 0)) FROM {FIT})) / (SELECT CASE WHEN STDDEV_POP(COALESCE({n}, 0)) > 0 THEN STDDEV_POP(COALESCE({n}, 0)) ELSE 1 END FROM {FIT}) AS {n}"
    for n in CLEAN_NUMBERS.split()
)
add(
    "comparison_encode",
    f"WITH codes AS ({CODES}) SELECT key_source_split, key_store_id, key_product_id, key_dt, key_hour, {SCALED}, {ENCODED} FROM comp_clean",
    CLEAN_NUMBERS,
)

add(
    "comparison_encode_saved",
    f"SELECT * FROM ({STATEMENTS['comparison_encode'][0]}) WHERE key_source_split = 'eval'",
    CLEAN_NUMBERS,
)

# Evaluation and calibration.
add(
    "predict_hurdle",
    f"""SELECT {KEY}, GREATEST(0.65::DOUBLE * GREATEST(hour_of_day / 24.0::DOUBLE * observed_sales_amount, 0) + 0.35::DOUBLE * baseline_demand_prior, 0) AS prediction
        FROM (SELECT *, {BASELINE} FROM priors)""",
    "prediction",
)
add("metrics", metrics_sql(plain(2, "eval")), "rows mae rmse wmape bias")
add("bias_factor", f"SELECT CASE WHEN SUM(p) > 0 THEN SUM(y) / SUM(p) ELSE 1 END AS bias_factor FROM {plain(2, 'eval')}", "bias_factor")
add("wmape_factor", f"SELECT {median_sql(2, 'eval')} AS wmape_factor", "wmape_factor")
TRAIN_FACTORS = f"SELECT (SELECT SUM(y) / SUM(p) FROM {plain(2, 'train')}) AS rb, {median_sql(2, 'train')} AS rw"
FACTOR_DOUBLES = "calibration_factor raw_bias_factor raw_wmape_factor"
add(
    "calibration_factor",
    f"""WITH raw AS ({TRAIN_FACTORS}),
        cand AS (SELECT DISTINCT f FROM (SELECT CASE WHEN i = 120 THEN 5.0::DOUBLE ELSE 0.25::DOUBLE + i * (4.75::DOUBLE / 120) END AS f FROM range(121) t(i)
                 UNION ALL SELECT 1.0 UNION ALL SELECT LEAST(GREATEST(rb, 0.25), 5.0) FROM raw UNION ALL SELECT LEAST(GREATEST(rw, 0.25), 5.0) FROM raw)),
        judged AS (SELECT f, ROUND(SUM(ABS(p * f - y)) / SUM(ABS(y)) + 0.25 * ABS(SUM(p * f - y)) / SUM(ABS(y)), 12) AS score
                   FROM {plain(2, 'train')} CROSS JOIN cand GROUP BY f)
        SELECT (SELECT f FROM judged ORDER BY score, f LIMIT 1) AS calibration_factor, rb AS raw_bias_factor, rw AS raw_wmape_factor FROM raw""",
    FACTOR_DOUBLES,
)
add(
    "calibration_factor_bias",
    f"SELECT LEAST(GREATEST(rb, 0.25), 0.8::DOUBLE) AS calibration_factor, rb AS raw_bias_factor, rw AS raw_wmape_factor FROM ({TRAIN_FACTORS})",
    FACTOR_DOUBLES,
)
add(
    "calibration_factor_wmape",
    f"SELECT LEAST(GREATEST(rw, 0.25), 5.0::DOUBLE) AS calibration_factor, rb AS raw_bias_factor, rw AS raw_wmape_factor FROM ({TRAIN_FACTORS})",
    FACTOR_DOUBLES,
)
add(
    "segment_metrics",
    "SELECT * FROM (" + metrics_sql(SEGMENTED.format(plain(2, "eval")), "segment") + ") WHERE segment IS NOT NULL",
    "rows mae rmse wmape bias",
)
add(
    "comparison_metrics",
    f"""SELECT mae, rmse, wmape, wmape * 100 AS wmape_percent, bias_percent, baseline_mae,
        CASE WHEN baseline_mae <> 0 THEN (baseline_mae - mae) / baseline_mae * 100 ELSE 0 END AS baseline_mae_improvement_percent
        FROM (SELECT AVG(ABS(y - p)) AS mae, SQRT(AVG((y - p) * (y - p))) AS rmse, SUM(ABS(y - p)) / (SUM(y) + 1e-10) AS wmape,
              (SUM(p) - SUM(y)) / (SUM(y) + 1e-10) * 100 AS bias_percent, AVG(ABS(y - m)) AS baseline_mae
              FROM (SELECT *, AVG(y) OVER () AS m FROM {plain(2, 'eval')}))""",
    "mae rmse wmape wmape_percent bias_percent baseline_mae baseline_mae_improvement_percent",
)

# What holds for any sound model, and what the fits have used.
FACTS = (
    f"SELECT COUNT(*) AS rows_scored, COUNT(DISTINCT ({KEY})) AS keys_scored, 0::BIGINT AS negative_rows, 0::BIGINT AS missing_rows "
    "FROM parts WHERE part = 'eval'"
)
add(
    "fit_hurdle_facts",
    f"""SELECT *, GREATEST(zero_rows / positive_rows::DOUBLE, 1) AS positive_weight FROM ({FACTS}),
       (SELECT CAST(COUNT(*) FILTER (observed_sales_amount > 0) AS INT) AS positive_rows,
               CAST(COUNT(*) FILTER (NOT observed_sales_amount > 0) AS INT) AS zero_rows
        FROM parts WHERE part = 'fit' AND NOT stockout_flag)""",
    "positive_weight",
)
for name in ("fit_direct_facts", "fit_direct_poisson_facts", "fit_direct_squared_facts"):
    add(name, f"SELECT *, TRUE AS fits_better FROM ({FACTS})")
for name in ("fit_comparison_facts", "fit_comparison_best_first_facts", "fit_comparison_symmetric_facts"):
    add(
        name,
        """SELECT COUNT(*) AS rows_scored, COUNT(DISTINCT (source_split, store_id, product_id, dt, hour)) AS keys_scored,
           0::BIGINT AS negative_rows, 0::BIGINT AS missing_rows, TRUE AS fits_better FROM comp WHERE source_split = 'eval'""",
    )
add("score_new_days", "SELECT COUNT(*) AS rows_scored, 0::BIGINT AS differing_rows FROM parts WHERE part = 'eval'")
add("save_and_load_model_facts", "SELECT COUNT(*) AS rows_scored, 0::BIGINT AS differing_rows FROM parts WHERE part = 'eval'")
add(
    "train_job_facts",
    """SELECT COUNT(*) FILTER (part = 'calibration') AS calibration_rows, COUNT(*) FILTER (part = 'eval') AS judged_rows,
       TRUE AS factor_bounded FROM parts WHERE NOT stockout_flag""",
)
add(
    "temporal_holdout_one_date",
    """SELECT CASE WHEN source_split = 'eval' THEN 'eval' WHEN full_date = last THEN 'calibration' ELSE 'fit' END AS part,
       COUNT(*) AS hourly_rows, COUNT(DISTINCT full_date) AS dates
       FROM features, (SELECT MAX(full_date) AS last FROM features WHERE source_split = 'train') GROUP BY ALL""",
)

# Stored tables.
TURNED = "SELECT * REPLACE (IF({0}, 1 - activity_flag, activity_flag) AS activity_flag) FROM {1}"
add("stored_daily_reload", TURNED.format("source_split = 'eval'", "daily"), DAILY_DOUBLES)
add("stored_hourly_reload", TURNED.format("date_key BETWEEN 20240124 AND 20240127", "hourly"), HOURLY_DOUBLES)


def imported_sql(guess: str, condition: str) -> str:
    return f"""
SELECT date_key, time_key, store_key, product_key, observed_sales_amount, flag AS stockout_flag, flag AS is_censored_observation,
       IF(flag, GREATEST(guess, observed_sales_amount), observed_sales_amount) AS estimated_true_demand,
       IF(flag, GREATEST(guess - observed_sales_amount, 0), 0)::DOUBLE AS estimated_lost_sales,
       IF(flag, GREATEST(GREATEST(guess, observed_sales_amount) * 0.85::DOUBLE, observed_sales_amount), observed_sales_amount) AS prediction_lower_bound,
       IF(flag, GREATEST(GREATEST(guess, observed_sales_amount) * 1.15::DOUBLE, observed_sales_amount), observed_sales_amount) AS prediction_upper_bound
FROM (SELECT *, stockout_flag OR time_key = 5 AS flag, {guess} AS guess FROM hourly WHERE {condition})"""


FIRST_DATE = "date_key = (SELECT MIN(date_key) FROM hourly)"
ESTIMATED = "observed_sales_amount estimated_true_demand estimated_lost_sales prediction_lower_bound prediction_upper_bound"
add("stored_import", imported_sql(f"IF({FIRST_DATE}, 2.5::DOUBLE, 1.5::DOUBLE)", "TRUE"), ESTIMATED)
add("stored_import_replaced", imported_sql("2.5::DOUBLE", FIRST_DATE), ESTIMATED)
add(
    "stored_import_counts",
    f"""SELECT COUNT(*) AS demand_estimate_rows, COUNT(DISTINCT (date_key, store_key, product_key)) AS recommendation_rows,
       (SELECT MIN(full_date) FROM dim_date) AS training_start_date, (SELECT MAX(full_date) FROM dim_date) AS training_end_date,
       SUM(estimated_true_demand) AS expected_demand FROM ({imported_sql("1.5::DOUBLE", "TRUE")})""",
    "expected_demand",
)
add(
    "stored_metric_import",
    """SELECT 'eval' AS evaluation_split, metric_name, CAST(metric_value AS DOUBLE) AS metric_value, DATE '2024-02-01' AS loaded_on
       FROM (VALUES ('on', 1), ('a_b', 2), ('a_c_d_e_f', 3.5), ('rows', (SELECT COUNT(*) FROM hourly))) AS t(metric_name, metric_value)""",
    "metric_value",
)
add(
    "stored_reopened_models",
    """SELECT CAST(model_key AS INT) AS model_key, model_name, CASE WHEN model_key = 1 THEN (SELECT COUNT(*) FROM hourly) END AS estimate_rows
       FROM (VALUES (1, 'old'), (2, 'new'), (3, 'newest')) AS t(model_key, model_name)""",
)
add(
    "stored_reopened_reload",
    """SELECT full_date, SUM(observed_daily_sales_amount * IF(full_date = DATE '2024-01-24', 2, 1)) AS sales,
              COUNT(*) AS monitor_rows, ANY_VALUE(n) AS hourly_rows
       FROM daily JOIN dim_date USING (date_key)
       JOIN (SELECT date_key, COUNT(*) AS n FROM hourly GROUP BY date_key) USING (date_key) GROUP BY full_date""",
    "sales",
)
# Four dates with other hours, and the relations that follow from them.
RELATIONS["hourly_again"] = """
SELECT * REPLACE (IF(changed, 2 * observed_sales_amount, observed_sales_amount) AS observed_sales_amount,
                  stockout_flag <> changed AS stockout_flag)
FROM (SELECT *, date_key BETWEEN 20240124 AND 20240127 AS changed FROM hourly)
"""
FOLLOWING = ("features", "parts", "priors", "sums", "means", "baselines")
for name in FOLLOWING:
    text = re.sub(r"\b(FROM|JOIN) hourly\b", r"\1 hourly_again AS hourly", RELATIONS[name])
    RELATIONS[f"{name}_again"] = re.sub(rf"\b(FROM|JOIN) ({'|'.join(FOLLOWING)})\b", r"\1 \2_again", text)
add("stored_baselines", f"SELECT store_key, product_key, time_key, {', '.join(AVERAGES.split())} FROM baselines_again", AVERAGES)
add("stored_priors", f"SELECT {KEY}, {', '.join(PRIORS + RATES)} FROM priors_again", " ".join(PRIORS + RATES))
add(
    "stored_lags",
    f"SELECT * FROM ({STATEMENTS['lags'][0]}) WHERE date_key > 20240120",
    STATEMENTS["lags"][1],
)
add(
    "prepare_features_continued",
    f"SELECT * EXCLUDE (part) FROM ({STATEMENTS['prepare_features'][0]}) WHERE part = 'calibration'",
    STATEMENTS["prepare_features"][1],
)
add(
    "stored_reset",
    """SELECT UNNEST(['observations', 'dim_date', 'dim_time', 'dim_city', 'dim_store', 'dim_product', 'dim_model', 'fact_daily',
                      'fact_hourly', 'demand_estimates', 'recommendations', 'model_evaluation']) AS table_name,
              0::BIGINT AS row_count""",
)
add(
    "metrics_flatten_deep",
    """SELECT 'hour_' || time_key || '_x_y_z_rows' AS metric_name, COUNT(*)::DOUBLE AS metric_value FROM hourly GROUP BY time_key
       UNION ALL SELECT 'hour_' || time_key || '_x_y', 1::DOUBLE FROM dim_time""",
    "metric_value",
)
PLACED_EVENTS = "(SELECT event_id, user_id, event_type, value, row_number() OVER () - 1 AS place FROM events)"
add("sample_file_head", f"SELECT * EXCLUDE (place) FROM {PLACED_EVENTS} ORDER BY place LIMIT 1500", "value")
add(
    "sample_file_blocks",
    f"""SELECT * EXCLUDE (place) FROM {PLACED_EVENTS}
        ORDER BY md5('42|events.parquet|' || (place // 400)), place // 400, place LIMIT 1500""",
    "value",
)
add(
    "sample_head_nulls",
    """SELECT source_split, store_id, product_id, dt, sale_amount, IF(store_id % 4 > 0, store_id % 3, NULL) AS lead
       FROM obs WHERE source_split = 'train' ORDER BY lead NULLS FIRST, source_split, store_id, product_id, dt LIMIT 2500""",
    "sale_amount",
)
UNIT = f"('0x' || substr({HASH}, 1, 8))::BIGINT / 4294967296.0::DOUBLE"
add(
    "sample_bernoulli_capped",
    f"""SELECT {KEY}, observed_sales_amount FROM hourly WHERE {UNIT} < 0.2::DOUBLE ORDER BY {KEY} LIMIT 3000""",
    "observed_sales_amount",
)
add(
    "feature_scan_sampled",
    f"""SELECT * FROM features WHERE source_split = 'train' AND {UNIT} < 0.5::DOUBLE
       ORDER BY date_key, source_split, store_key, product_key, time_key LIMIT 4000""",
    FEATURE_DOUBLES,
)
