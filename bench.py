"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Tables are derived and
written first (``load``); every query then runs in full, without collecting its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from restock.plans.catalog import QUERIES  # noqa: E402
from restock.plans.examples import MODEL_KEYS, example_warehouse  # noqa: E402
from restock.plans.warehouse import SCHEMAS  # noqa: E402
from restock.schema import SPLITS  # noqa: E402
from restock.session import build_session  # noqa: E402

HEADLINE = [
    "fact_daily",
    "fact_hourly",
    "data_quality_checks",
    "constraint_report",
    "restock_monitor",
    "stockout_rate_by_category",
    "baseline_averages",
    "hourly_demand_estimate",
    "recommendations",
    "decision_scores",
    "kpi_by_day",
    "kpi_by_category",
    "summary",
    "what_if",
    "queue_diverse",
    "hourly_drilldown_day",
    "hour_ranges",
    "lags",
    "store_traffic_lag_1h",
    "demand_priors",
    "prepare_features",
    "comparison_context",
    "latent_target",
    "segment_metrics",
    "calibration_factor",
    "panel_select",
    "sample_product_date_stratified",
    "sample_cap_product_date",
    "fit_hurdle",
    "fit_direct",
    "train_job_metrics",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 4)
    spark = build_session(
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=str(max(int(cpus), 4)),
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    warehouse = example_warehouse(spark, folder)
    # The evaluation table is made of scored rows, so loading, scoring and evaluating are timed apart.
    base = [name for name in SCHEMAS if name != "model_evaluation"]
    times = {"load": timed(lambda: [getattr(warehouse, name).count() for name in base])}
    times["score"] = timed(lambda: [warehouse.scored(key, split).count() for key in MODEL_KEYS for split in SPLITS])
    times["evaluate"] = timed(lambda: warehouse.model_evaluation.count())
    for name in HEADLINE:
        run = lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()  # noqa: B023, E731
        times[name] = timed(run)
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
