"""Data quality report and declared constraints, as counts of failing rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock import schema as S
from restock.session import materialise
from restock.functions.hours import array_total, business_slice

SUM_TOLERANCE = 0.000001


def _length_fails(name: str) -> Column:
    return ~F.size(name).eqNullSafe(F.lit(S.HOURS_PER_DAY))


def _row_checks() -> dict[str, Column]:
    """The checks that look at one row at a time, in report order."""
    names = [name for name, _, _ in S.QUALITY_CHECKS]
    hourly_sum = F.coalesce(array_total(F.col("hours_sale")), F.lit(0.0))
    flagged = F.coalesce(array_total(business_slice(F.col("hours_stock_status")), 0), F.lit(0))
    fails = [
        _length_fails("hours_sale"),
        _length_fails("hours_stock_status"),
        F.abs(F.col("sale_amount") - hourly_sum) > SUM_TOLERANCE,
        F.col("stock_hour6_22_cnt") != flagged,
    ]
    return dict(zip(names, fails))


def row_check_counts(obs: DataFrame) -> DataFrame:
    """All per-row checks in one scan: (check_name, failed_rows)."""
    checks = _row_checks()
    counts = obs.agg(*[F.count_if(fails).alias(name) for name, fails in checks.items()])
    return counts.unpivot([], list(checks), "check_name", "failed_rows")


def duplicate_count(obs: DataFrame) -> DataFrame:
    """Surplus rows of the observation grain: (check_name, failed_rows)."""
    groups = obs.groupBy(*S.OBSERVATION_GRAIN).count()
    surplus = groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("failed_rows"))
    return surplus.select(F.lit(S.QUALITY_CHECKS[-1][0]).alias("check_name"), "failed_rows")


def data_quality_checks(obs: DataFrame) -> DataFrame:
    counts = row_check_counts(obs).unionByName(duplicate_count(obs))
    described = F.create_map(
        *[
            part
            for name, severity, text in S.QUALITY_CHECKS
            for part in (F.lit(name), F.struct(F.lit(severity).alias("severity"), F.lit(text).alias("details")))
        ]
    )[F.col("check_name")]
    return counts.withColumn("_about", described).select(
        "check_name", "failed_rows", F.col("_about.severity").alias("severity"), F.col("_about.details").alias("details")
    )


def single_check(obs: DataFrame, name: str) -> DataFrame:
    """One row of the report, computed on its own."""
    if name == S.QUALITY_CHECKS[-1][0]:
        return duplicate_count(obs)
    return obs.agg(F.count_if(_row_checks()[name]).alias("failed_rows")).select(
        F.lit(name).alias("check_name"), "failed_rows"
    )


def failed_checks(report: DataFrame) -> DataFrame:
    """Checks with failures, each with the number of failed checks beside it."""
    total = report.agg(F.count_if(F.col("failed_rows") > 0).alias("n")).scalar()
    return report.filter(F.col("failed_rows") > 0).withColumn("failed_checks", total)


def quality_order(report: DataFrame) -> DataFrame:
    return report.orderBy("severity", "check_name")


def _domain_rules(table: str, df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """All row rules of a table in one scan; a null outcome is no violation, as in SQL CHECK."""
    counts = df.agg(*[F.count_if(~holds).alias(rule) for rule, holds in rules.items()])
    return counts.unpivot([], list(rules), "rule_name", "violations").select(
        F.lit(table).alias("table_name"), "rule_name", "violations"
    )


def _unique_rule(table: str, df: DataFrame, keys: list[str]) -> DataFrame:
    surplus = df.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"))
    return surplus.select(
        F.lit(table).alias("table_name"), F.lit("unique:" + ",".join(keys)).alias("rule_name"), "violations"
    )


def _reference_rules(table: str, df: DataFrame, parents: dict[str, DataFrame]) -> list[DataFrame]:
    """Rows whose key a parent lacks, for all keys of a table in one scan.

    Rows are counted per value of each key first, so only values are joined.
    """
    keys = list(parents)
    sets = df.groupingSets([[F.col(key)] for key in keys], *keys)
    counted = materialise(sets.agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("count")))
    reports = []
    for place, (key, parent) in enumerate(parents.items()):
        # A bit is set for every key that a grouping set leaves out.
        own = counted.filter(F.col("_set") == 2 ** len(keys) - 1 - 2 ** (len(keys) - 1 - place))
        orphans = own.select(key, "count").join(parent.select(key).distinct(), key, "left_anti")
        total = orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("violations"))
        named = F.lit(table).alias("table_name"), F.lit(f"reference:{key}").alias("rule_name")
        reports.append(total.select(*named, "violations"))
    return reports


def _not_null(names: list[str]) -> dict[str, Column]:
    return {f"not_null:{name}": F.col(name).isNotNull() for name in names}


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per declared constraint of the model: (table_name, rule_name, violations).

    Tables are taken by name: observations, dim_date, dim_time, dim_city, dim_store, dim_product,
    dim_model, fact_daily, fact_hourly, demand_estimates, recommendations, model_evaluation.
    """
    unit = lambda name: F.col(name).between(0, 1)
    known_split = {"check:source_split": F.col("source_split").isin(*S.SPLITS)}
    keys = {
        "observations": [S.OBSERVATION_GRAIN],
        "dim_date": [["date_key"], ["full_date"]],
        "dim_time": [["time_key"]],
        "dim_city": [["city_key"], ["city_id"]],
        "dim_store": [["store_key"], ["store_id"]],
        "dim_product": [["product_key"], ["product_id"]],
        "dim_model": [["model_key"], ["model_name", "model_version"]],
        "fact_daily": [S.DAILY_KEY],
        "fact_hourly": [S.HOURLY_KEY],
        "demand_estimates": [S.ESTIMATE_KEY],
        "recommendations": [S.RECOMMENDATION_KEY],
        "model_evaluation": [S.EVALUATION_KEY],
    }
    checks = {
        "observations": {
            **known_split,
            "check:hours_sale": F.size("hours_sale") == S.HOURS_PER_DAY,
            "check:hours_stock_status": F.size("hours_stock_status") == S.HOURS_PER_DAY,
            **_not_null(S.OBSERVATION.names),
        },
        "dim_time": {
            "check:time_key": F.col("time_key").between(0, 23),
            "check:hour_of_day": F.col("hour_of_day").between(0, 23),
        },
        "fact_daily": {**known_split, **_not_null(S.FACT_DAILY.names)},
        "fact_hourly": {**known_split, **_not_null(S.FACT_HOURLY.names)},
        "demand_estimates": {
            "check:estimated_lost_sales": F.col("estimated_lost_sales") >= 0,
            **_not_null(S.DEMAND_ESTIMATE.names[:-2]),
        },
        "recommendations": {
            "check:stockout_risk_score": unit("stockout_risk_score"),
            "check:service_level_target": unit("service_level_target"),
            **_not_null(S.RECOMMENDATION.names),
        },
        "model_evaluation": _not_null(["metric_value"]),
    }
    parents = {"date_key": "dim_date", "time_key": "dim_time", "store_key": "dim_store"}
    parents.update({"product_key": "dim_product", "model_key": "dim_model", "city_key": "dim_city"})
    references = {
        "dim_store": ["city_key"],
        "fact_daily": S.DAILY_KEY,
        "fact_hourly": S.HOURLY_KEY,
        "demand_estimates": S.ESTIMATE_KEY,
        "recommendations": S.RECOMMENDATION_KEY,
        "model_evaluation": ["model_key"],
    }
    parts = [_unique_rule(t, tables[t], k) for t, all_keys in keys.items() if t in tables for k in all_keys]
    parts += [_domain_rules(t, tables[t], rules) for t, rules in checks.items() if t in tables]
    for t, names in references.items():
        if t in tables:
            parts += _reference_rules(t, tables[t], {key: tables[parents[key]] for key in names})
    return reduce(DataFrame.unionByName, parts)
