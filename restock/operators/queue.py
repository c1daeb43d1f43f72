"""Ranked action queues and what is shown beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restock import schema as S
from restock.functions import scores

QUEUE_SIZE = 200
PER_ACTION = 40

QUEUE_COLUMNS = [
    "full_date",
    "city_id",
    "store_id",
    "product_id",
    "first_category_id",
    "model_name",
    "model_version",
    "estimate_source",
    "observed_daily_sales_amount",
    "estimated_true_demand",
    "estimated_lost_sales",
    "recommended_order_qty",
    "stockout_hours_6_22",
    "stockout_rate_6_22",
    "demand_bias_rate",
    "waste_risk_score",
    "restock_urgency_score",
    "service_level_target",
    "expected_waste_qty",
    "activity_flag",
    "decision_action",
    "decision_reason",
    "inventory_proxy_note",
]


def _priority() -> list[Column]:
    """Most urgent first; the row's own key settles ties.

    Scores come from sums, whose last bits depend on the order of the shuffle. Rounding them here
    keeps equal rows equal, so the queue is the same on every run.
    """
    scores_first = [F.round(name, 9).desc() for name in ("restock_urgency_score", "estimated_lost_sales")]
    return scores_first + [F.desc("stockout_hours_6_22"), F.col("store_id"), F.col("product_id"), F.col("full_date")]


def not_full_stockout(decisions: DataFrame) -> DataFrame:
    """Without days that were out of stock in all business hours and sold nothing."""
    return decisions.filter(
        ~((F.col("stockout_hours_6_22") == S.BUSINESS_HOURS) & (F.col("observed_daily_sales_amount") == 0))
    )


def full_stockout_count(decisions: DataFrame) -> DataFrame:
    full = scores.is_full_stockout(F.col("stockout_hours_6_22"), F.col("observed_daily_sales_amount"))
    return decisions.agg(F.count_if(full).alias("full_stockout_rows"), F.count(F.lit(1)).alias("visible_rows"))


def queue_highest(decisions: DataFrame, n: int = QUEUE_SIZE) -> DataFrame:
    return decisions.select(*QUEUE_COLUMNS).orderBy(*_priority()).limit(n)


def queue_exclude_full(decisions: DataFrame, n: int = QUEUE_SIZE) -> DataFrame:
    return queue_highest(not_full_stockout(decisions), n)


def rank_per_action(decisions: DataFrame, n: int = PER_ACTION) -> DataFrame:
    """The n most urgent rows of each action with their rank.

    There are only five actions, one of which may hold most rows. Spark turns the filter on the
    rank into a group limit ahead of the shuffle, so every task passes on at most n rows per action.
    """
    best_first = Window.partitionBy("decision_action").orderBy(*_priority())
    ranked = decisions.select(*QUEUE_COLUMNS).withColumn("action_rank", F.row_number().over(best_first))
    return ranked.filter(F.col("action_rank") <= n)


def queue_diverse(decisions: DataFrame, per_action: int = PER_ACTION, n: int = QUEUE_SIZE) -> DataFrame:
    """At most ``per_action`` rows of each action, actions in their fixed order."""
    lane = scores.order_rank(F.col("decision_action"), S.DIVERSE_ORDER, len(S.DIVERSE_ORDER))
    return rank_per_action(decisions, per_action).drop("action_rank").orderBy(lane, *_priority()).limit(n)


def top_recommendations(decisions: DataFrame, n: int = 25) -> DataFrame:
    top = decisions.orderBy(*_priority()[:2], "store_id", "product_id", "full_date").limit(n)
    short = lambda name: F.round(F.col(name) + 1e-9, 4).alias(name)
    return top.select(
        "full_date",
        "store_id",
        "product_id",
        "estimate_source",
        "stockout_hours_6_22",
        short("estimated_lost_sales"),
        short("recommended_order_qty"),
        short("restock_urgency_score"),
        "decision_action",
        "decision_reason",
    )


def urgency_breakdown(decisions: DataFrame) -> DataFrame:
    """The three contributions to the urgency and their capped sum; missing values count as 0."""
    given = [F.coalesce(name, F.lit(0.0)) for name in ("stockout_rate_6_22", "demand_bias_rate", "activity_flag")]
    stockout, lost, bonus = scores.urgency_parts(*given)
    return decisions.withColumns(
        {
            "stockout_contribution": stockout,
            "bias_contribution": lost,
            "activity_contribution": bonus,
            "total_urgency": scores.urgency(*given),
        }
    )


def priority_cards(queue: DataFrame, n: int = 6) -> DataFrame:
    """The first rows of a queue, numbered from 1. The queue is a top-n result, so one task holds it."""
    position = F.row_number().over(Window.orderBy(*_priority()))
    first = queue.withColumn("card_position", position).filter(F.col("card_position") <= n)
    return urgency_breakdown(first).withColumn(
        "action_label", scores.lookup(F.col("decision_action"), S.ACTION_LABELS)
    )


def queue_saturation(queue: DataFrame) -> DataFrame:
    """Whether all, some or none of the visible rows are full stockouts."""
    counts = full_stockout_count(queue)
    full, visible = F.col("full_stockout_rows"), F.col("visible_rows")
    state = F.when((visible > 0) & (full == visible), "all").when(full > 0, "some").otherwise("none")
    return counts.withColumn("saturation", state)
