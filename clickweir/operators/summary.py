"""Hourly summary and daily rollups of enriched events (batch)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.functions.columns import ratio

HOURLY_KEYS = ("hour", "event_type", "amount_category")


def hourly_summary(df: DataFrame, keys: Sequence[str] = HOURLY_KEYS) -> DataFrame:
    """Counts, exact distinct users and amount statistics per ``keys``.

    Rows are folded to one partial per (keys, user) in the map tasks, then
    spread by that pair, then by the keys alone, so neither a busy hour nor a
    busy user ends up in one task.
    """
    per_user = df.groupBy(*keys, "user_id").agg(
        F.count("*").alias("events"),
        F.sum("amount").alias("amount_sum"),
        F.count("amount").alias("amount_n"),
        F.max("amount").alias("amount_max"),
        F.min("amount").alias("amount_min"),
        F.sum("tag_count").alias("tags"),
        F.sum(F.col("has_properties").cast("long")).alias("with_properties"),
    )
    return per_user.groupBy(*keys).agg(
        F.sum("events").alias("event_count"),
        F.count("user_id").alias("unique_users"),
        F.sum("amount_sum").alias("total_amount"),
        F.try_divide(F.sum("amount_sum"), F.sum("amount_n")).alias("avg_amount"),
        F.max("amount_max").alias("max_amount"),
        F.min("amount_min").alias("min_amount"),
        (F.sum("tags") / F.sum("events")).alias("avg_tags_per_event"),
        F.sum("with_properties").alias("events_with_properties"),
    )


def with_ratios(summary: DataFrame) -> DataFrame:
    """Revenue per user and share of events with properties."""
    return summary.withColumns(
        {
            "revenue_per_user": ratio(F.col("total_amount"), F.col("unique_users")),
            "properties_usage_rate": ratio(
                F.col("events_with_properties"), F.col("event_count")
            ),
        }
    )


def daily_rollup(
    summary: DataFrame, keys: Sequence[str] = ("event_type", "amount_category")
) -> DataFrame:
    """Rollup of the hourly summary.

    ``total_unique_users`` adds up hourly distinct counts, so a user active in
    two hours counts twice; ``daily_rollup_exact`` gives the true figure.
    """
    return summary.groupBy(*keys).agg(
        F.sum("event_count").alias("total_events"),
        F.sum("unique_users").alias("total_unique_users"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("revenue_per_user").alias("avg_revenue_per_user"),
    )


def daily_rollup_exact(
    detail: DataFrame, keys: Sequence[str] = ("event_type", "amount_category")
) -> DataFrame:
    """Rollup of the enriched events with each user counted once."""
    per_user = detail.groupBy(*keys, "user_id").agg(
        F.count("*").alias("events"), F.sum("amount").alias("amount_sum")
    )
    totals = per_user.groupBy(*keys).agg(
        F.sum("events").alias("total_events"),
        F.count("user_id").alias("distinct_users"),
        F.sum("amount_sum").alias("total_revenue"),
    )
    return totals.withColumn(
        "revenue_per_distinct_user",
        ratio(F.col("total_revenue"), F.col("distinct_users")),
    )
