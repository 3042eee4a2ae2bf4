"""Alerts on events and on run history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.functions.columns import ratio

ALERT_COLUMNS = ("event_id", "user_id", "amount", "timestamp", "event_type")


def high_value(df: DataFrame, threshold: float = 10000) -> DataFrame:
    """Events whose amount exceeds ``threshold``, reduced to the alert columns."""
    return df.where(F.col("amount") > threshold).select(*ALERT_COLUMNS)


def error_rate(
    df: DataFrame,
    *,
    duration: str = "5 minutes",
    threshold: float = 0.05,
    error_type: str = "ERROR",
    ts: str = "timestamp",
    delay: str = "10 minutes",
) -> DataFrame:
    """Windows in which the share of error events exceeds ``threshold``."""
    marked = df.withWatermark(ts, delay) if df.isStreaming else df
    counted = marked.groupBy(F.window(ts, duration).alias("window")).agg(
        F.count("*").alias("event_count"),
        F.count_if(F.col("event_type") == error_type).alias("error_count"),
    )
    return (
        counted.select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "event_count",
            "error_count",
            ratio(F.col("error_count"), F.col("event_count")).alias("error_rate"),
        )
        .where(F.col("error_rate") > threshold)
    )


def slow_runs(runs: DataFrame, threshold: float = 300) -> DataFrame:
    """Runs that took longer than ``threshold`` seconds."""
    return runs.where(F.col("duration_seconds") > threshold)
