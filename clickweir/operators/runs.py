"""Run-history analytics: summaries, histograms, rates, degradation.

A run history is a table with one row per finished run (``schema.RUN``), not a
list in the driver program, so it can cover every job of a cluster for years.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweir import schema
from clickweir.functions.columns import ratio, seconds_between

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds_in(duration: str) -> int:
    """Seconds in a duration such as ``5 minutes``."""
    parts = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day|week)s?\s*", duration)
    if not parts:
        raise ValueError(f"not a duration: {duration!r}")
    return int(parts.group(1)) * _SECONDS[parts.group(2)]


def with_run_metrics(runs: DataFrame) -> DataFrame:
    """Duration in seconds and records per second of each run (0 for a zero duration)."""
    timed = runs.withColumn(
        "duration_seconds", seconds_between(F.col("start_time"), F.col("end_time"))
    )
    return timed.withColumn(
        "throughput_per_second",
        ratio(F.col("records_processed"), F.col("duration_seconds")),
    )


def run_summary(runs: DataFrame, by: Sequence[str] = ("operation",)) -> DataFrame:
    """Runs, duration statistics, mean throughput and total records per ``by``."""
    return runs.groupBy(*by).agg(
        F.count("*").alias("run_count"),
        F.avg("duration_seconds").alias("avg_duration"),
        F.min("duration_seconds").alias("min_duration"),
        F.max("duration_seconds").alias("max_duration"),
        F.avg("throughput_per_second").alias("avg_throughput"),
        F.sum("records_processed").alias("total_records"),
    )


def run_totals(runs: DataFrame, status: str = "status") -> DataFrame:
    """Runs and records per operation and status: the dashboard's total panels."""
    return runs.groupBy("operation", status).agg(
        F.count("*").alias("runs"), F.sum("records_processed").alias("records")
    )


def bucket_counts(
    df: DataFrame,
    value: str,
    bounds: Sequence[float] = schema.DURATION_BOUNDS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Cumulative histogram: ``(by..., le, bucket_count)``, with ``le`` = infinity last.

    One counter per bound in a single pass; only the counters are shuffled.
    """
    limits = [*[float(b) for b in bounds], float("inf")]
    counters = [F.count_if(F.col(value) <= limit).alias(f"b{i}") for i, limit in enumerate(limits)]
    rows = F.array(
        *[
            F.struct(F.lit(limit).alias("le"), F.col(f"b{i}").alias("bucket_count"))
            for i, limit in enumerate(limits)
        ]
    )
    return df.groupBy(*by).agg(*counters).select(*by, F.inline(rows))


def bucket_quantile(hist: DataFrame, q: float, by: Sequence[str] = ()) -> DataFrame:
    """Quantile ``q`` by linear interpolation inside the bucket it falls in.

    That is the first bucket with as many values up to its bound as the rank
    asks for. Beyond the highest finite bound that bound is returned; the first
    bucket starts at 0, or at its bound if that is lower. An empty histogram
    has no quantile. The window runs over the buckets of one histogram.
    """
    span = Window.partitionBy(*by).orderBy("le")
    whole = Window.partitionBy(*by)
    ranked = hist.select(
        *by,
        "le",
        "bucket_count",
        F.lag("le", 1).over(span).alias("_from"),
        F.lag("bucket_count", 1, 0).over(span).alias("_before"),
        (F.lit(q) * F.max("bucket_count").over(whole)).alias("_rank"),
    )
    reached = (F.col("bucket_count") > 0) & (F.col("bucket_count") >= F.col("_rank"))
    first = ranked.where(reached).withColumn("_place", F.row_number().over(span))
    low = F.coalesce("_from", F.least(F.lit(0.0), F.col("le")))
    share = (F.col("_rank") - F.col("_before")) / (F.col("bucket_count") - F.col("_before"))
    inside = low + (F.col("le") - low) * F.greatest(share, F.lit(0.0))
    return first.where("_place = 1").select(
        *by, F.when(F.col("le") == float("inf"), low).otherwise(inside).alias("quantile")
    )


def event_rate(
    df: DataFrame,
    *,
    duration: str = "5 minutes",
    by: Sequence[str] = (),
    ts: str = "timestamp",
    delay: str = "10 minutes",
) -> DataFrame:
    """Events per second in each tumbling window."""
    marked = df.withWatermark(ts, delay) if df.isStreaming else df
    counted = marked.groupBy(F.window(ts, duration).alias("window"), *by).agg(
        F.count("*").alias("event_count")
    )
    return counted.select(
        F.col("window.start").alias("window_start"),
        *by,
        "event_count",
        (F.col("event_count") / F.lit(seconds_in(duration))).alias("rate_per_second"),
    )


def degraded_runs(
    runs: DataFrame,
    *,
    n: int = 5,
    factor: float = 1.5,
    order: Sequence[str] = ("start_time",),
    chunk: str = "1 hour",
) -> DataFrame:
    """Runs that took more than ``factor`` times the mean of the last ``n`` runs.

    The mean covers the run itself and the ``n - 1`` before it of the same
    operation; earlier than the ``n``-th run nothing is reported. There are few
    operations and one may own most runs, so the ordered pass is per
    (operation, chunk of time): each chunk is given copies of the ``n - 1``
    runs before it. Those are found among the last runs of each chunk, which
    every map task cuts to ``n - 1`` before the shuffle.
    """
    keys = ["operation", "_slot"]
    slotted = runs.withColumn("_slot", F.window(order[0], chunk)["start"])
    needed = [*order, "duration_seconds"]
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        slotted.select(*keys, *needed)
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= n - 1)
    )
    per_operation = Window.partitionBy("operation").orderBy(*order)
    before = per_operation.rowsBetween(-(n - 1), -1)
    context = (
        tails.select(
            *keys,
            F.collect_list(F.struct(*needed)).over(before).alias("_earlier"),
            F.lag("_slot").over(per_operation).alias("_previous"),
        )
        .where(F.col("_previous").isNull() | (F.col("_previous") != F.col("_slot")))
        .select(*keys, F.inline("_earlier"))
        .withColumn("_copy", F.lit(True))
    )
    rows = slotted.withColumn("_copy", F.lit(False)).unionByName(
        context, allowMissingColumns=True
    )
    last_n = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(n - 1), 0)
    judged = rows.select(
        *runs.columns,
        "_copy",
        F.avg("duration_seconds").over(last_n).alias("average_duration"),
        F.count("*").over(last_n).alias("_runs"),
    )
    return (
        judged.where(
            ~F.col("_copy")
            & (F.col("_runs") == n)
            & (F.col("duration_seconds") > factor * F.col("average_duration"))
        )
        .withColumn(
            "degradation_factor",
            F.try_divide(F.col("duration_seconds"), F.col("average_duration")),
        )
        .drop("_copy", "_runs")
    )
