"""Run history: summaries, histograms, rates, degradation, error rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import TIDY, events_tidy, plain_times, rounded, table
from clickweir.operators import alerts, runs


def history(spark: SparkSession, d: str) -> DataFrame:
    """The events as finished runs: type = operation, value = seconds."""
    start = F.col("ts").cast("timestamp")
    end = F.timestamp_micros(
        F.unix_micros(start) + F.round(F.col("value") * 1e6).cast("long")
    )
    rows = table(spark, d, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("operation"),
        start.alias("start_time"),
        end.alias("end_time"),
        F.col("user_id").alias("records_processed"),
        F.when(F.col("value") > 60, "failure").otherwise("success").alias("status"),
    )
    return runs.with_run_metrics(rows)


def run_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = history(spark, d)
    return rounded(rows.select("run_id", "duration_seconds", "throughput_per_second"), 3)


def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(runs.run_summary(history(spark, d)), 3)


def run_totals(spark: SparkSession, d: str) -> DataFrame:
    return runs.run_totals(history(spark, d))


def latency_histogram(spark: SparkSession, d: str) -> DataFrame:
    return runs.bucket_counts(history(spark, d), "duration_seconds", by=["operation"])


def latency_p95(spark: SparkSession, d: str) -> DataFrame:
    hist = runs.bucket_counts(history(spark, d), "duration_seconds", by=["operation"])
    return rounded(runs.bucket_quantile(hist, 0.95, by=["operation"]), 6)


def degradation(spark: SparkSession, d: str) -> DataFrame:
    rows = runs.degraded_runs(history(spark, d), order=["start_time", "run_id"])
    return rounded(
        rows.select(
            "run_id", "operation", "duration_seconds", "average_duration", "degradation_factor"
        ),
        3,
    )


def slow_runs(spark: SparkSession, d: str) -> DataFrame:
    return alerts.slow_runs(history(spark, d), 300).select("run_id", "operation")


def event_rate(spark: SparkSession, d: str) -> DataFrame:
    rows = runs.event_rate(events_tidy(spark, d))
    return rounded(plain_times(rows), 8)


def error_rate(spark: SparkSession, d: str) -> DataFrame:
    rows = alerts.error_rate(events_tidy(spark, d), duration="1 hour", threshold=0.25)
    return rounded(plain_times(rows), 6)


_RUNS = """
with runs as (
  select event_id as run_id, event_type as operation, ts as start_time,
    value as duration_seconds, user_id as records_processed,
    case when value > 60 then 'failure' else 'success' end as status,
    case when value > 0 then user_id / value else 0.0 end as throughput_per_second
  from events)
"""

_LIMITS = "[0.1, 0.5, 1, 2, 5, 10, 30, 60, 120, 300, 600, 'Infinity'::double]"

_HIST = _RUNS + f""",
limits as (select unnest({_LIMITS}) as le),
hist as (
  select operation, le, count(*) filter (where duration_seconds <= le) as bucket_count
  from runs, limits group by operation, le)
"""

ERRORS = """,
rates as (
  select date_trunc('hour', "timestamp") as window_start,
    date_trunc('hour', "timestamp") + interval 1 hour as window_end,
    count(*) as event_count, count(*) filter (where event_type = 'ERROR') as error_count
  from tidy group by all),
alarms as (
  select *, round(error_count / event_count, 6) as error_rate from rates
  where error_count / event_count > 0.25)
"""

CHECKS = {
    "run_metrics": (
        run_metrics,
        _RUNS
        + """select run_id, round(duration_seconds, 3) as duration_seconds,
             round(throughput_per_second, 3) as throughput_per_second from runs""",
    ),
    "run_summary": (
        run_summary,
        _RUNS
        + """select operation, count(*) as run_count,
             round(avg(duration_seconds), 3) as avg_duration,
             round(min(duration_seconds), 3) as min_duration,
             round(max(duration_seconds), 3) as max_duration,
             round(avg(throughput_per_second), 3) as avg_throughput,
             cast(sum(records_processed) as bigint) as total_records
             from runs group by operation""",
    ),
    "run_totals": (
        run_totals,
        _RUNS
        + """select operation, status, count(*) as runs,
             cast(sum(records_processed) as bigint) as records from runs group by all""",
    ),
    "latency_histogram": (latency_histogram, _HIST + "select * from hist"),
    "latency_p95_from_buckets": (
        latency_p95,
        _HIST
        + """, ranked as (
             select operation, le, bucket_count,
               lag(le, 1, 0.0) over w as lo, lag(bucket_count, 1, 0) over w as before,
               0.95 * max(bucket_count) over (partition by operation) as rank
             from hist window w as (partition by operation order by le)),
             hit as (
             select *, row_number() over (partition by operation order by le) as rn
             from ranked where bucket_count >= rank)
             select operation, round(case when isinf(le) then lo
               else lo + (le - lo) * (rank - before) / (bucket_count - before) end, 6) as quantile
             from hit where rn = 1""",
    ),
    "run_degradation": (
        degradation,
        _RUNS
        + """, rolled as (
             select *, avg(duration_seconds) over w as average_duration, count(*) over w as n
             from runs window w as (partition by operation order by start_time, run_id
                                    rows between 4 preceding and current row))
             select run_id, operation, round(duration_seconds, 3) as duration_seconds,
               round(average_duration, 3) as average_duration,
               round(duration_seconds / average_duration, 3) as degradation_factor
             from rolled where n = 5 and duration_seconds > 1.5 * average_duration""",
    ),
    "slow_runs": (
        slow_runs,
        _RUNS + "select run_id, operation from runs where duration_seconds > 300",
    ),
    "event_rate_5m": (
        event_rate,
        TIDY
        + """select time_bucket(interval 5 minute, "timestamp", timestamp '1970-01-01')
               as window_start, count(*) as event_count,
             round(count(*) / 300, 8) as rate_per_second from tidy group by all""",
    ),
    "error_rate_alerts": (error_rate, TIDY + ERRORS + "select * from alarms"),
}
