"""Windows, sessions, patterns (batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import PATTERN, TIDY, events_tidy, plain_times, rounded
from clickweir.operators import windows

# The fixture has few events per user, so user windows are days wide.
DAYS = {"duration": "3 days", "slide": "1 day"}


def sliding(spark: SparkSession, d: str) -> DataFrame:
    return rounded(plain_times(windows.window_agg(events_tidy(spark, d))))


def tumbling(spark: SparkSession, d: str) -> DataFrame:
    rows = windows.window_agg(
        events_tidy(spark, d), duration="1 hour", slide=None, keys=["event_type"]
    )
    return rounded(plain_times(rows))


def flat_counts(rows: DataFrame) -> DataFrame:
    """Type counts as text such as ``CLICK:2,VIEW:1``, null types as ``?``."""
    text = F.transform(
        "type_counts",
        lambda p: F.concat(F.coalesce(p["event_type"], F.lit("?")), F.lit(":"), p["n"]),
    )
    return rows.withColumn("type_counts", F.concat_ws(",", F.sort_array(text)))


def user_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = windows.user_windows(events_tidy(spark, d), duration="20 minutes", slide="5 minutes")
    return rounded(plain_times(flat_counts(rows)))


def cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    rows = windows.user_windows(events_tidy(spark, d), **DAYS)
    matched = windows.match_all(rows, PATTERN).withColumn(
        "sequence_length", windows.event_count(F.col("type_counts"))
    )
    return rounded(plain_times(flat_counts(matched)))


def ordered(spark: SparkSession, d: str) -> DataFrame:
    rows = windows.match_ordered(events_tidy(spark, d), pattern=PATTERN, **DAYS)
    return plain_times(rows)


def sessions(spark: SparkSession, d: str) -> DataFrame:
    return rounded(plain_times(windows.user_sessions(events_tidy(spark, d), gap="6 hours")))


SLIDING = TIDY + """,
spread as (
  select *, date_trunc('minute', "timestamp") - k * interval 1 minute as window_start
  from tidy, (select unnest(generate_series(0, 4)) as k)),
sliding as (
  select event_type, category, count(*) as event_count, sum(amount) as total_amount,
    avg(amount) as avg_amount, max(amount) as max_amount,
    count(distinct user_id) as unique_users, window_start,
    window_start + interval 5 minute as window_end
  from spread group by event_type, category, window_start)
"""
ROUND_SLIDING = """select * replace (round(total_amount, 4) as total_amount,
  round(avg_amount, 4) as avg_amount, round(max_amount, 4) as max_amount) from sliding"""


def user_windows_sql(step: str, count: int, width: str, where: str = "true") -> str:
    """User windows in SQL: ``count`` windows of ``width``, ``step`` apart, per event."""
    return TIDY + f""",
spread as (
  select *, time_bucket(interval {step}, "timestamp", timestamp '1970-01-01')
            - k * interval {step} as window_start
  from tidy, (select unnest(generate_series(0, {count - 1})) as k) where {where}),
per_type as (
  select user_id, window_start, event_type, count(*) as n, sum(amount) as v,
    max("timestamp") as t from spread group by all),
user_windows as (
  select user_id, cast(sum(n) as bigint) as events_in_session,
    array_to_string(list_sort(list(coalesce(event_type, '?') || ':' || n)), ',') as type_counts,
    round(sum(v), 4) as session_value, max(t) as last_activity, window_start,
    window_start + interval {width} as window_end,
    cast(sum(n) filter (where event_type is not null) as bigint) as sequence_length,
    count(*) filter (where event_type in ('VIEW', 'CLICK', 'PURCHASE')) = 3 as matched
  from per_type group by user_id, window_start)
"""


ORDERED = TIDY + """,
spread as (
  select user_id, event_type, "timestamp" as t,
    date_trunc('day', "timestamp") - k * interval 1 day as window_start
  from tidy, (select unnest(generate_series(0, 2)) as k)),
first_step as (
  select user_id, window_start, min(t) as t1 from spread where event_type = 'VIEW' group by all),
second_step as (
  select s.user_id, s.window_start, min(t) as t2 from spread s join first_step f
    on s.user_id = f.user_id and s.window_start = f.window_start
  where event_type = 'CLICK' and t > t1 group by all),
ordered as (
  select distinct s.user_id, s.window_start, s.window_start + interval 3 day as window_end
  from spread s join second_step f
    on s.user_id = f.user_id and s.window_start = f.window_start
  where event_type = 'PURCHASE' and t > t2)
"""

SESSIONS = TIDY + """,
flagged as (
  select *, case when "timestamp" <= lag("timestamp") over w + interval 6 hour
                 then 0 else 1 end as opened
  from tidy window w as (partition by user_id order by "timestamp")),
numbered as (
  select *, sum(opened) over (partition by user_id order by "timestamp"
                              rows unbounded preceding) as session from flagged),
sessions as (
  select user_id, min("timestamp") as session_start,
    max("timestamp") + interval 6 hour as session_end,
    count(*) as events_in_session, round(sum(amount), 4) as session_value
  from numbered group by user_id, session)
"""

CHECKS = {
    "sliding_window_agg": (sliding, SLIDING + ROUND_SLIDING),
    "tumbling_window_agg": (
        tumbling,
        TIDY
        + """select event_type, count(*) as event_count, round(sum(amount), 4) as total_amount,
             round(avg(amount), 4) as avg_amount, round(max(amount), 4) as max_amount,
             count(distinct user_id) as unique_users,
             date_trunc('hour', "timestamp") as window_start,
             date_trunc('hour', "timestamp") + interval 1 hour as window_end
             from tidy group by all""",
    ),
    "user_overlap_windows": (
        user_windows,
        user_windows_sql("5 minute", 4, "20 minute")
        + "select * exclude (sequence_length, matched) from user_windows",
    ),
    "pattern_cooccurrence": (
        cooccurrence,
        user_windows_sql("1 day", 3, "3 day")
        + "select * exclude (matched), matched as has_purchase_pattern from user_windows "
        "where matched",
    ),
    "pattern_ordered": (ordered, ORDERED + "select * from ordered"),
    "user_sessions": (sessions, SESSIONS + "select * from sessions"),
}
