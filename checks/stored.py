"""Stored sketches, key ledgers, bucketed tables, nested schemas, reasons, stream state."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.runs import _RUNS, history
from checks.streams import closed, drain, finish, parsed
from checks.tables import SHAPED, TIDY, events_shaped, events_tidy, plain_times, rounded, stream, table
from checks.windows import ROUND_SLIDING, SLIDING
from clickweir.operators import buckets, clean, quality, sketches, windows
from clickweir.sources.stream import parse_envelope, split_malformed, to_envelope, with_reason
from clickweir.streaming.run import LOCAL_SESSIONS, Sink, start
from clickweir.streaming.state import open_windows
from clickweir.workspace import materialise, shared_dir

SHARES = (0.5, 0.95, 0.99)


def sketch_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles per operation from hourly sketches, next to the exact ranks of what they say."""
    runs = history(spark, d)
    stored = materialise(sketches.value_sketches(runs, "duration_seconds"))
    answers = F.broadcast(sketches.quantiles(stored, SHARES))  # a row per operation and share
    value = F.col("duration_seconds")
    ranks = (
        runs.select("operation", "duration_seconds")
        .join(answers, "operation")
        .groupBy("operation", "share", "values")
        .agg(
            (F.count_if(value < F.col("quantile")) / F.count("*")).alias("below"),
            (F.count_if(value <= F.col("quantile")) / F.count("*")).alias("up_to"),
        )
    )
    # The stated error holds 99 of 100 times; twice of it, practically always.
    slack = 2 * sketches.rank_error()
    within = (F.col("below") - slack <= F.col("share")) & (F.col("share") <= F.col("up_to") + slack)
    return ranks.select("operation", "share", "values", within.alias("within"))


def sketch_share_below(spark: SparkSession, d: str) -> DataFrame:
    """The share of runs of up to a minute in a range of hours, against the exact one."""
    since, until = "2024-01-08 00:00:00", "2024-01-22 00:00:00"
    runs = history(spark, d)
    stored = materialise(sketches.value_sketches(runs, "duration_seconds"))
    asked = sketches.share_below(
        stored,
        60,
        since=F.lit(since).cast("timestamp"),
        until=F.lit(until).cast("timestamp"),
    )
    inside = runs.where((F.col("start_time") >= since) & (F.col("start_time") < until))
    exact = inside.groupBy("operation").agg(
        (F.count_if(F.col("duration_seconds") <= 60) / F.count("*")).alias("exact")
    )
    near = F.abs(F.col("share") - F.col("exact")) <= 2 * sketches.rank_error()
    return asked.join(exact, "operation").select("operation", "values", near.alias("near"))


def _users(spark: SparkSession, d: str) -> DataFrame:
    return materialise(sketches.user_sketches(events_tidy(spark, d)))


def sketch_users(spark: SparkSession, d: str) -> DataFrame:
    """Distinct users per type over two weeks from daily sketches, against the exact count."""
    since, until = "2024-01-08 00:00:00", "2024-01-22 00:00:00"
    asked = sketches.distinct_users(
        _users(spark, d),
        ["event_type"],
        F.lit(since).cast("timestamp"),
        F.lit(until).cast("timestamp"),
    )
    inside = events_tidy(spark, d).where((F.col("timestamp") >= since) & (F.col("timestamp") < until))
    exact = inside.groupBy("event_type").agg(F.countDistinct("user_id").alias("exact_users"))
    both = asked.alias("a").join(
        exact.alias("e"), F.col("a.event_type").eqNullSafe(F.col("e.event_type"))
    )
    near = F.abs(F.col("users") - F.col("exact_users")) <= 4 * sketches.count_error() * F.col(
        "exact_users"
    )
    return both.select("a.event_type", "events", "exact_users", near.alias("near"))


def sketch_returning(spark: SparkSession, d: str) -> DataFrame:
    """Users per day who were there the day before, are new, or are gone (exact at this size)."""
    return plain_times(sketches.returning_users(_users(spark, d)))


def _weekly(spark: SparkSession, d: str) -> DataFrame:
    """Events by week; every fiftieth comes again eight days later."""
    events = events_shaped(spark, d).select("event_id", "timestamp")
    again = F.col("event_id").cast("long") % 50 == 1
    days = F.when(again, F.array(F.lit(0), F.lit(8))).otherwise(F.array(F.lit(0)))
    later = events.withColumn("later", F.explode(days)).withColumn(
        "timestamp", F.col("timestamp") + F.make_dt_interval(days=F.col("later"))
    )
    return later.withColumn("week", F.date_format(F.date_trunc("week", "timestamp"), "yyyy-MM-dd"))


def ledger_runs(spark: SparkSession, d: str) -> DataFrame:
    """Weekly runs against a ledger of event ids, all of them repeated: rows kept each time."""
    name = f"ledger_{uuid.uuid4().hex}"
    ledger = buckets.KeyLedger(spark, shared_dir(spark, "ledger"), name, buckets=8)
    rows = materialise(_weekly(spark, d))
    weeks = [r["week"] for r in rows.select("week").distinct().orderBy("week").collect()]
    found = []
    for turn in (1, 2):
        for week in weeks:
            batch = clean.dedup(rows.where(F.col("week") == week), ["event_id"], ["timestamp"])
            batch = batch.where(F.col("event_id").isNotNull())
            kept = materialise(ledger.unseen(batch, "event_id", week))
            found.append((week, turn, ledger.record(kept, "event_id", week)))
    return spark.createDataFrame(found, "week string, turn int, kept long")


def _bucketed(spark: SparkSession, d: str, left: int, right: int) -> DataFrame:
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"
    )
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    names = []
    for df, count in ((lines, left), (orders, right)):
        names.append(f"bucketed_{uuid.uuid4().hex}")
        buckets.write_bucketed(df, names[-1], shared_dir(spark, "bucketed"), ["l_orderkey"], count)
    joined = buckets.bucketed_join(spark, *names, ["l_orderkey"])
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")
    return rounded(
        joined.groupBy("o_orderpriority").agg(F.count("*").alias("lines"), revenue), 2
    )


def bucketed_join(spark: SparkSession, d: str) -> DataFrame:
    return _bucketed(spark, d, 8, 8)


def bucketed_join_uneven(spark: SparkSession, d: str) -> DataFrame:
    return _bucketed(spark, d, 16, 4)


EXPECTED = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("minute", T.LongType()),
        T.StructField("amount", T.StringType()),
        T.StructField("tags", T.ArrayType(T.IntegerType())),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "location",
            T.StructType(
                [
                    T.StructField("country", T.StringType()),
                    T.StructField("zip", T.StringType()),
                    T.StructField("lat", T.FloatType()),
                    T.StructField("lon", T.DoubleType()),
                ]
            ),
        ),
    ]
)


def nested_compliance(spark: SparkSession, d: str) -> DataFrame:
    found = events_shaped(spark, d).select(
        "event_id", "user_id", F.minute("timestamp").alias("minute"), "amount", "tags",
        "properties", "location",
    )
    return quality.nested_compliance(found, EXPECTED).select(
        "path",
        F.coalesce("issue", F.lit("ok")).alias("issue"),
        F.coalesce("null_count", F.lit(-1)).alias("null_count"),
    )


def reject_reasons(spark: SparkSession, d: str) -> DataFrame:
    """A stream of messages, some broken in several ways: one reason per rejected message."""
    e = F.col("event_id")
    rows = stream(spark, d, "events").select(
        F.when(e % 500 != 13, e.cast("string")).alias("event_id"),
        "user_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(e % 50 != 7, F.col("event_type")).alias("event_type"),
        e.alias("number"),
    )
    at, text = F.col("key").cast("string").cast("long") % 40, F.col("value").cast("string")
    broken = (
        F.when(at == 5, F.lit("not json {"))
        .when(at == 6, F.regexp_replace(text, '"user_id":\\d+', '"user_id":"x"'))
        .when(at == 7, F.lit(None))
        .when(at == 8, F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"today"'))
        .when(at == 9, F.concat(F.lit("["), text, F.lit("]")))
        .otherwise(text)
    )
    envelope = to_envelope(rows, "number").withColumn("value", broken.cast("binary"))
    _, bad = split_malformed(parse_envelope(envelope, keep_malformed=True))
    found = drain(spark, with_reason(bad).select("kafka_key", "reason", "field"))
    return found.select(
        F.col("kafka_key").cast("long").alias("event_id"),
        "reason",
        F.coalesce("field", F.lit("")).alias("field"),
    )


def hot_sessions(spark: SparkSession, d: str) -> DataFrame:
    """One user owns a third of all events; sessions are merged before the shuffle."""
    hot = F.col("event_id").cast("long") % 3 == 0
    events = parsed(spark, d).withColumn("user_id", F.when(hot, 0).otherwise(F.col("user_id")))
    rows = windows.user_sessions(events)
    return rounded(plain_times(drain(spark, rows, settings=LOCAL_SESSIONS)))


def closing_from_state(spark: SparkSession, d: str) -> DataFrame:
    """Windows a drained stream has written, and those it still holds, read from its state."""
    base = shared_dir(spark, "closing")
    rows = windows.window_agg(parsed(spark, d))
    finish([start(Sink("closing_state", rows, f"{base}/c", path=f"{base}/windows"))])
    written = spark.read.schema(rows.schema).parquet(f"{base}/windows")
    return rounded(plain_times(written.unionByName(open_windows(spark, f"{base}/c"))))


_JOINED = """select o_orderpriority, count(*) as lines,
  round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue
from lineitem join orders on l_orderkey = o_orderkey group by all"""

CHECKS = {
    "sketch_quantiles": (
        sketch_quantiles,
        _RUNS
        + """select operation, share, count(duration_seconds) as values, true as within
             from runs, (select unnest([0.5, 0.95, 0.99])::double as share) group by all""",
    ),
    "sketch_share_below": (
        sketch_share_below,
        _RUNS
        + """select operation, count(duration_seconds) as values, true as near from runs
             where start_time >= '2024-01-08' and start_time < '2024-01-22' group by all""",
    ),
    "sketch_users": (
        sketch_users,
        TIDY
        + """select event_type, count(*) as events, count(distinct user_id) as exact_users,
             true as near from tidy
             where "timestamp" >= '2024-01-08' and "timestamp" < '2024-01-22' group by all""",
    ),
    "sketch_returning": (
        sketch_returning,
        TIDY
        + """, days as (
             select distinct date_trunc('day', "timestamp")::timestamp as slot, user_id from tidy
             where user_id is not null),
           slots as (
             select slot, lag(slot) over (order by slot) as before, count(*) as users
             from days group by slot),
           kept as (
             select s.slot, count(*) as back from slots s
             join days a on a.slot = s.slot join days b on b.slot = s.before and b.user_id = a.user_id
             group by s.slot)
           select s.slot, s.users, coalesce(back, 0) as "returning",
             s.users - coalesce(back, 0) as new,
             coalesce(p.users - coalesce(back, 0), 0)::bigint as gone
           from slots s left join kept using (slot) left join slots p on p.slot = s.before""",
    ),
    "ledger_runs": (
        ledger_runs,
        SHAPED
        + """, later as (
             select event_id, "timestamp" + k * interval 8 day as t
             from shaped, (select unnest([0, 1]) as k)
             where event_id is not null and (k = 0 or event_id::bigint % 50 = 1)),
           firsts as (select event_id, min(date_trunc('week', t)) as week from later group by 1),
           weeks as (select distinct date_trunc('week', t) as week from later)
           select strftime(week, '%Y-%m-%d') as week, turn::integer as turn,
             count(event_id) as kept
           from weeks left join firsts using (week), (select unnest([1, 2]) as turn) group by all""",
    ),
    "bucketed_join": (bucketed_join, _JOINED),
    "bucketed_join_uneven": (bucketed_join_uneven, _JOINED),
    "nested_compliance": (
        nested_compliance,
        SHAPED
        + """select unnest(['event_id', 'user_id', 'minute', 'amount', 'tags[]', 'properties.key',
               'properties.value', 'location.country', 'location.zip', 'location.lat',
               'location.lon', 'location.city']) as path,
             unnest(['ok', 'widened', 'narrowed', 'type', 'type', 'ok', 'ok', 'ok', 'missing',
               'widened', 'ok', 'extra']) as issue,
             unnest([count(*) - count(event_id), count(*) - count(user_id),
               count(*) - count("timestamp"), count(*) - count(amount), -1, -1, -1,
               count(*) - count(country), -1,
               count(*) filter (where eid % 6 = 0), count(*) filter (where eid % 6 = 0),
               count(*) filter (where eid % 6 = 0 or city is null)]) as null_count
             from (select * replace (case when eid % 6 <> 0 then country end as country) from shaped)""",
    ),
    "stream_reject_reasons": (
        reject_reasons,
        """select event_id, fault[1] as reason, fault[2] as field from (
             select event_id, case
               when event_id % 40 = 7 then ['empty', '']
               when event_id % 40 in (5, 9) then ['not json', '']
               when event_id % 500 = 13 then ['missing', 'event_id']
               when event_id % 40 = 6 then ['type', 'user_id']
               when event_id % 40 = 8 then ['type', 'timestamp']
               when event_id % 50 = 7 then ['missing', 'event_type'] end as fault
             from events) where fault is not null""",
    ),
    "stream_hot_sessions": (
        hot_sessions,
        TIDY
        + """, hot as (
             select * replace (case when event_id::bigint % 3 = 0 then 0 else user_id end as user_id)
             from tidy),
           flagged as (
             select *, case when "timestamp" <= lag("timestamp") over w + interval 30 minute
                            then 0 else 1 end as opened
             from hot window w as (partition by user_id order by "timestamp")),
           numbered as (
             select *, sum(opened) over (partition by user_id order by "timestamp"
                                         rows unbounded preceding) as session from flagged),
           sessions as (
             select user_id, min("timestamp") as session_start,
               max("timestamp") + interval 30 minute as session_end,
               count(*) as events_in_session, round(sum(amount), 4) as session_value
             from numbered group by user_id, session)
           select * from sessions """
        + closed("session_end", "30 minute"),
    ),
    "stream_closing_state": (closing_from_state, SLIDING + ROUND_SLIDING),
}
