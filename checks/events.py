"""Cleaning, enrichment, summaries, scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import (
    AS_OF,
    CLEAN,
    ENRICHED,
    KEPT,
    SHAPED,
    TIDY,
    events_shaped,
    events_tidy,
    plain_times,
    rounded,
    table,
)
from clickweir.functions.columns import is_bucket_path, switch_scheme
from clickweir.operators import alerts, clean, layout, summary
from clickweir.sources import batch
from clickweir.workspace import shared_dir


def _prepared(spark, d):
    return clean.prepare_day(events_shaped(spark, d), types=KEPT, as_of=AS_OF)


def _hourly(spark, d):
    return summary.hourly_summary(_prepared(spark, d))


def clean_events(spark: SparkSession, d: str) -> DataFrame:
    kept = clean.clean_events(events_shaped(spark, d))
    return plain_times(
        kept.select("event_id", "user_id", "timestamp", "event_type", "category", "amount")
    )


def enrich_events(spark: SparkSession, d: str) -> DataFrame:
    rows = clean.enrich_events(clean.clean_events(events_shaped(spark, d)), as_of=AS_OF)
    return plain_times(
        rows.select(
            "event_id",
            "processed_date",
            "processed_timestamp",
            "event_date",
            "hour",
            "day_of_week",
            "amount_category",
            "tag_count",
            "has_properties",
        )
    )


def stream_columns(spark: SparkSession, d: str) -> DataFrame:
    rows = clean.enrich_stream(events_tidy(spark, d), as_of=AS_OF)
    return plain_times(
        rows.select(
            "user_id",
            "timestamp",
            "event_date",
            "event_hour",
            "event_minute",
            "amount_range",
            "location_info",
        )
    )


def kept_types(spark: SparkSession, d: str) -> DataFrame:
    return clean.keep_types(events_tidy(spark, d), KEPT).groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users")
    )


def hourly_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_hourly(spark, d))


def summary_ratios(spark: SparkSession, d: str) -> DataFrame:
    rows = summary.with_ratios(_hourly(spark, d))
    return rounded(
        rows.select(*summary.HOURLY_KEYS, "revenue_per_user", "properties_usage_rate")
    )


def daily_rollup_ref(spark: SparkSession, d: str) -> DataFrame:
    return rounded(summary.daily_rollup(summary.with_ratios(_hourly(spark, d))))


def daily_rollup_exact(spark: SparkSession, d: str) -> DataFrame:
    return rounded(summary.daily_rollup_exact(_prepared(spark, d)))


def high_value_alerts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(plain_times(alerts.high_value(events_tidy(spark, d))))


def count_by_type(spark: SparkSession, d: str) -> DataFrame:
    return batch.count_by(spark, table(spark, d, "events"), "event_type", "clickweir_events")


def _by_day(spark, d):
    """The shaped events as a table of one directory per day; returns its path."""
    path = shared_dir(spark, "events-by-day")
    events = events_shaped(spark, d).withColumn("date", F.to_date("timestamp"))
    written = layout.write_partitioned(events, path, ["date"])
    return path, written


def day_scan(spark: SparkSession, d: str) -> DataFrame:
    path, _ = _by_day(spark, d)
    day = batch.read_events(spark, path, dates=["2024-01-03"])
    return plain_times(
        day.select("date", "event_id", "user_id", "timestamp", "category").withColumn(
            "date", F.col("date").cast("string")
        )
    )


def multi_day_scan(spark: SparkSession, d: str) -> DataFrame:
    path, written = _by_day(spark, d)
    days = batch.read_days(spark, path).groupBy(F.col("date").cast("string").alias("date"))
    return days.agg(
        F.count("*").alias("n"),
        F.count("event_id").alias("keyed"),
        F.lit(written).cast("long").alias("written"),
    )


def partitioned_detail(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "detail")
    layout.write_partitioned(_prepared(spark, d), path, ["event_date", "hour"])
    read = spark.read.parquet(path)
    return read.groupBy(F.col("event_date").cast("string").alias("event_date"), "hour").agg(
        F.count("*").alias("n"), F.count_distinct("event_id").alias("events")
    )


def written_summary(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "summary")
    rows = summary.with_ratios(_hourly(spark, d))
    count = layout.write_small(rows, path, ["hour", "event_type"])
    read = spark.read.parquet(path)
    return rounded(
        read.select(*summary.HOURLY_KEYS, "event_count", "total_amount").withColumn(
            "rows_written", F.lit(count).cast("long")
        )
    )


def compacted(spark: SparkSession, d: str) -> DataFrame:
    source, target = shared_dir(spark, "small-files"), shared_dir(spark, "compacted")
    table(spark, d, "lineitem").repartition(32).write.parquet(source)
    report = layout.compact(spark, source, target)
    return report.select("rows_before", "rows_after")


def clustered(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "clustered")
    layout.cluster_table(
        spark, f"{d}/lineitem.parquet", path, ["l_shipdate", "l_orderkey"], target_mb=1
    )
    read = spark.read.parquet(path)
    return rounded(
        read.groupBy("l_shipdate").agg(
            F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")
        )
    )


def sorted_layout(spark: SparkSession, d: str) -> DataFrame:
    rows = layout.rebalance_by(_prepared(spark, d), ["hour", "event_type"])
    return layout.sorted_within(rows, ["hour", "event_type"]).select(
        "event_id", "hour", "event_type"
    )


def union_train_test(spark: SparkSession, d: str) -> DataFrame:
    train = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    test = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text")
    return batch.union_by_name([train, test]).select(
        "id", F.length("text").cast("long").alias("chars"), "lang"
    )


def _train_test(spark, d):
    path = shared_dir(spark, "training")
    table(spark, d, "documents").select("doc_id", "text", "lang").write.parquet(f"{path}/train")
    table(spark, d, "documents").select("doc_id", "source", "n_chars").write.parquet(
        f"{path}/test"
    )
    return path


def merged_scan(spark: SparkSession, d: str) -> DataFrame:
    path = _train_test(spark, d)
    read = batch.read_training(spark, f"{path}/train", f"{path}/test", path)
    return read.select(
        "doc_id",
        F.coalesce(F.length("text").cast("long"), F.lit(-1)).alias("chars"),
        "lang",
        "source",
        F.coalesce("n_chars", F.lit(-1)).alias("n_chars"),
    )


def permissive_scan(spark: SparkSession, d: str) -> DataFrame:
    path = _train_test(spark, d)
    read = batch.read_training(spark, f"{path}/train", f"{path}/absent", path)
    return read.agg(
        F.count("*").alias("n"), F.count("lang").alias("langs"), F.count("source").alias("sources")
    )


def path_normalise(spark: SparkSession, d: str) -> DataFrame:
    url = F.col("url")
    return table(spark, d, "pages").select(
        "page_id",
        switch_scheme(url, "http", "https").alias("path"),
        is_bucket_path(F.regexp_replace(url, "^https?://", "s3://")).alias("is_bucket_path"),
    )


def sensitive_filter(spark: SparkSession, d: str) -> DataFrame:
    return clean.drop_sensitive(table(spark, d, "documents"), "text").select("doc_id", "n_chars")


_HOURLY = """
  select hour, event_type, amount_category,
    count(*) as event_count,
    count(distinct user_id) as unique_users,
    sum(amount) as total_amount, avg(amount) as avg_amount,
    max(amount) as max_amount, min(amount) as min_amount,
    avg(tag_count) as avg_tags_per_event,
    cast(count(*) filter (where has_properties) as bigint) as events_with_properties
  from kept group by all
"""

CHECKS = {
    "clean_events": (
        clean_events,
        CLEAN + 'select event_id, user_id, "timestamp", event_type, category, amount from clean',
    ),
    "enrich_events": (
        enrich_events,
        ENRICHED
        + """select event_id, date '2024-02-01' as processed_date,
             timestamp '2024-02-01 00:00:00' as processed_timestamp, event_date, hour,
             day_of_week, amount_category, tag_count, has_properties from enriched""",
    ),
    "stream_columns": (
        stream_columns,
        TIDY
        + """select user_id, "timestamp", strftime("timestamp", '%Y-%m-%d') as event_date,
             cast(hour("timestamp") as integer) as event_hour,
             cast(minute("timestamp") as integer) as event_minute,
             case when amount is null then 'unknown' when amount < 100 then '0-100'
                  when amount < 500 then '100-500' when amount < 1000 then '500-1000'
                  when amount < 5000 then '1000-5000' else '5000+' end as amount_range,
             case when country is null then 'Unknown Location'
                  else coalesce(city, 'Unknown') || ', ' || country end as location_info
             from tidy""",
    ),
    "kept_types": (
        kept_types,
        TIDY
        + """select event_type, count(*) as n, count(distinct user_id) as users from tidy
             where event_type in ('VIEW','CLICK','SIGNUP','PURCHASE') group by event_type""",
    ),
    "hourly_summary": (
        hourly_summary,
        ENRICHED
        + f"""select * replace (round(total_amount, 4) as total_amount,
               round(avg_amount, 4) as avg_amount, round(max_amount, 4) as max_amount,
               round(min_amount, 4) as min_amount,
               round(avg_tags_per_event, 4) as avg_tags_per_event) from ({_HOURLY})""",
    ),
    "summary_ratios": (
        summary_ratios,
        ENRICHED
        + f"""select hour, event_type, amount_category,
               round(total_amount / unique_users, 4) as revenue_per_user,
               round(events_with_properties / event_count, 4) as properties_usage_rate
               from ({_HOURLY})""",
    ),
    "daily_rollup_ref": (
        daily_rollup_ref,
        ENRICHED
        + f"""select event_type, amount_category,
               cast(sum(event_count) as bigint) as total_events,
               cast(sum(unique_users) as bigint) as total_unique_users,
               round(sum(total_amount), 4) as total_revenue,
               round(avg(total_amount / unique_users), 4) as avg_revenue_per_user
               from ({_HOURLY}) group by all""",
    ),
    "daily_rollup_exact": (
        daily_rollup_exact,
        ENRICHED
        + """select event_type, amount_category, count(*) as total_events,
             count(distinct user_id) as distinct_users, round(sum(amount), 4) as total_revenue,
             round(sum(amount) / count(distinct user_id), 4) as revenue_per_distinct_user
             from kept group by all""",
    ),
    "high_value_alerts": (
        high_value_alerts,
        TIDY
        + """select event_id, user_id, round(amount, 4) as amount, "timestamp", event_type
             from tidy where amount > 10000""",
    ),
    "count_by_type": (
        count_by_type,
        "select event_type, count(*) as n from events group by event_type",
    ),
    "day_partition_scan": (
        day_scan,
        SHAPED
        + """select '2024-01-03' as date, event_id, user_id, "timestamp", category from shaped
             where cast("timestamp" as date) = date '2024-01-03'""",
    ),
    "multi_day_scan": (
        multi_day_scan,
        SHAPED
        + """select strftime("timestamp", '%Y-%m-%d') as date, count(*) as n,
             count(event_id) as keyed, (select count(*) from shaped) as written
             from shaped group by all""",
    ),
    "partitioned_detail": (
        partitioned_detail,
        ENRICHED
        + """select strftime(event_date, '%Y-%m-%d') as event_date, hour, count(*) as n,
             count(distinct event_id) as events from kept group by all""",
    ),
    "written_summary": (
        written_summary,
        ENRICHED
        + f"""select hour, event_type, amount_category, event_count,
               round(total_amount, 4) as total_amount, count(*) over () as rows_written
               from ({_HOURLY})""",
    ),
    "compacted_table": (
        compacted,
        "select count(*) as rows_before, count(*) as rows_after from lineitem",
    ),
    "clustered_table": (
        clustered,
        """select l_shipdate, count(*) as n, round(sum(l_quantity), 4) as quantity
           from lineitem group by l_shipdate""",
    ),
    "sorted_layout": (sorted_layout, ENRICHED + "select event_id, hour, event_type from kept"),
    "union_train_test": (
        union_train_test,
        """select doc_id as id, cast(length(text) as bigint) as chars, lang from documents
           union all select item_id, cast(length(text) as bigint), null from benchmark""",
    ),
    "merged_scan": (
        merged_scan,
        """select doc_id, cast(length(text) as bigint) as chars, lang, null as source,
                  cast(-1 as bigint) as n_chars from documents
           union all select doc_id, -1, null, source, n_chars from documents""",
    ),
    "permissive_scan": (
        permissive_scan,
        """select 2 * count(*) as n, count(*) as langs, count(*) as sources from documents""",
    ),
    "path_normalise": (
        path_normalise,
        """select page_id, regexp_replace(url, '^http://', 'https://') as path,
             regexp_matches(regexp_replace(url, '^https?://', 's3://'),
                            '^(s3|s3a)://[a-z0-9][a-z0-9\\-]*[a-z0-9]/') as is_bucket_path
           from pages""",
    ),
    "sensitive_filter": (
        sensitive_filter,
        """select doc_id, n_chars from documents
           where not regexp_matches(text, 'password|secret|token')""",
    ),
}
