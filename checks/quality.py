"""Quality reports, scores, gates, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.tables import AS_OF, SHAPED, events_shaped, plain_times, rounded, table
from clickweir import schema
from clickweir.ml.features import column_roles
from clickweir.operators import quality, runs
from clickweir.operators.joins import with_stats
from clickweir.sources.batch import probe_paths


def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.null_counts(events_shaped(spark, d)), 6)


def duplicate_count(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_count(events_shaped(spark, d), ["event_id"])


def amount_moments(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.amount_moments(events_shaped(spark, d)))


def outliers(spark: SparkSession, d: str) -> DataFrame:
    return quality.outlier_count(events_shaped(spark, d))


def _report(spark, d):
    return quality.quality_report(events_shaped(spark, d), as_of=AS_OF)


def quality_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(plain_times(_report(spark, d)))


def _by_day(spark, d):
    events = events_shaped(spark, d).withColumn(
        "day", F.date_format("timestamp", "yyyy-MM-dd")
    )
    return quality.score_history(events, ["day"], as_of=AS_OF)


def quality_score_by_day(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        _by_day(spark, d).select(
            "day",
            "total_records",
            "null_event_id",
            "null_event_type",
            "duplicate_records",
            "outlier_records",
            "quality_score",
        )
    )


def quality_score_histogram(spark: SparkSession, d: str) -> DataFrame:
    return runs.bucket_counts(_by_day(spark, d), "quality_score", schema.SCORE_BOUNDS)


def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.quality_gate(_report(spark, d)), 6)


def row_split(spark: SparkSession, d: str) -> DataFrame:
    rules = {
        "event_id": F.col("event_id").isNotNull(),
        "event_type": F.col("event_type").isNotNull(),
        "amount": F.col("amount").isNull() | (F.col("amount") <= 10000),
    }
    good, rejected = quality.split_rows(events_shaped(spark, d), rules)
    marked = good.select(F.lit("").alias("broken")).unionByName(
        rejected.select(F.concat_ws(",", "broken_rules").alias("broken"))
    )
    return marked.groupBy("broken").agg(F.count("*").alias("n"))


def table_profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.profile(table(spark, d, "orders")).select(
        "row_count", "column_count", "column_names"
    )


def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.column_profile(table(spark, d, "orders"), exact=True).select(
        "column_name", "null_count", "distinct_count"
    )


def schema_compliance(spark: SparkSession, d: str) -> DataFrame:
    expected = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.IntegerType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_clerk", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.TimestampNTZType()),
        ]
    )
    verdict = quality.schema_compliance(table(spark, d, "orders"), expected)
    return verdict.select(
        "column_name",
        F.coalesce("issue", F.lit("ok")).alias("issue"),
        F.coalesce("null_count", F.lit(-1)).alias("null_count"),
    )


def compliance(spark: SparkSession, d: str) -> DataFrame:
    """One verdict for a table as expected, and one for a table that lacks a column."""
    orders = table(spark, d, "orders")
    found = None
    for name, df in (("same", orders), ("cut", orders.drop("o_custkey"))):
        verdict = quality.is_compliant(quality.schema_compliance(df, orders.schema))
        row = verdict.select(
            F.lit(name).alias("given"),
            F.array_join("missing_columns", ",").alias("missing"),
            F.array_join("extra_columns", ",").alias("extra"),
            "is_compliant",
        )
        found = row if found is None else found.unionByName(row)
    return found


def stats_join(spark: SparkSession, d: str) -> DataFrame:
    rows = with_stats(events_shaped(spark, d).where("amount is not null"), ["amount"])
    return rounded(
        rows.select(
            "event_id",
            F.col("amount").alias("amount"),
            ((F.col("amount") - F.col("amount_mean")) / F.col("amount_std")).alias("z"),
        )
    )


def roles(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumnRenamed("doc_id", "id")
    return column_roles(docs)


def path_probe(spark: SparkSession, d: str) -> DataFrame:
    found = probe_paths(spark, [f"{d}/documents.parquet", f"{d}/no_such.parquet"])
    rows = table(spark, d, "documents").agg(F.count("*")).scalar()
    return found.select(
        F.regexp_extract("path", r"([^/]+)\.parquet$", 1).alias("table_name"),
        "readable",
        F.coalesce("column_count", F.lit(0)).alias("column_count"),
        F.when(F.col("has_data"), rows).otherwise(F.lit(0)).alias("table_rows"),
    )


_COLUMNS = (
    "event_id",
    "user_id",
    "timestamp",
    "event_type",
    "category",
    "amount",
    "properties",
    "tags",
    "location",
)
_SQL_NAME = {"properties": "props", "location": "country", "timestamp": '"timestamp"'}


def _null_sql(name: str) -> str:
    column = _SQL_NAME.get(name, name)
    return (
        f"select '{name}' as column_name, count(*) - count({column}) as null_count, "
        f"round((count(*) - count({column})) / count(*), 6) as null_share from shaped"
    )


_REPORT = """,
moments as (select avg(amount) as m, stddev_samp(amount) as s from shaped),
counted as (
  select count(*) as total_records,
    count(*) - count(event_id) as null_event_id, count(*) - count(user_id) as null_user_id,
    count(*) - count("timestamp") as null_timestamp,
    count(*) - count(event_type) as null_event_type,
    max("timestamp") as latest_timestamp, avg(amount) as amount_mean,
    stddev_samp(amount) as amount_std, min(amount) as amount_min, max(amount) as amount_max
  from shaped),
report as (
  select *,
    (select cast(sum(n - 1) as bigint)
       from (select count(*) as n from shaped group by event_id)) as duplicate_records,
    (select count(*) from shaped, moments
      where amount > m + 3 * s or amount < m - 3 * s) as outlier_records
  from counted),
scored as (
  select *, duplicate_records / total_records as duplicate_share,
    epoch(timestamp '2024-02-01' - latest_timestamp) / 3600 as staleness_hours,
    greatest(0, least(100, 100
      - (null_event_id + null_user_id + null_timestamp + null_event_type) * 30 / total_records
      - duplicate_records * 20 / total_records
      - outlier_records * 10 / total_records)) as quality_score
  from report)
"""

_DAYS = """,
dated as (select *, strftime("timestamp", '%Y-%m-%d') as day from shaped),
day_counts as (
  select day, count(*) as total_records, count(*) - count(event_id) as null_event_id,
    count(*) - count(event_type) as null_event_type,
    avg(amount) as m, stddev_samp(amount) as s from dated group by day),
day_dups as (
  select day, cast(sum(n - 1) as bigint) as duplicate_records
  from (select day, event_id, count(*) as n from dated group by day, event_id) group by day),
day_out as (
  select d.day, count(*) filter (where amount > m + 3 * s or amount < m - 3 * s) as outlier_records
  from dated d join day_counts c on d.day = c.day group by d.day),
days as (
  select c.day, total_records, null_event_id, null_event_type, duplicate_records, outlier_records,
    greatest(0, least(100, 100 - (null_event_id + null_event_type) * 30 / total_records
      - duplicate_records * 20 / total_records
      - outlier_records * 10 / total_records)) as quality_score
  from day_counts c join day_dups using (day) join day_out using (day))
"""

CHECKS = {
    "null_profile": (null_profile, SHAPED + " union all ".join(map(_null_sql, _COLUMNS))),
    "duplicate_count": (
        duplicate_count,
        SHAPED
        + """select cast(sum(n - 1) as bigint) as duplicate_records
             from (select count(*) as n from shaped group by event_id)""",
    ),
    "amount_moments": (
        amount_moments,
        SHAPED
        + """select round(avg(amount), 4) as amount_mean,
             round(stddev_samp(amount), 4) as amount_std,
             round(min(amount), 4) as amount_min, round(max(amount), 4) as amount_max
             from shaped""",
    ),
    "outliers_3sigma": (
        outliers,
        SHAPED
        + """, moments as (select avg(amount) as m, stddev_samp(amount) as s from shaped)
             select count(*) as outlier_records from shaped, moments
             where amount > m + 3 * s or amount < m - 3 * s""",
    ),
    "quality_report": (
        quality_report,
        SHAPED
        + _REPORT
        + """select * replace (round(amount_mean, 4) as amount_mean,
             round(amount_std, 4) as amount_std, round(amount_min, 4) as amount_min,
             round(amount_max, 4) as amount_max, round(duplicate_share, 4) as duplicate_share,
             round(staleness_hours, 4) as staleness_hours,
             round(quality_score, 4) as quality_score) from scored""",
    ),
    "quality_score_by_day": (
        quality_score_by_day,
        SHAPED
        + _DAYS
        + "select * replace (round(quality_score, 4) as quality_score) from days",
    ),
    "quality_score_histogram": (
        quality_score_histogram,
        SHAPED
        + _DAYS
        + """select le, count(*) filter (where quality_score <= le) as bucket_count
             from days, (select unnest([0.0, 10, 20, 30, 40, 50, 60, 70, 80, 90, 100,
                                        'Infinity'::double]) as le) group by le""",
    ),
    "quality_gate": (
        quality_gate,
        SHAPED
        + _REPORT
        + """, checks as (
             select 'null_share_event_id' as check_name, null_event_id / total_records as value,
                    0.1::double as threshold from scored
             union all select 'null_share_user_id', null_user_id / total_records, 0.1 from scored
             union all select 'null_share_timestamp', null_timestamp / total_records, 0.1
               from scored
             union all select 'null_share_event_type', null_event_type / total_records, 0.1
               from scored
             union all select 'duplicate_share', duplicate_share, 0.05 from scored)
             select check_name, round(value, 6) as value, threshold, value <= threshold as passed
             from checks
             union all select 'min_rows', total_records, 1.0, total_records >= 1 from scored""",
    ),
    "row_split": (
        row_split,
        SHAPED
        + """select concat_ws(',', case when event_id is null then 'event_id' end,
               case when event_type is null then 'event_type' end,
               case when amount > 10000 then 'amount' end) as broken, count(*) as n
             from shaped group by all""",
    ),
    "table_profile": (
        table_profile,
        """select count(*) as row_count, 6 as column_count,
             'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority'
               as column_names from orders""",
    ),
    "column_profile": (
        column_profile,
        " union all ".join(
            f"select '{c}' as column_name, count(*) - count({c}) as null_count, "
            f"count(distinct {c}) as distinct_count from orders"
            for c in (
                "o_orderkey",
                "o_custkey",
                "o_orderstatus",
                "o_totalprice",
                "o_orderdate",
                "o_orderpriority",
            )
        ),
    ),
    "schema_compliance": (
        schema_compliance,
        """select 'o_orderkey' as column_name, 'ok' as issue,
                  count(*) - count(o_orderkey) as null_count from orders
           union all select 'o_custkey', 'type', count(*) - count(o_custkey) from orders
           union all select 'o_orderstatus', 'ok', count(*) - count(o_orderstatus) from orders
           union all select 'o_clerk', 'missing', -1
           union all select 'o_totalprice', 'ok', count(*) - count(o_totalprice) from orders
           union all select 'o_orderdate', 'ok', count(*) - count(o_orderdate) from orders
           union all select 'o_orderpriority', 'extra', count(*) - count(o_orderpriority)
             from orders""",
    ),
    "is_compliant": (
        compliance,
        """select 'same' as given, '' as missing, '' as extra, true as is_compliant
           union all select 'cut', 'o_custkey', '', false""",
    ),
    "scalar_stats_join": (
        stats_join,
        SHAPED
        + """select event_id, round(amount, 4) as amount,
             round((amount - avg(amount) over ()) / stddev_samp(amount) over (), 4) as z
             from shaped where amount is not null""",
    ),
    "column_roles": (
        roles,
        """select 'lang' as column_name,
             case when count(distinct lang) < 50 then 'categorical' else 'text' end as role
             from documents
           union all select 'source',
             case when count(distinct source) < 50 then 'categorical' else 'text' end
             from documents
           union all select 'text',
             case when count(distinct text) < 50 then 'categorical' else 'text' end
             from documents
           union all select 'n_chars', 'numeric'""",
    ),
    "path_probe": (
        path_probe,
        """select 'documents' as table_name, true as readable, 5 as column_count,
             count(*) as table_rows from documents
           union all select 'no_such', false, 0, 0""",
    ),
}
