"""The given tables as the data model of the library.

``events_shaped`` turns the clean ``events`` table into events with the
defects the operators deal with: null keys and types, untidy codes, repeated
rows, missing amounts, tags, properties and locations. ``SHAPED`` is the same
in SQL.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 2, 1)
AS_OF_SQL = "timestamp '2024-02-01 00:00:00'"
COUNTRIES = ("KR", "US", "DE", "FR", "JP")
KEPT = ("VIEW", "CLICK", "SIGNUP", "PURCHASE")
PATTERN = ("VIEW", "CLICK", "PURCHASE")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of its files (a glob, so it may be a file or a folder)."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def shape(events: DataFrame) -> DataFrame:
    """``events`` in the library's event schema, with defects (batch or stream)."""
    e = F.col("event_id")

    def divides(n: int, rest: int) -> Column:
        return e % n == rest

    tags = F.array_compact(
        F.array(
            F.when(divides(2, 0), "returning"),
            F.when(divides(5, 0), "vip"),
            F.when(divides(7, 0), "discount"),
        )
    )
    place = F.struct(
        F.get(F.array(*[F.lit(c) for c in COUNTRIES]), (e % 5).cast("int")).alias("country"),
        F.when(~divides(4, 1), F.concat(F.lit("city"), (e % 3).cast("string"))).alias("city"),
        (e % 180 - 90).cast("double").alias("lat"),
        (e % 360 - 180).cast("double").alias("lon"),
    )
    copies = F.when(divides(100, 3), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.withColumn("copy", F.explode(copies)).select(
        F.when(~divides(500, 13), e.cast("string")).alias("event_id"),
        "user_id",
        (F.col("ts").cast("timestamp") + F.make_dt_interval(hours=F.col("copy"))).alias(
            "timestamp"
        ),
        F.when(divides(50, 7), None)
        .when(divides(10, 4), F.concat(F.lit("  "), "event_type", F.lit(" ")))
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.when(~divides(9, 0), F.concat(F.lit("cat"), (e % 9).cast("string"))).alias("category"),
        F.when(F.col("event_type") == "purchase", F.col("value") * 50.0).alias("amount"),
        F.when(~divides(13, 0), F.from_json("props", "map<string,string>")).alias("properties"),
        F.when(~divides(11, 0), tags).alias("tags"),
        F.when(~divides(6, 0), place).alias("location"),
    )


def events_shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(table(spark, sf_dir, "events"))


def events_tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shaped events with normalised codes, repeated rows left in."""
    from clickweir.functions.columns import normalise_code

    return events_shaped(spark, sf_dir).withColumn(
        "event_type", normalise_code(F.col("event_type"))
    )


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded: sums of doubles depend on the order of addition."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else df


SHAPED = """
with base as (
  select event_id as eid,
    case when event_id % 500 <> 13 then cast(event_id as varchar) end as event_id,
    user_id, ts as "timestamp",
    case when event_id % 50 = 7 then null
         when event_id % 10 = 4 then '  ' || event_type || ' '
         else event_type end as event_type,
    case when event_id % 9 <> 0 then 'cat' || cast(event_id % 9 as varchar) end as category,
    case when event_type = 'purchase' then value * 50.0 end as amount,
    case when event_id % 13 <> 0 then props end as props,
    case when event_id % 11 <> 0
         then cast(event_id % 2 = 0 as int) + cast(event_id % 5 = 0 as int)
            + cast(event_id % 7 = 0 as int) end as tags,
    case when event_id % 6 <> 0 then ['KR','US','DE','FR','JP'][event_id % 5 + 1] end as country,
    case when event_id % 4 <> 1 then 'city' || cast(event_id % 3 as varchar) end as city
  from events),
shaped as (
  select * from base
  union all
  select * replace ("timestamp" + interval 1 hour as "timestamp") from base where eid % 100 = 3)
"""

TIDY = SHAPED + """,
tidy as (select * replace (upper(trim(event_type)) as event_type) from shaped)
"""

CLEAN = TIDY + """,
clean as (
  select * exclude (rn) replace (coalesce(category, 'UNKNOWN') as category,
                                 coalesce(amount, 0.0) as amount)
  from (select *, row_number() over (partition by event_id order by "timestamp") as rn
        from tidy where event_id is not null)
  where rn = 1)
"""

ENRICHED = CLEAN + """,
enriched as (
  select *,
    cast("timestamp" as date) as event_date,
    cast(hour("timestamp") as integer) as hour,
    dayname("timestamp") as day_of_week,
    case when amount < 100 then 'small' when amount < 1000 then 'medium'
         when amount < 10000 then 'large' else 'very_large' end as amount_category,
    coalesce(tags, 0) as tag_count,
    coalesce(len(json_keys(props)) > 0, false) as has_properties
  from clean),
kept as (select * from enriched where event_type in ('VIEW','CLICK','SIGNUP','PURCHASE'))
"""
