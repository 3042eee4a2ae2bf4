"""The jobs as a whole, and properties of the files they write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.tables import AS_OF, KEPT, TIDY, events_shaped, table
from clickweir.operators import clean, layout
from clickweir.plans.batch import run_day
from clickweir.sources import batch
from clickweir.workspace import shared_dir

DAY, EMPTY_DAY = "2024-01-03", "2030-01-01"


def daily_job(spark: SparkSession, d: str) -> DataFrame:
    """A day with events and one without, run twice: rows of every output."""
    source, target = shared_dir(spark, "days"), shared_dir(spark, "daily")
    events = events_shaped(spark, d).withColumn("date", F.to_date("timestamp"))
    layout.write_partitioned(events, source, ["date"])
    reports = None
    for date in (DAY, DAY, EMPTY_DAY):
        report = run_day(spark, source, target, date, types=KEPT, as_of=AS_OF)
        reports = report if reports is None else reports.unionByName(report)
    by_date = reports.distinct()
    for name in ("quality", "runs"):
        stored = spark.read.parquet(f"{target}/{name}").groupBy(
            F.col("date").cast("string").alias("date")
        )
        by_date = by_date.join(stored.agg(F.count("*").alias(f"{name}_rows")), "date", "left")
    return by_date


def sorted_order(spark: SparkSession, d: str) -> DataFrame:
    """Rows that stand before a smaller one of their partition: none."""
    rows = clean.prepare_day(events_shaped(spark, d), types=KEPT, as_of=AS_OF)
    rows = layout.sorted_within(layout.rebalance_by(rows, ["hour", "event_type"]), ["hour", "event_type"])
    placed = rows.select(
        F.struct("hour", "event_type").alias("k"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("at"),
    )
    before = F.lag("k").over(Window.partitionBy("part").orderBy("at"))
    return placed.select("k", before.alias("before")).agg(
        F.count("*").alias("n"), F.count_if(F.col("before") > F.col("k")).alias("wrong")
    )


def _files(spark, path, column):
    """Rows, range and bytes of every file of a table."""
    meta = F.col("_metadata")
    return (
        spark.read.parquet(path)
        .select(column, meta["file_path"].alias("file"), meta["file_size"].alias("bytes"))
        .groupBy("file")
        .agg(
            F.min(column).alias("least"),
            F.max(column).alias("most"),
            F.max("bytes").alias("bytes"),
            F.count("*").alias("n"),
        )
    )


def file_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Clustered files cover ranges that at most touch."""
    path = shared_dir(spark, "clustered")
    layout.cluster_table(
        spark, f"{d}/orders.parquet", path, ["o_orderdate", "o_orderkey"], target_mb=1
    )
    before = F.lag("most").over(Window.orderBy("least", "most"))
    return (
        _files(spark, path, "o_orderdate")
        .withColumn("before", before)
        .agg(
            F.sum("n").alias("n"),
            F.count_if(F.col("least") < F.col("before")).alias("overlapping"),
        )
    )


def interleaved_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Interleaved by two columns, files are narrow in both: a mean share of each range."""
    path = shared_dir(spark, "interleaved")
    source = shared_dir(spark, "lines")
    columns = ["l_orderkey", "l_partkey"]
    table(spark, d, "lineitem").select(*columns, "l_linenumber").write.parquet(source)
    one = layout.table_bytes(spark, source)
    # Sixteen files, whatever the size of the table.
    layout.cluster_table(
        spark, source, path, columns, target_mb=one / 16 / 1024 / 1024, interleave=True
    )
    narrow = None
    for column in columns:
        ends = table(spark, d, "lineitem").agg((F.max(column) - F.min(column)).alias("w")).scalar()
        found = _files(spark, path, column).agg(
            F.sum("n").alias("n"), (F.avg(F.col("most") - F.col("least")) < 0.5 * ends).alias("narrow")
        )
        narrow = found if narrow is None else narrow.unionByName(found)
    return narrow.agg(F.max("n").alias("n"), F.every("narrow").alias("narrow"))


def file_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Compacted by a column to a target of 1 MB: no file is far above it."""
    source, target = shared_dir(spark, "small-files"), shared_dir(spark, "compacted")
    table(spark, d, "lineitem").repartition(32).write.parquet(source)
    layout.compact(spark, source, target, target_mb=1, by=["l_returnflag"])
    return _files(spark, target, "l_orderkey").agg(
        F.sum("n").alias("n"), (F.max("bytes") <= 2 * 1024 * 1024).alias("within")
    )


def skipped(spark: SparkSession, d: str) -> DataFrame:
    """A folder with a file that is no Parquet: what is read, and what is skipped."""
    path = shared_dir(spark, "partly-broken")
    table(spark, d, "customer").select("c_custkey").coalesce(1).write.parquet(path)
    broken = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/broken.parquet")
    out = broken.getFileSystem(spark._jsc.hadoopConfiguration()).create(broken, False)
    out.write(bytearray(b"not a table"))
    out.close()
    read = batch.read_permissive(spark, path).agg(F.count("*").alias("n"))
    gone = batch.skipped_files(spark, path).agg(
        F.count("*").alias("skipped_files"), F.sum("bytes").alias("skipped_bytes")
    )
    return read.select(
        "n",
        gone.select("skipped_files").scalar().alias("skipped_files"),
        gone.select("skipped_bytes").scalar().alias("skipped_bytes"),
    )


CHECKS = {
    "daily_job": (
        daily_job,
        TIDY
        + f""", day as (
             select * from tidy where cast("timestamp" as date) = date '{DAY}'),
           unique_events as (
             select * exclude (rn) replace (coalesce(amount, 0.0) as amount)
             from (select *, row_number() over (partition by event_id order by "timestamp") as rn
                   from day where event_id is not null) where rn = 1),
           kept as (
             select *, hour("timestamp") as h,
               case when amount < 100 then 'small' when amount < 1000 then 'medium'
                    when amount < 10000 then 'large' else 'very_large' end as size
             from unique_events where event_type in ('VIEW', 'CLICK', 'SIGNUP', 'PURCHASE'))
           select '{DAY}' as date, count(*) as detail_rows,
             count(distinct (h, event_type, size)) as summary_rows,
             count(distinct (event_type, size)) as rollup_rows, 1 as quality_rows, 1 as runs_rows
           from kept
           union all select '{EMPTY_DAY}', 0, 0, 0, 1, 1""",
    ),
    "sorted_order": (
        sorted_order,
        TIDY
        + """select count(distinct event_id) as n, 0 as wrong from (
               select *, row_number() over (partition by event_id order by "timestamp") as rn
               from tidy where event_id is not null)
             where rn = 1 and event_type in ('VIEW', 'CLICK', 'SIGNUP', 'PURCHASE')""",
    ),
    "file_ranges": (file_ranges, "select count(*) as n, 0 as overlapping from orders"),
    "interleaved_ranges": (
        interleaved_ranges,
        "select count(*) as n, true as narrow from lineitem",
    ),
    "file_sizes": (file_sizes, "select count(*) as n, true as within from lineitem"),
    "skipped_files": (
        skipped,
        "select count(*) as n, 1 as skipped_files, 11 as skipped_bytes from customer",
    ),
}
