"""Batch readers."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir import schema as schemas


def read_events(
    spark: SparkSession,
    base: str,
    *,
    dates: Sequence[str] | None = None,
    schema: T.StructType | None = schemas.EVENT,
    fmt: str = "parquet",
) -> DataFrame:
    """Events below ``base``, one directory ``date=...`` per day.

    Reads the base and filters on ``date``: only the directories of ``dates``
    are listed and scanned, and ``date`` stays a column.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        fields = list(schema.fields)
        if "date" not in schema.names:
            fields.append(T.StructField("date", T.DateType()))
        reader = reader.schema(T.StructType(fields))
    df = reader.load(base)
    if dates is not None:
        df = df.where(F.col("date").isin(*[F.lit(d).cast("date") for d in dates]))
    return df


def read_days(spark: SparkSession, base: str, pattern: str = "date=*") -> DataFrame:
    """Days whose directory matches ``pattern``, with ``date`` kept as a column."""
    return (
        spark.read.option("basePath", base).parquet(f"{base.rstrip('/')}/{pattern}")
    )


def read_merged(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet tables whose schemas may differ, united by column name."""
    tables = [
        spark.read.option("mergeSchema", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(path)
        for path in paths
    ]
    return union_by_name(tables)


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of ``tables``; a column a table lacks is null in its rows."""
    united = tables[0]
    for table in tables[1:]:
        united = united.unionByName(table, allowMissingColumns=True)
    return united


def read_permissive(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file below ``path`` that can be read; broken or vanished ones are skipped."""
    return (
        spark.read.option("mergeSchema", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
        .parquet(path)
    )


def skipped_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """``(file, bytes)`` of the files below ``path`` that ``read_permissive`` takes no row from.

    The listing less the files that rows came from; a file without rows is in it too.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    )
    read = read_permissive(spark, path).select(F.col("_metadata.file_path").alias("read")).distinct()
    tail = "[^:]*:/*"  # the two sides may write the scheme in different ways
    same = F.regexp_replace("file", f"^{tail}", "/") == F.regexp_replace("read", f"^{tail}", "/")
    return listed.join(read, same, "left_anti")


def read_training(spark: SparkSession, train: str, test: str, fallback: str) -> DataFrame:
    """Train and test tables united; where one cannot be read, whatever ``fallback`` holds."""
    probe = probe_paths(spark, [train, test])
    if probe.where("not readable").isEmpty():
        return read_merged(spark, [train, test])
    return read_permissive(spark, fallback)


def probe_paths(spark: SparkSession, paths: Sequence[str], at_once: int = 16) -> DataFrame:
    """One row per path: readable, number of columns, has data, and the error if any.

    Several paths are probed at a time (``at_once``); each reads a footer and at most one row.
    """

    def probe(path: str) -> tuple:
        try:
            df = spark.read.parquet(path)
            return path, True, len(df.columns), not df.limit(1).isEmpty(), None
        except Exception as error:
            return path, False, None, None, str(error).splitlines()[0]

    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(probe), paths))
    return spark.createDataFrame(
        rows,
        "path string, readable boolean, column_count int, has_data boolean, error string",
    )


def count_by(spark: SparkSession, df: DataFrame, column: str, view: str = "events") -> DataFrame:
    """Rows per ``column`` through a temporary view and SQL."""
    df.createOrReplaceTempView(view)
    return spark.sql(
        "SELECT identifier(:c) AS value, count(*) AS n FROM identifier(:v) GROUP BY identifier(:c)",
        args={"c": column, "v": view},
    ).withColumnRenamed("value", column)
