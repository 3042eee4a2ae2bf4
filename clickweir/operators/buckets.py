"""Tables bucketed by a key: joins without a shuffle, and a ledger of keys seen.

Bucketed tables live in the session's catalog. Their files do not need it: a table is
opened again by path in a session whose catalog does not know it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.operators.joins import merge_join


def write_bucketed(
    df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int
) -> DataFrame:
    """Write ``df`` as a table of ``buckets`` files hashed by ``keys`` and sorted in each.

    One shuffle here, once; joins and aggregates on ``keys`` need none after it.
    A key that owns a large share of the rows makes one large bucket: such
    tables are joined with ``salted_join`` instead.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def open_bucketed(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    buckets: int,
    partitions: Sequence[str] = (),
) -> DataFrame:
    """The table at ``path``, made known to the catalog under ``table`` if it is not yet."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    named = ", ".join(f"`{k}`" for k in keys)
    parts = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {parts} "
        f"CLUSTERED BY ({named}) SORTED BY ({named}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    if partitions:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def bucketed_join(
    spark: SparkSession, left: str, right: str, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Sort-merge join of two bucketed tables on their keys.

    With equal numbers of buckets neither side is shuffled; with different ones only
    the side of fewer buckets is.
    """
    return merge_join(spark.table(left), spark.table(right), on, how)


class KeyLedger:
    """Keys that earlier runs have taken, so that a copy in a later run is dropped.

    The ledger is bucketed by key and has one folder per run. ``unseen`` joins
    against it without moving it: only the new rows are shuffled, to its buckets.
    A run's own keys do not count as seen, and recording a run again replaces its
    folder, so a run can be repeated and gives the same rows. Rows without a key are
    neither recorded nor dropped. Runs that take the same keys must not overlap.
    """

    def __init__(
        self, spark: SparkSession, path: str, table: str, kind: str = "string", buckets: int = 64
    ):
        self._spark, self._table = spark, table
        schema = T.StructType().add("key", kind).add("run", "string")
        open_bucketed(spark, table, path, schema, ["key"], buckets, ["run"])
        self._buckets = buckets

    def keys(self) -> DataFrame:
        """(key, run), each key once."""
        return self._spark.table(self._table)

    def unseen(self, df: DataFrame, key: str, run: str) -> DataFrame:
        """Rows of ``df`` whose key no other run has taken."""
        others = self.keys().where(F.col("run") != run).select(F.col("key").alias("_seen"))
        on = F.col(key).cast(self.keys().schema["key"].dataType) == F.col("_seen")
        return df.join(others.hint("merge"), on, "left_anti")

    def record(self, df: DataFrame, key: str, run: str) -> int:
        """Note the keys of ``df`` as taken by ``run`` (letters, digits, ``-_.``); returns how many.

        ``df`` must be what ``unseen`` gave for this run, written down, so that what
        is recorded is what was kept.
        """
        if not re.fullmatch(r"[\w.-]+", run):
            raise ValueError(f"not a name for a run: {run!r}")
        kind = self.keys().schema["key"].dataType
        keys = df.select(F.col(key).cast(kind).alias("key")).where("key is not null").distinct()
        view = f"keys_{uuid.uuid4().hex}"
        keys.repartition(self._buckets, "key").createOrReplaceTempView(view)
        try:
            self._spark.sql(
                f"INSERT OVERWRITE TABLE {self._table} PARTITION (run = '{run}') "
                f"SELECT key FROM {view}"
            )
        finally:
            self._spark.catalog.dropTempView(view)
        return self.keys().where(F.col("run") == run).count()
