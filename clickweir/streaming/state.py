"""What a stream holds, read from its checkpoint: no detail is read again.

Spark's ``state-metadata`` and ``statestore`` readers give the state of a checkpoint as
tables, also of a stream that runs. Values are aggregation buffers, whose names
repeat, so they are named here by place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per stateful operator: its name, store, partitions, first and last batch."""
    return spark.read.format("state-metadata").load(checkpoint)


def stored_state(
    spark: SparkSession,
    checkpoint: str,
    operator: int = 0,
    value: str | None = None,
    batch: int | None = None,
) -> DataFrame:
    """The key and value columns of one operator's state after ``batch`` (default: the last).

    ``value`` names and types the value's fields in their order, as in
    ``"n: long, total: double"``. The operator nearest to the sink is 0.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint)
    if value:
        state = state.withColumn("value", F.col("value").cast(f"struct<{value}>"))
    return state.select("key.*", "value.*")


def state_sizes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operator, partition, keys): rows each state task holds, to find hot ones."""
    sizes = None
    for row in state_operators(spark, checkpoint).select("operatorId").distinct().collect():
        operator = row["operatorId"]
        found = (
            spark.read.format("statestore")
            .option("operatorId", operator)
            .load(checkpoint)
            .groupBy(F.col("partition_id").alias("partition"))
            .agg(F.count("*").alias("keys"))
            .select(F.lit(operator).alias("operator"), "partition", "keys")
        )
        sizes = found if sizes is None else sizes.unionByName(found)
    if sizes is None:
        return spark.createDataFrame([], "operator long, partition int, keys long")
    return sizes


def open_windows(
    spark: SparkSession,
    checkpoint: str,
    keys: Sequence[str] = ("event_type", "category"),
    user: str = "user_id",
    batch: int | None = None,
) -> DataFrame:
    """The windows a ``window_agg`` stream has not written yet, as they stand.

    With what its sink holds they are all windows of the events it has taken. A
    window is first kept per user (operator 1) and, once closed, by its keys
    (operator 0) until it is written; it is in one of the two.
    """
    per_user = stored_state(
        spark,
        checkpoint,
        1,
        "events: long, amount_sum: double, amount_n: long, amount_max: double",
        batch,
    )
    closing = stored_state(
        spark,
        checkpoint,
        0,
        "events: long, amount_sum: double, amount_n: long, amount_max: double, users: long",
        batch,
    )
    columns = ["window", *keys, "events", "amount_sum", "amount_n", "amount_max", "users"]
    known = F.when(F.col(user).isNotNull(), 1).otherwise(0).cast("long")
    rows = per_user.withColumn("users", known).select(*columns).unionByName(closing.select(*columns))
    merged = rows.groupBy("window", *keys).agg(
        F.sum("events").alias("event_count"),
        F.sum("amount_sum").alias("total_amount"),
        F.try_divide(F.sum("amount_sum"), F.sum("amount_n")).alias("avg_amount"),
        F.max("amount_max").alias("max_amount"),
        F.sum("users").alias("unique_users"),
    )
    return merged.withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    ).drop("window")
