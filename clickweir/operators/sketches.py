"""Stored sketches: quantiles and distinct users of any range without its detail.

A table has one row per group and grain (hour, day) with a mergeable sketch of its
values. A question about any range reads those rows, merges them and answers from the
result, so its cost follows the number of groups and not that of events. Sketches are
of a fixed size and are folded in the map tasks, so a hot group is no hot task.

* Quantiles (KLL): a value whose rank differs from the one asked for by at most
  ``rank_error(k)`` of the rows (99 of 100 times; 0.0133 at ``k = 200``, however
  many sketches were merged).
* Distinct users (theta): ``count_error(lg)`` is the relative standard deviation
  (0.0156 at ``lg = 12``). Up to ``2 ** lg`` users a sketch is exact. Of an intersection or a
  difference it is relative to the union.

Nulls are not counted, neither values nor users. A range without rows gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KLL_K, THETA_LG = 200, 12


def rank_error(k: int = KLL_K) -> float:
    """The normalised rank error of one quantile, as the authors of the sketch fitted it."""
    return 2.296 / k**0.9723


def count_error(lg: int = THETA_LG) -> float:
    return 2 ** (-lg / 2)


def _slot(ts: str, grain: str) -> Column:
    return F.date_trunc(grain, F.col(ts))


def value_sketches(
    df: DataFrame,
    value: str,
    by: Sequence[str] = ("operation",),
    ts: str = "start_time",
    grain: str = "hour",
    k: int = KLL_K,
) -> DataFrame:
    """(by..., slot, values, sketch): one quantile sketch of ``value`` per group and grain."""
    number = F.col(value).cast("double")
    return (
        df.where(number.isNotNull())
        .groupBy(*by, _slot(ts, grain).alias("slot"))
        .agg(F.count("*").alias("values"), F.kll_sketch_agg_double(number, k).alias("sketch"))
    )


def _between(table: DataFrame, since: object, until: object) -> DataFrame:
    """Rows whose slot is in [since, until)."""
    if since is not None:
        table = table.where(F.col("slot") >= F.lit(since))
    if until is not None:
        table = table.where(F.col("slot") < F.lit(until))
    return table


def quantiles(
    table: DataFrame,
    shares: Sequence[float] = (0.5, 0.95, 0.99),
    by: Sequence[str] = ("operation",),
    since: object = None,
    until: object = None,
    k: int = KLL_K,
) -> DataFrame:
    """(by..., values, share, quantile) over the slots in [since, until)."""
    merged = _between(table, since, until).groupBy(*by).agg(
        F.sum("values").alias("values"), F.kll_merge_agg_double("sketch", k).alias("sketch")
    )
    answers = F.array(
        *[
            F.struct(
                F.lit(float(share)).alias("share"),
                F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))).alias("quantile"),
            )
            for share in shares
        ]
    )
    return merged.select(*by, "values", F.inline(answers))


def share_below(
    table: DataFrame,
    bound: float,
    by: Sequence[str] = ("operation",),
    since: object = None,
    until: object = None,
    k: int = KLL_K,
) -> DataFrame:
    """(by..., values, share): the share of values up to ``bound``."""
    merged = _between(table, since, until).groupBy(*by).agg(
        F.sum("values").alias("values"), F.kll_merge_agg_double("sketch", k).alias("sketch")
    )
    share = F.kll_sketch_get_rank_double("sketch", F.lit(float(bound)))
    return merged.select(*by, "values", share.alias("share"))


def user_sketches(
    df: DataFrame,
    by: Sequence[str] = ("event_type",),
    user: str = "user_id",
    ts: str = "timestamp",
    grain: str = "day",
    lg: int = THETA_LG,
) -> DataFrame:
    """(by..., slot, events, sketch): one sketch of the distinct users per group and grain."""
    return df.groupBy(*by, _slot(ts, grain).alias("slot")).agg(
        F.count("*").alias("events"),
        F.theta_sketch_agg(F.col(user).cast("string"), lg).alias("sketch"),
    )


def distinct_users(
    table: DataFrame,
    by: Sequence[str] = (),
    since: object = None,
    until: object = None,
    lg: int = THETA_LG,
) -> DataFrame:
    """(by..., events, users) over the slots in [since, until)."""
    return (
        _between(table, since, until)
        .groupBy(*by)
        .agg(F.sum("events").alias("events"), F.theta_union_agg("sketch", lg).alias("sketch"))
        .select(*by, "events", F.theta_sketch_estimate("sketch").alias("users"))
    )


def returning_users(
    table: DataFrame, by: Sequence[str] = (), lg: int = THETA_LG
) -> DataFrame:
    """Per slot: its users, those of the slot before as well, those new since, those gone.

    (by..., slot, users, returning, new, gone); the slot before is the last one with
    rows. The window runs over the slots of one group.
    """
    per_slot = table.groupBy(*by, "slot").agg(F.theta_union_agg("sketch", lg).alias("sketch"))
    before = F.lag("sketch").over(Window.partitionBy(*by).orderBy("slot"))

    def count(sketch: Column) -> Column:
        return F.theta_sketch_estimate(sketch)

    both = per_slot.withColumn("before", before)
    first = F.col("before").isNull()
    zero = F.lit(0).cast("long")
    return both.select(
        *by,
        "slot",
        count(F.col("sketch")).alias("users"),
        F.when(first, zero)
        .otherwise(count(F.theta_intersection("sketch", "before")))
        .alias("returning"),
        F.when(first, count(F.col("sketch")))
        .otherwise(count(F.theta_difference("sketch", "before")))
        .alias("new"),
        F.when(first, zero).otherwise(count(F.theta_difference("before", "sketch"))).alias("gone"),
    )
