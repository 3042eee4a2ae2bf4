"""Joins that hold up under skew, and broadcasts behind a size check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.functions.columns import hash_bucket, hashable

# What a side may have to be broadcast. Rows are checked first, since a count
# is nearly free; then bytes, since rows may be wide.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 100 * 1024 * 1024


def _width(name: str, kind: T.DataType) -> Column:
    """Bytes a value takes: its own length, or 16 for the fixed-size types."""
    value = F.col(name)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value) + 16
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(value))) + 16
    else:
        size = F.lit(16)
    return F.coalesce(size, F.lit(16)).cast("long")


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``df`` is within both bounds: rows and bytes from one aggregate."""
    widths = [_width(f.name, f.dataType) for f in df.schema.fields]
    rows, size = df.agg(F.count("*"), F.sum(sum(widths, F.lit(0).cast("long")))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a side that is expected to be small, and check that it is.

    Within the bounds of ``fits_broadcast`` the lookup is broadcast and ``df``
    is not shuffled; beyond them this is a sort-merge join that adaptive
    execution splits under skew.
    """
    if fits_broadcast(lookup, max_rows, max_bytes):
        lookup = F.broadcast(lookup)
    else:
        lookup = lookup.hint("merge")
    return df.join(lookup, list(on), how)


def star_join(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, Sequence[str]]],
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join a fact table to each ``(dimension, key columns)`` in turn."""
    for dim, on in dims:
        fact = lookup_join(fact, dim, on, max_rows=max_rows)
    return fact


def merge_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Sort-merge join of two large tables on the same keys."""
    return left.join(right.hint("merge"), list(on), how)


def hot_keys(df: DataFrame, on: Sequence[str], share: float) -> DataFrame:
    """Keys that hold more than ``share`` of all rows, with their row count.

    At most ``1 / share`` keys can qualify, so the result has a fixed size
    bound. Counting pre-aggregates in the map tasks, however hot the key.
    """
    counts = df.groupBy(*on).agg(F.count("*").alias("key_rows"))
    total = df.agg(F.count("*")).scalar()
    return counts.where(F.col("key_rows") > F.lit(share) * total)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    salts: int = 32,
    share: float = 0.001,
    spread_by: Sequence[str] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner join that spreads the hot keys of ``left`` over ``salts`` tasks.

    Rows of a hot key get a salt from a hash of ``spread_by`` (default: the
    other columns, so give a row id where many rows are equal); the matching
    right rows are repeated once per salt. All other keys join as they are,
    with salt 0. A hash and no random draw, so a re-run task sends every row
    the same way. ``hot`` may bring keys that are known to be hot; it must hold
    each once, and at most ``1 / share`` of them.
    """
    keys = list(on)
    others = list(spread_by or [c for c in left.columns if c not in keys])
    spread = [hashable(left.schema[c], F.col(c)) for c in others]
    if hot is None:  # at most 1 / share keys
        hot = F.broadcast(hot_keys(left, keys, share).select(*keys, F.lit(True).alias("_hot")))
    else:
        hot = hot.select(*keys, F.lit(True).alias("_hot"))
        if not fits_broadcast(hot, max_rows=round(1 / share)):
            raise ValueError("more keys are given as hot than a share of the rows allows")
        hot = F.broadcast(hot)
    salted_left = (
        left.join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_hot"), hash_bucket(spread, salts)).otherwise(0),
        )
        .drop("_hot")
    )
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_right = (
        right.join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.explode(F.when(F.col("_hot"), every_salt).otherwise(F.array(F.lit(0)))),
        )
        .drop("_hot")
    )
    return merge_join(salted_left, salted_right, [*keys, "_salt"]).drop("_salt")


def with_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each row with the mean and sample deviation of ``columns`` over the whole table.

    The statistics are one scalar subquery inside the plan: no round trip
    through the driver program and no join.
    """
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_samp(c).alias(f"{c}_std") for c in columns],
        )
    ).scalar()
    return df.withColumns(
        {
            f"{c}_{part}": stats.getField(f"{c}_{part}")
            for c in columns
            for part in ("mean", "std")
        }
    )
