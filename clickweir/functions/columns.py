"""Column expressions. All stay in built-in functions, so they pipeline into
whole-stage code generation next to the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def label_range(
    value: Column,
    bounds: Sequence[float],
    labels: Sequence[str],
    null_label: str | None = None,
) -> Column:
    """Name of the range ``value`` falls in; ``labels`` has one more entry than ``bounds``.

    Bounds are exclusive upper limits. A null value gets ``null_label`` and
    never falls through to the highest range.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one label more than bounds")
    picked = F.when(value.isNull(), F.lit(null_label))
    for bound, label in zip(bounds, labels):
        picked = picked.when(value < bound, label)
    return picked.otherwise(labels[-1])


def normalise_code(value: Column) -> Column:
    """A code in its canonical spelling: no surrounding blanks, upper case."""
    return F.upper(F.trim(value))


def size_or_zero(value: Column) -> Column:
    """Entries in an array or map, 0 for null."""
    return F.coalesce(F.size(value), F.lit(0))


def has_entries(value: Column) -> Column:
    """True for a non-empty array or map, false for an empty one or null."""
    return size_or_zero(value) > 0


def place_text(location: Column) -> Column:
    """``city, country`` of a location struct with stand-ins for missing parts."""
    city = F.coalesce(location["city"], F.lit("Unknown"))
    country = F.coalesce(location["country"], F.lit("Unknown"))
    return F.when(location.isNotNull(), F.concat_ws(", ", city, country)).otherwise(
        "Unknown Location"
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, 0.0 unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end`` with microseconds as the fraction."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def switch_scheme(path: Column, source: str = "s3", target: str = "s3a") -> Column:
    """``path`` with the leading ``source://`` replaced by ``target://``."""
    return F.regexp_replace(path, f"^{source}://", f"{target}://")


def is_bucket_path(path: Column, schemes: Sequence[str] = ("s3", "s3a")) -> Column:
    """True when ``path`` is ``scheme://bucket/...`` with a well-formed bucket name."""
    allowed = "|".join(schemes)
    return path.rlike(f"^({allowed})://[a-z0-9][a-z0-9\\-]*[a-z0-9]/")


def hash_bucket(columns: Sequence[Column], buckets: int) -> Column:
    """A bucket in ``[0, buckets)`` that depends only on the values.

    Unlike a random draw it survives re-runs of a task and any re-partitioning.
    """
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def holds_map(kind: T.DataType) -> bool:
    """Whether values of a type are or contain maps, which Spark neither hashes nor sorts."""
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return holds_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(holds_map(f.dataType) for f in kind.fields)


def hashable(df_field: T.StructField, column: Column) -> Column:
    """``column`` in a form Spark can hash: what contains maps becomes text."""
    return F.to_json(F.struct(column)) if holds_map(df_field.dataType) else column


def orderable(df_field, column: Column) -> Column:
    """``column`` in a form Spark can sort by: maps become sorted entry lists."""
    if isinstance(df_field.dataType, T.MapType) and not holds_map(df_field.dataType.valueType):
        return F.sort_array(F.map_entries(column))
    return hashable(df_field, column)
