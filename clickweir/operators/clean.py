"""Cleaning and enrichment of events (batch or stream)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir import schema
from clickweir.functions.columns import (
    has_entries,
    label_range,
    normalise_code,
    orderable,
    place_text,
    size_or_zero,
)


def dedup(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the first by ``order``, ties broken by all other columns.

    The ``= 1`` filter lets Spark cut each key to one row inside every map task
    before the shuffle, so a key with very many copies stays cheap.
    """
    first = [F.col(name) for name in order]
    rest = [
        orderable(field, F.col(field.name))
        for field in df.schema.fields
        if field.name not in order and field.name not in key
    ]
    ranked = Window.partitionBy(*key).orderBy(*first, *rest)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def dedup_stream(df: DataFrame, key: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First arrival per ``key`` on a stream; state is dropped ``delay`` after the event."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def dedup_parsed(
    df: DataFrame, malformed: Column, key: Sequence[str], ts: str, delay: str
) -> DataFrame:
    """``dedup_stream`` that lets every ``malformed`` row through, in the same pass.

    Such a row gets a key of its own and no event time: it moves no watermark, is
    never late, and its state goes with the next batch. A re-run task may draw
    another key, which changes nothing that leaves this function.
    """
    own = F.when(malformed, F.uuid())
    marked = df.withColumns(
        {
            "_own": own,
            "_at": F.when(~malformed, F.col(ts)),
            **{f"_key_{i}": F.when(~malformed, F.col(name)) for i, name in enumerate(key)},
        }
    )
    once = dedup_stream(marked, ["_own", *[f"_key_{i}" for i in range(len(key))]], "_at", delay)
    return once.select(*df.columns)


def clean_events(
    df: DataFrame,
    *,
    key: str = "event_id",
    order: Sequence[str] = ("timestamp",),
    fill_category: str = "UNKNOWN",
    fill_amount: float = 0.0,
    delay: str = "10 minutes",
) -> DataFrame:
    """Drop rows without a key, keep one row per key, normalise and fill columns."""
    keyed = df.where(F.col(key).isNotNull())
    if df.isStreaming:
        unique = dedup_stream(keyed, [key], order[0], delay)
    else:
        unique = dedup(keyed, [key], order)
    return unique.withColumns(
        {
            "event_type": normalise_code(F.col("event_type")),
            "category": F.coalesce("category", F.lit(fill_category)),
            "amount": F.coalesce("amount", F.lit(fill_amount)),
        }
    )


def enrich_events(
    df: DataFrame,
    *,
    bounds: Sequence[float] = schema.AMOUNT_BOUNDS,
    labels: Sequence[str] = schema.AMOUNT_LABELS,
    null_label: str | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Calendar parts, amount bucket, tag count and property flag of each event.

    ``as_of`` stamps the rows; without it the current time does.
    """
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return df.withColumns(
        {
            "processed_date": F.to_date(stamp),
            "processed_timestamp": stamp,
            "event_date": F.to_date("timestamp"),
            "hour": F.hour("timestamp"),
            "day_of_week": F.date_format("timestamp", "EEEE"),
            "amount_category": label_range(F.col("amount"), bounds, labels, null_label),
            "tag_count": size_or_zero(F.col("tags")),
            "has_properties": has_entries(F.col("properties")),
        }
    )


def enrich_stream(
    df: DataFrame,
    *,
    bounds: Sequence[float] = schema.RANGE_BOUNDS,
    labels: Sequence[str] = schema.RANGE_LABELS,
    null_label: str = "unknown",
    as_of: datetime | None = None,
) -> DataFrame:
    """Per-event columns of the detail stream; works on a batch table too."""
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return df.withColumns(
        {
            "processing_timestamp": stamp,
            "event_date": F.date_format("timestamp", "yyyy-MM-dd"),
            "event_hour": F.hour("timestamp"),
            "event_minute": F.minute("timestamp"),
            "amount_range": label_range(F.col("amount"), bounds, labels, null_label),
            "location_info": place_text(F.col("location")),
        }
    )


def keep_types(df: DataFrame, types: Sequence[str] = schema.KEPT_TYPES) -> DataFrame:
    """Rows whose type is listed; null types go too."""
    return df.where(F.col("event_type").isin(*types))


def drop_sensitive(
    df: DataFrame, text: str, words: Sequence[str] = ("password", "secret", "token")
) -> DataFrame:
    """Rows whose text holds none of ``words`` (case-sensitive); null text is kept."""
    hit = F.lit(False)
    for word in words:
        hit = hit | F.col(text).contains(word)
    return df.where(~F.coalesce(hit, F.lit(False)))


def prepare_day(
    df: DataFrame,
    *,
    types: Sequence[str] = schema.KEPT_TYPES,
    as_of: datetime | None = None,
) -> DataFrame:
    """Clean, enrich and filter one batch of events.

    The type filter needs the survivor of each key, so it stays behind the
    de-duplication; everything else rides along in the same stage.
    """
    return keep_types(enrich_events(clean_events(df), as_of=as_of), types)
