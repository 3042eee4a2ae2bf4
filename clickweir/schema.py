"""Schemas of the clickstream data model."""

from __future__ import annotations

from pyspark.sql import types as T

LOCATION = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]
)

# An event as the streams carry it: JSON in the envelope's value.
STREAM_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("user_id", T.LongType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("category", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("location", LOCATION),
    ]
)

# An event as the daily tables hold it: nullable type, plus tags.
EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("user_id", T.LongType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("event_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("location", LOCATION),
    ]
)

# The message envelope of a topic.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# One finished run of a job or operation.
RUN = T.StructType(
    [
        T.StructField("operation", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("records_processed", T.LongType()),
    ]
)

# Fixed values of the data model.
CRITICAL_COLUMNS = ("event_id", "user_id", "timestamp", "event_type")
KEPT_TYPES = ("PURCHASE", "ADD_TO_CART", "VIEW", "SEARCH")
PURCHASE_PATTERN = ("VIEW", "ADD_TO_CART", "PURCHASE")
AMOUNT_BOUNDS = (100, 1000, 10000)
AMOUNT_LABELS = ("small", "medium", "large", "very_large")
RANGE_BOUNDS = (100, 500, 1000, 5000)
RANGE_LABELS = ("0-100", "100-500", "500-1000", "1000-5000", "5000+")
DURATION_BOUNDS = (0.1, 0.5, 1, 2, 5, 10, 30, 60, 120, 300, 600)
SCORE_BOUNDS = (0, 10, 20, 30, 40, 50, 60, 70, 80, 90, 100)
