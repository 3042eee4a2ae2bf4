"""Streaming readers and the message envelope."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir import schema as schemas

CORRUPT = "_malformed"

# The JSON writer's own default stops at milliseconds.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# Defaults of the topic reader: everything there is, no rate cap, and an error
# instead of a gap where the topic has already dropped messages.
KAFKA_DEFAULTS = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "true",
    "includeHeaders": "true",
    "kafka.security.protocol": "PLAINTEXT",
}


def topic_options(servers: str, topic: str, **overrides: str) -> dict[str, str]:
    """Reader options for one topic: the defaults, changed by ``overrides``.

    A rate cap (``maxOffsetsPerTrigger``) is the caller's choice; with one, see
    that triggers come often enough to keep up with the topic.
    """
    return {
        **KAFKA_DEFAULTS,
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        **overrides,
    }


def read_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
    path: str | None = None,
) -> DataFrame:
    """A streaming frame from any source.

    ``kafka`` takes ``topic_options`` and no schema; file formats take a path
    or glob, a schema, and ``maxFilesPerTrigger`` as the rate limit.
    """
    reader = spark.readStream.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def to_envelope(df: DataFrame, key: str, ts: str = "timestamp") -> DataFrame:
    """Rows as messages: ``key``, JSON ``value`` (both binary) and ``timestamp``."""
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct("*"), {"timestampFormat": ISO_MICROS}).cast("binary").alias("value"),
        F.col(ts).alias("timestamp"),
    )


def parse_envelope(
    df: DataFrame,
    schema: T.StructType = schemas.STREAM_EVENT,
    *,
    key_name: str = "kafka_key",
    time_name: str = "kafka_timestamp",
    keep_malformed: bool = False,
) -> DataFrame:
    """Messages as typed columns, next to their key and arrival time.

    With ``keep_malformed`` the text of a value that does not fit ``schema``, or
    lacks one of its required (not nullable) fields, stays in ``_malformed`` for
    ``split_malformed``.
    """
    text = F.col("value").cast("string")
    options: dict[str, str] = {}
    required = [f.name for f in schema.fields if not f.nullable]
    if keep_malformed:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    data = F.from_json(text, schema, options)
    if keep_malformed:
        # Filters on the fields do not move below a generator, where each of them
        # would parse the message again.
        data = F.explode(F.array(data))
    parsed = df.select(
        F.col("key").cast("string").alias(key_name),
        data.alias("data"),
        text.alias("_text"),
        text.isNull().alias("_empty"),
        F.col("timestamp").alias(time_name),
    )
    columns = [F.col(key_name), F.col("data.*"), F.col(time_name)]
    if not keep_malformed:
        return parsed.select(*columns)
    lacking = F.lit(False)
    for name in required:
        lacking = lacking | F.col(f"data.{name}").isNull()
    kept = F.when(lacking & F.col(f"data.{CORRUPT}").isNull(), F.col("_text")).otherwise(
        F.col(f"data.{CORRUPT}")
    )
    parsed = parsed.withColumn("data", F.col("data").withField(CORRUPT, kept))
    return parsed.select(*columns, "_empty")


def is_malformed() -> Column:
    """Whether a row of ``parse_envelope(keep_malformed=True)`` lacks a value or does not fit."""
    return F.col(CORRUPT).isNotNull() | F.col("_empty")


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the rest: values that are missing or do not fit the schema."""
    bad = is_malformed()
    good = df.where(~bad).drop(CORRUPT, "_empty")
    return good, df.where(bad).withColumnRenamed(CORRUPT, "raw_value").drop("_empty")


def _kind_fits(kind: T.DataType, name: str) -> Column:
    """Whether the field of ``_json`` has a JSON value that the parser takes for ``kind``."""
    path = f"$.{name}"
    field = F.try_variant_get("_json", path, "variant")
    given = F.schema_of_variant(field)
    if isinstance(kind, T.IntegralType):
        return given == "BIGINT"
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return given.isin("BIGINT", "DOUBLE") | given.startswith("DECIMAL")
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return (given == "BIGINT") | F.try_variant_get("_json", path, "timestamp").isNotNull()
    if isinstance(kind, T.BooleanType):
        return given == "BOOLEAN"
    if isinstance(kind, (T.StructType, T.MapType)):
        return given.startswith("OBJECT")
    if isinstance(kind, T.ArrayType):
        return given.startswith("ARRAY")
    return F.lit(True)


def with_reason(
    rejected: DataFrame,
    schema: T.StructType = schemas.STREAM_EVENT,
    text: str = "raw_value",
) -> DataFrame:
    """``reason`` and ``field``: why a message was set aside, and the first field at fault.

    ``empty``, ``not json`` (also an array or a bare value), ``missing`` (a required
    field that is absent or null), ``type`` (a value the field's type does not take),
    or ``other`` for what lies deeper. Fields are looked at in the order of ``schema``.
    """
    judged = rejected.withColumn("_json", F.try_parse_json(text))
    found = F.lit(None).cast("struct<reason: string, field: string>")
    for field in schema.fields:
        value = F.try_variant_get("_json", f"$.{field.name}", "variant")
        absent = value.isNull() | F.coalesce(F.is_variant_null(value), F.lit(True))

        def fault(reason: str, name: str = field.name) -> Column:
            return F.struct(F.lit(reason).alias("reason"), F.lit(name).alias("field"))

        wrong = F.when(absent, F.lit(None) if field.nullable else fault("missing")).when(
            ~F.coalesce(_kind_fits(field.dataType, field.name), F.lit(False)), fault("type")
        )
        found = F.coalesce(found, wrong)
    no_field = F.lit(None).cast("string")
    whole = F.coalesce(F.schema_of_variant("_json").startswith("OBJECT"), F.lit(False))
    reason = (
        F.when(F.col(text).isNull(), F.struct(F.lit("empty").alias("reason"), no_field.alias("field")))
        .when(~whole, F.struct(F.lit("not json").alias("reason"), no_field.alias("field")))
        .otherwise(
            F.coalesce(
                found, F.struct(F.lit("other").alias("reason"), no_field.alias("field"))
            )
        )
    )
    return judged.withColumn("_found", reason).select(
        *rejected.columns,
        F.col("_found.reason").alias("reason"),
        F.col("_found.field").alias("field"),
    )


def rejected_shape(rejected: DataFrame, text: str = "raw_value") -> DataFrame:
    """One row: the common schema of all rejected messages that are JSON, and how many they are."""
    parsed = F.try_parse_json(text)
    return rejected.agg(
        F.count("*").alias("messages"),
        F.count(parsed).alias("json_messages"),
        F.schema_of_variant_agg(parsed).alias("shape"),
    )
