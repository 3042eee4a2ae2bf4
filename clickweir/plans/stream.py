"""The streaming jobs: event outputs, user patterns, scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickweir import schema
from clickweir.ml.scoring import reply, required_columns
from clickweir.operators import alerts, clean, windows
from clickweir.sources.stream import is_malformed, parse_envelope, split_malformed
from clickweir.streaming.run import Sink, fan_out, start_all, upsert_batch


def event_sinks(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    alert_threshold: float = 10000,
    delay: str = "10 minutes",
    every: dict[str, str | None] | None = None,
) -> list[Sink]:
    """Window aggregates, enriched details, high-value alerts and rejected messages.

    ``every`` maps an output to its trigger interval; by default all are None,
    that is: take what is there and stop. Repeated messages (same event id)
    within ``delay`` count once in every output.
    """
    every = every or {}
    good, bad = split_malformed(parse_envelope(messages, keep_malformed=True))
    good = clean.dedup_stream(good, ["event_id"], "timestamp", delay)
    outputs = {
        "aggregations": (windows.window_agg(good, delay=None), fmt, ()),
        "details": (clean.enrich_stream(good), fmt, ("event_date", "event_hour")),
        "alerts": (alerts.high_value(good, alert_threshold), "json", ()),
        "rejected": (bad, "json", ()),
    }
    return [
        Sink(
            name=name,
            df=df,
            fmt=sink_fmt,
            path=f"{target}/{name}",
            checkpoint=f"{checkpoint}/{name}",
            partition_by=partition_by,
            trigger=every.get(name),
        )
        for name, (df, sink_fmt, partition_by) in outputs.items()
    ]


def shared_sinks(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    alert_threshold: float = 10000,
    delay: str = "10 minutes",
    trigger: str | None = None,
    aggregate_trigger: str | None = None,
) -> list[Sink]:
    """The outputs of ``event_sinks`` from two reads of the source instead of four.

    Details, alerts and rejected messages come from one stream that reads, parses and
    drops repeated messages once; they have one trigger and one folder per batch.
    Window aggregates stay a stream of their own.
    """
    parsed = parse_envelope(messages, keep_malformed=True)
    good, _ = split_malformed(parsed)
    good = clean.dedup_stream(good, ["event_id"], "timestamp", delay)
    folder = f"{checkpoint}/events"

    def part(take: int, shape: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        return lambda batch: shape(split_malformed(batch)[take])

    outputs = {
        "details": part(0, clean.enrich_stream),
        "alerts": part(0, lambda df: alerts.high_value(df, alert_threshold)),
        "rejected": part(1, lambda df: df),
    }
    write = fan_out(
        outputs,
        f"{target}/events",
        folder,
        fmt,
        formats={"alerts": "json", "rejected": "json"},
        partition_by={"details": ("event_date", "event_hour")},
    )
    once = clean.dedup_parsed(parsed, is_malformed(), ["event_id"], "timestamp", delay)
    return [
        Sink(name="events", df=once, checkpoint=folder, batch=write, trigger=trigger),
        Sink(
            name="aggregations",
            df=windows.window_agg(good, delay=None),
            fmt=fmt,
            path=f"{target}/aggregations",
            checkpoint=f"{checkpoint}/aggregations",
            trigger=aggregate_trigger,
        ),
    ]


# Fixed trigger intervals of the running service.
SERVICE_TRIGGERS = {
    "aggregations": "30 seconds",
    "details": "10 seconds",
    "alerts": "5 seconds",
    "rejected": "10 seconds",
}


def start_event_streams(
    messages: DataFrame, target: str, checkpoint: str, **options
) -> list[StreamingQuery]:
    """Start all outputs of ``event_sinks``."""
    return start_all(event_sinks(messages, target, checkpoint, **options))


def start_pattern_stream(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    *,
    pattern: Sequence[str] = schema.PURCHASE_PATTERN,
    duration: str = "20 minutes",
    slide: str = "5 minutes",
    trigger: str | None = None,
) -> list[StreamingQuery]:
    """User windows that hold the purchase pattern, upserted per user and window.

    Malformed messages go to ``rejected`` beside them.

    Update mode reports a match as soon as it is there and again when its
    figures change; ``read_latest`` on ``(user_id, window_start)`` gives the
    current state.
    """
    good, bad = split_malformed(parse_envelope(messages, keep_malformed=True))
    spans = windows.user_windows(good, duration=duration, slide=slide, types=pattern)
    return start_all(
        [
            Sink(
                name="patterns",
                df=windows.match_all(spans, pattern),
                checkpoint=f"{checkpoint}/patterns",
                mode="update",
                batch=upsert_batch(f"{target}/patterns", f"{checkpoint}/patterns"),
                trigger=trigger,
            ),
            Sink(
                name="pattern_rejects",
                df=bad,
                checkpoint=f"{checkpoint}/pattern_rejects",
                fmt="json",
                path=f"{target}/rejected",
                trigger=trigger,
            ),
        ]
    )


def split_requests(
    messages: DataFrame, model: PipelineModel, request_schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Requests the model can score, and the rest with the reason.

    A model skips rows with a null in a column it needs as it is (categories may
    be null: an unknown one has an index of its own). Every request is in
    exactly one of the two, so each gets an answer or a rejection.
    """
    parsed = parse_envelope(
        messages, request_schema, key_name="request_id", keep_malformed=True
    )
    good, bad = split_malformed(parsed)
    needed = [F.col(c) for c in required_columns(model) if c in request_schema.names]
    incomplete = F.lit(False)
    for column in needed:
        incomplete = incomplete | column.isNull()
    rejected = bad.select(
        "request_id",
        F.when(F.col("raw_value").isNull(), "empty").otherwise("malformed").alias("reason"),
    ).unionByName(
        good.where(incomplete).select("request_id", F.lit("missing feature").alias("reason"))
    )
    return good.where(~incomplete), rejected


def score_messages(
    messages: DataFrame, model: PipelineModel, request_schema: T.StructType
) -> DataFrame:
    """Scored requests as ``key, value`` messages (batch or stream)."""
    requests, _ = split_requests(messages, model, request_schema)
    return reply(model.transform(requests.drop("kafka_timestamp")), F.current_timestamp())


def reject_messages(
    messages: DataFrame, model: PipelineModel, request_schema: T.StructType
) -> DataFrame:
    """The requests ``score_messages`` does not answer, as ``key, value`` messages."""
    _, rejected = split_requests(messages, model, request_schema)
    value = F.to_json(F.struct("request_id", "reason")).alias("value")
    return rejected.select(F.col("request_id").alias("key"), value)


def start_scoring_stream(
    messages: DataFrame,
    model: PipelineModel,
    request_schema: T.StructType,
    sink_path: str | None,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    trigger: str | None = None,
    reject_options: dict[str, str] | None = None,
) -> list[StreamingQuery]:
    """Score requests as they come; ``fmt="kafka"`` with a topic option replies to a topic.

    Requests that cannot be scored go to ``<sink_path>_rejected``, or to the
    topic in ``reject_options``.
    """
    outputs = {
        "scores": (score_messages, sink_path, options),
        "score_rejects": (reject_messages, sink_path and f"{sink_path}_rejected", reject_options),
    }
    return start_all(
        [
            Sink(
                name=name,
                df=shape(messages, model, request_schema),
                checkpoint=f"{checkpoint}/{name}",
                fmt=fmt,
                path=path,
                options=given or {},
                trigger=trigger,
            )
            for name, (shape, path, given) in outputs.items()
        ]
    )
