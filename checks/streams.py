"""The same transforms on streams, compared with SQL over the whole table.

Each query reads the table as a stream of message envelopes, takes all there
is, and returns what the sink holds. In append mode a stream keeps windows
back until the watermark passes them, so the SQL has the same condition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.learning import labelled
from checks.tables import (
    CLEAN,
    PATTERN,
    SHAPED,
    TIDY,
    events_shaped,
    plain_times,
    rounded,
    shape,
    stream,
    table,
)
from checks.runs import ERRORS
from checks.windows import (
    DAYS,
    ORDERED,
    ROUND_SLIDING,
    SESSIONS,
    SLIDING,
    flat_counts,
    user_windows_sql,
)
from clickweir import schema
from clickweir.functions.columns import normalise_code
from clickweir.ml import train
from clickweir.operators import alerts, clean, windows
from clickweir.plans import stream as plan
from clickweir.plans.training import run_training
from clickweir.sources.stream import parse_envelope, read_stream, split_malformed, to_envelope
from clickweir.streaming.run import (
    Sink,
    fan_out,
    logged_progress,
    progress_table,
    read_latest,
    start,
    start_all,
    upsert_batch,
    wait_all,
)
from clickweir.workspace import shared_dir

TIMEOUT = 3600


def finish(queries) -> None:
    """Wait until all streams have taken what there is; a cut-off run is no result."""
    if not wait_all(queries, TIMEOUT):
        raise TimeoutError(f"streams still running after {TIMEOUT} seconds")


def messages(spark: SparkSession, d: str) -> DataFrame:
    """The shaped events as a stream of messages."""
    tidy = shape(stream(spark, d, "events")).drop("tags").withColumn(
        "event_type", normalise_code(F.col("event_type"))
    )
    return to_envelope(tidy, "user_id")


def parsed(spark: SparkSession, d: str) -> DataFrame:
    return parse_envelope(messages(spark, d))


def drain(spark: SparkSession, df: DataFrame, fmt: str = "parquet", **options) -> DataFrame:
    """Run ``df`` over all data there is and read back what it wrote."""
    base = shared_dir(spark, "stream")
    sink = Sink("drain", df, f"{base}/checkpoint", fmt=fmt, path=f"{base}/out", **options)
    finish([start(sink)])
    return spark.read.format(fmt).schema(df.schema).load(f"{base}/out")


def sliding(spark: SparkSession, d: str) -> DataFrame:
    return rounded(plain_times(drain(spark, windows.window_agg(parsed(spark, d)))))


def ordered(spark: SparkSession, d: str) -> DataFrame:
    rows = windows.match_ordered(parsed(spark, d), pattern=PATTERN, **DAYS)
    return plain_times(drain(spark, rows))


def sessions(spark: SparkSession, d: str) -> DataFrame:
    rows = windows.user_sessions(parsed(spark, d), gap="6 hours")
    return rounded(plain_times(drain(spark, rows)))


def user_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = windows.user_windows(parsed(spark, d), **DAYS)
    return rounded(plain_times(flat_counts(drain(spark, rows))))


def patterns(spark: SparkSession, d: str) -> DataFrame:
    """Update mode through upserts."""
    base = shared_dir(spark, "patterns")
    queries = plan.start_pattern_stream(
        messages(spark, d), base, f"{base}/checkpoint", pattern=PATTERN, **DAYS
    )
    finish(queries)
    rows = read_latest(spark, f"{base}/patterns", ["user_id", "window_start"])
    return rounded(
        plain_times(
            rows.select(
                "user_id",
                "window_start",
                "window_end",
                "events_in_session",
                "session_value",
                "last_activity",
            )
        )
    )


def upsert(spark: SparkSession, d: str) -> DataFrame:
    """Update mode with several micro-batches: later batches replace earlier rows."""
    source, base = shared_dir(spark, "parts"), shared_dir(spark, "upsert")
    events_shaped(spark, d).select("timestamp", "user_id", "amount").repartition(
        4, "user_id"
    ).write.parquet(source)
    parts = read_stream(
        spark,
        "parquet",
        {"maxFilesPerTrigger": "1"},
        spark.read.parquet(source).schema,
        source,
    )
    daily = parts.groupBy(F.window("timestamp", "1 day")["start"].alias("day")).agg(
        F.count("*").alias("n"), F.sum("amount").alias("total")
    )
    sink = Sink(
        "upsert", daily, f"{base}/checkpoint", mode="update", batch=upsert_batch(f"{base}/out", f"{base}/checkpoint")
    )
    finish([start(sink)])
    return rounded(plain_times(read_latest(spark, f"{base}/out", ["day"])))


def details(spark: SparkSession, d: str) -> DataFrame:
    rows = clean.enrich_stream(parsed(spark, d)).drop("processing_timestamp")
    written = drain(spark, rows, partition_by=["event_date", "event_hour"])
    return plain_times(
        written.select(
            "kafka_key",
            "event_id",
            "timestamp",
            F.col("event_date").cast("string").alias("event_date"),
            "event_hour",
            "event_minute",
            "amount_range",
            "location_info",
        )
    )


def high_value(spark: SparkSession, d: str) -> DataFrame:
    return rounded(plain_times(drain(spark, alerts.high_value(parsed(spark, d)), fmt="json")))


def dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = clean.clean_events(parsed(spark, d), delay="2 hours")
    return drain(spark, rows.select("event_id", "user_id", "event_type"))


def error_rate(spark: SparkSession, d: str) -> DataFrame:
    rows = alerts.error_rate(parsed(spark, d), duration="1 hour", threshold=0.25)
    return rounded(plain_times(drain(spark, rows)), 6)


def _broken(df: DataFrame) -> DataFrame:
    """Messages some of which are no JSON, mistyped or empty, by the event id in the key."""
    at = F.col("key").cast("string").cast("long") % 40
    text = F.col("value").cast("string")
    return df.withColumn(
        "value",
        F.when(at == 5, F.lit("not json {"))
        .when(at == 6, F.regexp_replace(text, '"(user_id|n_chars)":\\d+', '"$1":"x"'))
        .when(at == 7, F.lit(None))
        .otherwise(text)
        .cast("binary"),
    )


def quarantine(spark: SparkSession, d: str) -> DataFrame:
    raw = stream(spark, d, "events")
    keyed = raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        "user_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        "event_type",
    )
    envelope = _broken(to_envelope(keyed, "event_id"))
    good, bad = split_malformed(parse_envelope(envelope, keep_malformed=True))
    ok = drain(spark, good.select("kafka_key", "event_id", "user_id"))
    rejected = drain(spark, bad.select("kafka_key", "raw_value"))
    return ok.select("kafka_key", "user_id", F.lit("good").alias("part")).unionByName(
        rejected.select(
            "kafka_key",
            F.lit(-1).cast("long").alias("user_id"),
            F.when(F.col("raw_value").isNull(), "empty").otherwise("malformed").alias("part"),
        )
    )


def _twice(df: DataFrame) -> DataFrame:
    """Every message whose user id (the key) is odd comes twice."""
    odd = F.col("key").cast("string").cast("long") % 2 == 1
    copies = F.when(odd, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("copy", F.explode(copies)).drop("copy")


def all_outputs(spark: SparkSession, d: str) -> DataFrame:
    """All outputs of the event job at once, some messages sent twice: rows per output."""
    base = shared_dir(spark, "event-job")
    sinks = plan.event_sinks(_twice(messages(spark, d)), base, f"{base}/checkpoint", delay="2 hours")
    finish(start_all(sinks))
    counts = [
        spark.read.format(s.fmt)
        .schema(s.df.schema)
        .load(s.path)
        .agg(F.count("*").alias("n"))
        .select(F.lit(s.name).alias("output"), "n")
        for s in sinks
        if s.name != "aggregations"
    ]
    united = counts[0]
    for part in counts[1:]:
        united = united.unionByName(part)
    return united


def shared_read(spark: SparkSession, d: str) -> DataFrame:
    """The outputs of ``all_outputs``, from one read of the source."""
    base = shared_dir(spark, "shared-read")
    sinks = plan.shared_sinks(_twice(messages(spark, d)), base, f"{base}/checkpoint", delay="2 hours")
    finish(start_all(sinks))
    read = [
        spark.read.format(fmt)
        .schema("event_id string")
        .load(f"{base}/events/{name}")
        .select(F.lit(name).alias("output"))
        for name, fmt in (("details", "parquet"), ("alerts", "json"), ("rejected", "json"))
    ]
    return read[0].union(read[1]).union(read[2]).groupBy("output").agg(F.count("*").alias("n"))


def one_read(spark: SparkSession, d: str) -> DataFrame:
    """Two outputs from one read of the source."""
    base = shared_dir(spark, "fan-out")
    outputs = {
        "alerts": alerts.high_value,
        "purchases": lambda df: clean.keep_types(df, ["PURCHASE"]).select("event_id", "amount"),
    }
    sink = Sink(
        "fan-out", parsed(spark, d), f"{base}/checkpoint", batch=fan_out(outputs, f"{base}/out", f"{base}/checkpoint")
    )
    finish([start(sink)])
    read = {name: spark.read.parquet(f"{base}/out/{name}") for name in outputs}
    return rounded(
        read["alerts"]
        .select(F.lit("alerts").alias("output"), "event_id", "amount")
        .unionByName(read["purchases"].select(F.lit("purchases").alias("output"), "event_id", "amount"))
    )


def progress(spark: SparkSession, d: str) -> DataFrame:
    """Many small batches: every one of them is in the log."""
    base, source = shared_dir(spark, "progress"), shared_dir(spark, "parts")
    events_shaped(spark, d).select("timestamp", "user_id", "amount", "event_type").repartition(
        25, "user_id"
    ).write.parquet(source)
    parts = read_stream(
        spark,
        "parquet",
        {"maxFilesPerTrigger": "1"},
        spark.read.parquet(source).schema,
        source,
    )
    with logged_progress(spark, f"{base}/log"):
        finish([start(Sink("progress", parts, f"{base}/checkpoint", path=f"{base}/out"))])
    file = F.col("_metadata")["file_path"]
    files = spark.read.parquet(source).agg(F.countDistinct(file)).scalar()
    batches = F.countDistinct(F.when(F.col("input_rows") > 0, F.col("batch_id")))
    return progress_table(spark, f"{base}/log").agg(
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows").alias("late_rows"),
        (batches == files).alias("all_batches"),
    )


def json_lines(spark: SparkSession, d: str) -> DataFrame:
    """Newline-delimited JSON files as the source, one file per micro-batch."""
    source = shared_dir(spark, "json-lines")
    rows = events_shaped(spark, d).drop("tags")
    rows.repartition(3, "user_id").write.option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    ).json(source)
    lines = read_stream(
        spark, "json", {"maxFilesPerTrigger": "1"}, schema.STREAM_EVENT, source
    )
    return rounded(
        plain_times(drain(spark, lines.select("event_id", "user_id", "timestamp", "amount")))
    )


_RESULT = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("probability", T.ArrayType(T.DoubleType())),
        T.StructField("prediction_timestamp", T.TimestampType()),
        T.StructField("reason", T.StringType()),
    ]
)


def _model(spark, d):
    folder = run_training(labelled(spark, d), shared_dir(spark, "models"), key=["doc_id"])[2]
    return train.load(spark, folder)


def scores(spark: SparkSession, d: str) -> DataFrame:
    """Train and save a model, then score every document as a request message.

    The stream must say what the loaded model says of the table.
    """
    model, request = _model(spark, d)
    requests = to_envelope(
        stream(spark, d, "documents").withColumn("at", F.current_timestamp()), "doc_id", "at"
    )
    replies = drain(spark, plan.score_messages(requests, model, request))
    read = replies.select("key", F.from_json("value", _RESULT).alias("r"))
    batch = model.transform(table(spark, d, "documents")).select(
        F.col("doc_id").cast("string").alias("key"), F.col("prediction").alias("in_batch")
    )
    sums = F.abs(F.aggregate("r.probability", F.lit(0.0), lambda a, b: a + b) - 1) < 1e-9
    return read.join(batch, "key", "left").select(
        F.col("key").cast("long").alias("doc_id"),
        (F.col("r.request_id") == F.col("key")).alias("same_id"),
        sums.alias("sums_to_one"),
        (F.col("r.prediction") == F.col("in_batch")).alias("as_in_batch"),
    )


def scores_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Some requests lack a feature, a value, or are no JSON: each is answered or rejected."""
    model, request = _model(spark, d)
    i = F.col("doc_id")
    documents = stream(spark, d, "documents").withColumns(
        {
            "text": F.when(i % 10 != 3, F.col("text")),
            "lang": F.when(i % 10 != 4, F.col("lang")),
            "at": F.current_timestamp(),
        }
    )
    requests = _broken(to_envelope(documents, "doc_id", "at"))
    replies = drain(spark, plan.score_messages(requests, model, request))
    rejected = drain(spark, plan.reject_messages(requests, model, request))
    both = replies.unionByName(rejected).select("key", F.from_json("value", _RESULT).alias("r"))
    return both.select(
        F.col("key").cast("long").alias("doc_id"),
        F.coalesce("r.reason", F.lit("scored")).alias("outcome"),
    )


def complete_mode(spark: SparkSession, d: str) -> DataFrame:
    """Counts of all there is so far, in complete mode to a memory table."""
    base = shared_dir(spark, "complete")
    name = f"type_counts_{base.rpartition('-')[2]}"
    counted = parsed(spark, d).groupBy("event_type").agg(F.count("*").alias("n"))
    finish([start(Sink(name, counted, f"{base}/checkpoint", fmt="memory", mode="complete"))])
    return spark.table(name)


def restarted(spark: SparkSession, d: str) -> DataFrame:
    """The same stream started twice from one checkpoint: the second run adds what is new only."""
    base, source = shared_dir(spark, "restart"), shared_dir(spark, "parts")
    events = events_shaped(spark, d).select("event_id", "user_id", "event_type")
    half = F.coalesce(F.col("user_id"), F.lit(0)) % 2
    for part in (0, 1):
        events.where(half == part).coalesce(1).write.mode("append").parquet(source)
        parts = read_stream(spark, "parquet", None, events.schema, source)
        finish([start(Sink("restart", parts, f"{base}/checkpoint", path=f"{base}/out"))])
    return spark.read.parquet(f"{base}/out")


def closing(spark: SparkSession, d: str) -> DataFrame:
    """Windows a drained stream has written, and those it still held, from the stored events."""
    base = shared_dir(spark, "closing")
    events = parsed(spark, d).select("timestamp", "user_id", "amount", "event_type", "category")
    sinks = [
        Sink("closing_detail", events, f"{base}/c1", path=f"{base}/detail"),
        Sink("closing_windows", windows.window_agg(events), f"{base}/c2", path=f"{base}/windows"),
    ]
    finish(start_all(sinks))
    stored = spark.read.parquet(f"{base}/detail")
    whole = windows.window_agg(stored)
    written = spark.read.schema(whole.schema).parquet(f"{base}/windows")
    still_open = windows.open_only(whole, stored, "timestamp", "10 minutes")
    return rounded(plain_times(written.unionByName(still_open)))


def closed(end: str, delay: str) -> str:
    return (
        f'where {end} <= (select date_trunc(\'milliseconds\', max("timestamp")) from tidy) '
        f"- interval {delay}"
    )


_OUTPUTS = (
    CLEAN
    + """, doubled as (
           select *, case when user_id % 2 = 1 then 2 else 1 end as copies from tidy)
         select 'details' as output, count(*) as n from clean where event_type is not null
         union all select 'alerts', count(*) from clean
           where event_type is not null and amount > 10000
         union all select 'rejected', sum(copies)::bigint from doubled
           where event_id is null or user_id is null or event_type is null"""
)

CHECKS = {
    "stream_sliding_window": (
        sliding,
        SLIDING + ROUND_SLIDING + " " + closed("window_end", "10 minute"),
    ),
    "stream_pattern_ordered": (
        ordered,
        ORDERED + "select * from ordered " + closed("window_end", "30 minute"),
    ),
    "stream_sessions": (
        sessions,
        SESSIONS + "select * from sessions " + closed("session_end", "30 minute"),
    ),
    "stream_user_windows": (
        user_windows,
        user_windows_sql("1 day", 3, "3 day")
        + "select * exclude (sequence_length, matched) from user_windows "
        + closed("window_end", "30 minute"),
    ),
    "stream_pattern_updates": (
        patterns,
        # Messages without a required field are rejected.
        user_windows_sql("1 day", 3, "3 day", "event_id is not null and event_type is not null")
        + """select user_id, window_start, window_end, events_in_session, session_value,
             last_activity from user_windows where matched""",
    ),
    "stream_upsert_update_mode": (
        upsert,
        TIDY
        + """select date_trunc('day', "timestamp")::timestamp as day, count(*) as n,
             round(sum(amount), 4) as total from tidy group by all""",
    ),
    "stream_enrich": (
        details,
        TIDY
        + """select cast(user_id as varchar) as kafka_key, event_id, "timestamp",
             strftime("timestamp", '%Y-%m-%d') as event_date,
             cast(hour("timestamp") as integer) as event_hour,
             cast(minute("timestamp") as integer) as event_minute,
             case when amount is null then 'unknown' when amount < 100 then '0-100'
                  when amount < 500 then '100-500' when amount < 1000 then '500-1000'
                  when amount < 5000 then '1000-5000' else '5000+' end as amount_range,
             case when country is null then 'Unknown Location'
                  else coalesce(city, 'Unknown') || ', ' || country end as location_info
             from tidy""",
    ),
    "stream_high_value": (
        high_value,
        TIDY
        + """select event_id, user_id, round(amount, 4) as amount, "timestamp", event_type
             from tidy where amount > 10000""",
    ),
    "stream_dedup": (dedup, CLEAN + "select event_id, user_id, event_type from clean"),
    "stream_error_rate": (
        error_rate,
        TIDY + ERRORS + "select * from alarms " + closed("window_end", "10 minute"),
    ),
    "stream_parse_quarantine": (
        quarantine,
        """select cast(event_id as varchar) as kafka_key,
             case when event_id % 40 in (5, 6, 7) then -1 else user_id end as user_id,
             case when event_id % 40 in (5, 6) then 'malformed'
                  when event_id % 40 = 7 then 'empty' else 'good' end as part
           from events""",
    ),
    "stream_all_outputs": (
        all_outputs,
        _OUTPUTS,
    ),
    "stream_shared_read": (shared_read, _OUTPUTS),
    "stream_fan_out": (
        one_read,
        TIDY
        + """select 'alerts' as output, event_id, round(amount, 4) as amount from tidy
             where amount > 10000
             union all select 'purchases', event_id, round(amount, 4) from tidy
             where event_type = 'PURCHASE'""",
    ),
    "stream_progress": (
        progress,
        TIDY + "select count(*) as input_rows, 0::bigint as late_rows, true as all_batches from tidy",
    ),
    "stream_json_lines": (
        json_lines,
        TIDY + 'select event_id, user_id, "timestamp", round(amount, 4) as amount from tidy',
    ),
    "stream_scores": (
        scores,
        """select doc_id, true as same_id, true as sums_to_one, true as as_in_batch
           from documents""",
    ),
    "stream_scores_rejects": (
        scores_rejects,
        """select doc_id, case when doc_id % 40 in (5, 6) then 'malformed'
             when doc_id % 40 = 7 then 'empty'
             when doc_id % 10 = 3 then 'missing feature' else 'scored' end as outcome
           from documents""",
    ),
    "stream_complete_mode": (
        complete_mode,
        TIDY + "select event_type, count(*) as n from tidy group by event_type",
    ),
    "stream_restart": (
        restarted,
        SHAPED + "select event_id, user_id, event_type from shaped",
    ),
    "stream_closing_step": (closing, SLIDING + ROUND_SLIDING),
}
