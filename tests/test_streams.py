"""Streams: parsing, restarts, late data, upserts, fan-out."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickweir import schema
from clickweir.operators import alerts, clean, windows
from clickweir.plans import stream as plan
from clickweir.sources.stream import (
    parse_envelope,
    read_stream,
    split_malformed,
    to_envelope,
    topic_options,
)
from clickweir.streaming.run import (
    ProgressLog,
    Sink,
    collapse,
    logged_progress,
    progress_table,
    read_latest,
    start,
    start_all,
    upsert_batch,
    wait_all,
)

T0 = datetime(2024, 1, 1)


@pytest.fixture
def feed(spark, tmp_path):
    """``feed(n, rows)`` adds one file of messages; ``feed.stream()`` reads them in order."""
    folder = tmp_path / "messages"
    folder.mkdir()

    class Feed:
        def __call__(self, n, rows):
            target = str(tmp_path / f"part{n}")
            df = spark.createDataFrame(
                [
                    (str(i), 1, T0 + timedelta(minutes=m), kind, amount)
                    for i, m, kind, amount in rows
                ],
                "event_id string, user_id long, timestamp timestamp, event_type string, amount double",
            )
            to_envelope(df, "event_id").coalesce(1).write.parquet(target)
            [name] = [f for f in os.listdir(target) if f.endswith(".parquet")]
            final = folder / f"{n}.parquet"
            final.write_bytes(open(f"{target}/{name}", "rb").read())
            os.utime(final, (1_700_000_000 + n, 1_700_000_000 + n))

        def stream(self):
            return read_stream(
                spark, "parquet", {"maxFilesPerTrigger": "1"}, schema.ENVELOPE, str(folder)
            )

        def events(self):
            return parse_envelope(self.stream())

    return Feed()


def run(sink):
    query = start(sink)
    assert wait_all([query], 300)
    return query


def test_topic_options():
    options = topic_options("host:1", "events", startingOffsets="earliest")
    assert options["subscribe"] == "events"
    assert options["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in options
    assert options["failOnDataLoss"] == "true"
    assert topic_options("h", "t", maxOffsetsPerTrigger="5")["maxOffsetsPerTrigger"] == "5"


def test_envelope_round_trip(spark):
    location = ("KR", "Seoul", 1.5, 2.5)
    row = ("e", 7, T0 + timedelta(microseconds=123456), "VIEW", "c", 1.25, {"k": "v"}, location)
    df = spark.createDataFrame([row], schema.STREAM_EVENT)
    got = parse_envelope(to_envelope(df, "user_id")).first()
    assert got["kafka_key"] == "7"
    assert got["timestamp"] == row[2] == got["kafka_timestamp"]
    assert got["properties"] == {"k": "v"}
    assert tuple(got["location"]) == location


def test_malformed_and_empty_values_are_set_aside(spark):
    good = '{"event_id":"a","user_id":1,"timestamp":"2024-01-01T00:00:00Z","event_type":"VIEW"}'
    rows = [("1", good), ("2", "garbage {"), ("3", good.replace("1,", '"x",')), ("4", None)]
    rows += [("5", "{}"), ("6", '{"event_id":"x","user_id":1}')]  # required fields are missing
    df = spark.createDataFrame(rows, "key string, value string").select(
        F.col("key").cast("binary"), F.col("value").cast("binary"), F.lit(T0).alias("timestamp")
    )
    ok, bad = split_malformed(parse_envelope(df, keep_malformed=True))
    assert [r["event_id"] for r in ok.collect()] == ["a"]
    assert ok.columns == ["kafka_key", *schema.STREAM_EVENT.names, "kafka_timestamp"]
    got = {r["kafka_key"]: r["raw_value"] for r in bad.collect()}
    assert got == {k: v for k, v in rows if k != "1"}


def test_messages_are_parsed_once_whatever_is_asked_of_the_fields(spark, plan):
    good, bad = split_malformed(parse_envelope(to_envelope(spark.range(3), "id", "id"), keep_malformed=True))
    for part in (good.where("user_id > 1"), bad):
        tree = plan(part)
        assert tree.count("from_json") == 1, tree


def test_restart_adds_nothing_and_resumes(spark, feed, tmp_path):
    feed(1, [("a", 0, "VIEW", 20000.0), ("b", 1, "VIEW", 5.0)])
    out = str(tmp_path / "out")

    def once():
        run(
            Sink(
                "alerts",
                alerts.high_value(feed.events()),
                str(tmp_path / "c"),
                fmt="json",
                path=out,
            )
        )
        return spark.read.schema("event_id string").json(out).count()

    assert once() == 1
    assert once() == 1
    feed(2, [("c", 2, "VIEW", 30000.0)])
    assert once() == 2


def test_late_events_are_dropped_and_reported(spark, feed, tmp_path):
    feed(1, [("a", 0, "VIEW", 1.0), ("b", 60, "VIEW", 1.0)])
    feed(2, [("c", 61, "VIEW", 1.0)])
    feed(3, [("late", 5, "VIEW", 1.0), ("d", 120, "VIEW", 1.0)])
    counted = windows.window_agg(
        feed.events(), duration="10 minutes", slide=None, keys=["event_type"]
    )
    out = str(tmp_path / "out")
    log = str(tmp_path / "log")
    with logged_progress(spark, log):
        run(Sink("late", counted, str(tmp_path / "c"), path=out))
    got = spark.read.parquet(out)
    assert got.agg(F.sum("event_count")).first()[0] == 3
    assert got.where(F.col("window_start") == T0).first()["event_count"] == 1
    table = progress_table(spark, log)
    assert table.agg(F.sum("input_rows"), F.sum("late_rows")).first() == (5, 1)
    assert table.where("watermark is not null").count() > 0


def test_dedup_across_batches(spark, feed, tmp_path):
    feed(1, [("a", 0, "VIEW", 1.0), ("a", 1, "VIEW", 1.0)])
    feed(2, [("a", 2, "VIEW", 1.0), ("b", 3, "VIEW", 1.0)])
    unique = clean.clean_events(feed.events()).select("event_id")
    out = str(tmp_path / "out")
    run(Sink("dedup", unique, str(tmp_path / "c"), path=out))
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_upsert_keeps_the_last_row_per_key(spark, feed, tmp_path):
    feed(1, [("a", 0, "VIEW", 1.0), ("b", 0, "PURCHASE", 2.0)])
    feed(2, [("c", 1, "VIEW", 5.0)])
    total = feed.events().groupBy("event_type").agg(F.sum("amount").alias("total"))
    out = str(tmp_path / "out")
    own = upsert_batch(out, str(tmp_path / "c"))
    run(Sink("up", total, str(tmp_path / "c"), mode="update", batch=own))
    expected = {"VIEW": 6.0, "PURCHASE": 2.0}
    assert dict(map(tuple, read_latest(spark, out, ["event_type"]).collect())) == expected
    again = spark.createDataFrame([("VIEW", 1.0), ("PURCHASE", 2.0)], "event_type string, total double")
    own(again, 0)
    assert dict(map(tuple, read_latest(spark, out, ["event_type"]).collect())) == expected
    whole = str(tmp_path / "whole")
    # A second stream, or the same with a new checkpoint, may not overwrite batch 0.
    other = Sink(
        "other",
        total,
        str(tmp_path / "c2"),
        mode="update",
        batch=upsert_batch(out, str(tmp_path / "c2")),
    )
    with pytest.raises(Exception, match="belongs to the stream"):
        run(other)
    assert dict(map(tuple, read_latest(spark, out, ["event_type"]).collect())) == expected
    collapse(spark, out, whole, ["event_type"])
    assert dict(map(tuple, read_latest(spark, whole, ["event_type"]).collect())) == expected


def test_pattern_stream_follows_the_batches(spark, feed, tmp_path):
    feed(1, [("a", 0, "VIEW", 1.0), ("b", 1, "ADD_TO_CART", 1.0), ("r", 1, None, 1.0)])
    feed(2, [("c", 2, "PURCHASE", 1.0)])
    out = str(tmp_path / "out")
    assert wait_all(plan.start_pattern_stream(feed.stream(), out, str(tmp_path / "c")), 300)
    assert spark.read.json(f"{out}/rejected").count() == 1
    got = read_latest(spark, f"{out}/patterns", ["user_id", "window_start"])
    assert got.count() == 4
    assert {r["events_in_session"] for r in got.collect()} == {3}


def test_all_outputs_have_their_own_checkpoint(spark, feed, tmp_path):
    feed(1, [("a", 0, "VIEW", 1.0)])
    df = feed.events()
    same = [Sink(n, df, str(tmp_path / "c"), path=str(tmp_path / n)) for n in ("x", "y")]
    with pytest.raises(ValueError):
        start_all(same)
    sinks = plan.event_sinks(feed.stream(), str(tmp_path / "o"), str(tmp_path / "k"))
    assert {s.name for s in sinks} == set(plan.SERVICE_TRIGGERS)
    assert len({s.checkpoint for s in sinks}) == len(sinks)


def test_shared_read_reads_once_and_keeps_every_malformed_message(spark, feed, tmp_path):
    feed(1, [("a", 0, "VIEW", 20000.0), ("a", 0, "VIEW", 20000.0), ("b", 1, None, 1.0)])
    feed(2, [("c", 300, "VIEW", 1.0), ("b", 1, None, 1.0), ("b", 1, None, 1.0)])
    feed(3, [("a", 0, "VIEW", 20000.0), ("d", 301, "VIEW", 1.0), ("b", 1, None, 1.0)])
    out = str(tmp_path / "o")
    sinks = plan.shared_sinks(feed.stream(), out, str(tmp_path / "k"))
    assert [s.name for s in sinks] == ["events", "aggregations"]
    query = start(sinks[0])
    assert wait_all([query], 300)
    assert sum(p.numInputRows for p in query.recentProgress) == 9
    details = spark.read.parquet(f"{out}/events/details")
    # The late copy of "a" is dropped by the watermark, the malformed ones never are.
    assert sorted(r["event_id"] for r in details.collect()) == ["a", "c", "d"]
    assert spark.read.json(f"{out}/events/rejected").count() == 4
    assert spark.read.json(f"{out}/events/alerts").count() == 1


def test_shared_read_writes_few_files_to_a_folder(spark, feed, tmp_path):
    feed(1, [(str(i), i % 90, "VIEW", 1.0) for i in range(200)])
    out = str(tmp_path / "o")
    query = start(plan.shared_sinks(feed.stream(), out, str(tmp_path / "k"))[0])
    assert wait_all([query], 300)
    details = spark.read.parquet(f"{out}/events/details")
    assert details.count() == 200
    files = details.groupBy("event_date", "event_hour").agg(F.countDistinct("_metadata.file_path"))
    # One file per task of the stream and hour before.
    assert [r[2] for r in files.collect()] == [1, 1]


def test_all_outputs_write_few_files_to_a_folder(spark, feed, tmp_path):
    feed(1, [(str(i), i % 90, "VIEW", 1.0) for i in range(400)])
    sinks = plan.event_sinks(feed.stream(), str(tmp_path / "o"), str(tmp_path / "k"))
    [sink] = [s for s in sinks if s.name == "details"]
    run(sink)
    details = spark.read.parquet(sink.path)
    assert details.count() == 400
    files = details.groupBy("event_date", "event_hour").agg(F.countDistinct("_metadata.file_path"))
    # One file per task of the stream (8) and hour before.
    assert all(r[2] <= sink.spread for r in files.collect())


def test_timeout_stops_a_running_service(spark, feed, tmp_path):
    feed(1, [("a", 0, "VIEW", 1.0)])
    query = start(
        Sink(
            "service",
            feed.events().select("event_id"),
            str(tmp_path / "c"),
            path=str(tmp_path / "o"),
            trigger="1 second",
        )
    )
    assert wait_all([query], 5) is False
    assert not query.isActive


def test_a_failing_start_stops_the_others(spark, feed, tmp_path):
    feed(1, [("a", 0, "VIEW", 1.0)])
    good = Sink(
        "good",
        feed.events().select("event_id"),
        str(tmp_path / "c1"),
        path=str(tmp_path / "o1"),
        trigger="1 second",
    )
    # The file sink does not take update mode.
    bad = Sink("bad", feed.events(), str(tmp_path / "c2"), path=str(tmp_path / "o2"), mode="update")
    with pytest.raises(Exception):
        start_all([good, bad])
    assert not [q for q in spark.streams.active if q.name == "good"]


def test_complete_mode_to_memory(spark, feed, tmp_path):
    feed(1, [("a", 0, "VIEW", 1.0), ("b", 1, "SEARCH", 1.0)])
    feed(2, [("c", 2, "VIEW", 1.0)])
    counted = feed.events().groupBy("event_type").agg(F.count("*").alias("n"))
    run(Sink("type_counts", counted, str(tmp_path / "c"), fmt="memory", mode="complete"))
    got = spark.table("type_counts").collect()
    assert {r["event_type"]: r["n"] for r in got} == {"VIEW": 2, "SEARCH": 1}


def test_estimated_users_need_one_aggregate(spark, feed, tmp_path):
    feed(1, [(i, i / 10, "VIEW", 2.0) for i in range(20)])
    counted = windows.window_agg(
        feed.events(), duration="5 minutes", slide=None, keys=["event_type"], exact_users=False
    )
    out = str(tmp_path / "out")
    run(
        Sink("estimate", counted, str(tmp_path / "c"), mode="update", batch=upsert_batch(out, str(tmp_path / "c")))
    )
    got = read_latest(spark, out, ["event_type", "window_start"]).collect()
    assert [(r["event_count"], r["unique_users"], r["avg_amount"]) for r in got] == [(20, 1, 2.0)]


def test_a_failing_stream_stops_the_others_and_raises(spark, feed, tmp_path):
    feed(1, [("a", 0, "VIEW", 1.0)])
    endless = Sink(
        "endless",
        feed.events().select("event_id"),
        str(tmp_path / "c1"),
        path=str(tmp_path / "o1"),
        trigger="1 second",
    )
    broken = Sink(
        "broken",
        feed.events().select(F.raise_error(F.lit("broken on purpose")).alias("x")),
        str(tmp_path / "c2"),
        fmt="memory",
    )
    queries = start_all([endless, broken])
    with pytest.raises(Exception, match="broken on purpose"):
        wait_all(queries, 120)
    assert not any(q.isActive for q in queries)


def test_the_log_is_of_the_streams_inside_the_block(spark, tmp_path):
    ticks = spark.readStream.format("rate").option("rowsPerSecond", "20").load()
    other = start(
        Sink("other", ticks, str(tmp_path / "c1"), path=str(tmp_path / "o1"), trigger="1 second")
    )
    try:
        with logged_progress(spark, str(tmp_path / "log")):
            spark.range(10).write.parquet(str(tmp_path / "ids"))
            rows = spark.readStream.schema("id long").parquet(str(tmp_path / "ids"))
            run(Sink("mine", rows, str(tmp_path / "c2"), path=str(tmp_path / "o2")))
        assert other.isActive
    finally:
        other.stop()
    names = progress_table(spark, str(tmp_path / "log")).select("name").distinct().collect()
    assert [r["name"] for r in names] == ["mine"]


def test_progress_of_a_failed_write_is_written_later(spark, tmp_path):
    (tmp_path / "log").write_text("in the way")
    log = ProgressLog(spark, str(tmp_path / "log"))
    log._rows = [("a", 0, "", 1, 0.0, 0.0, None, 0, 0)]
    with pytest.raises(Exception):
        log.flush()
    (tmp_path / "log").unlink()
    log.flush()
    assert progress_table(spark, str(tmp_path / "log")).count() == 1
