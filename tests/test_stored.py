"""Sketches, ledgers, bucketed tables, nested schemas, reject reasons, stream state."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.operators import buckets, quality, sketches, windows
from clickweir.sources.stream import rejected_shape, with_reason
from clickweir.streaming.run import LOCAL_SESSIONS, Sink, start, wait_all
from clickweir.streaming.state import open_windows, state_operators, state_sizes, stored_state
from clickweir.workspace import materialise

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def spans(spark):
    """40,000 values over 40 hours, a third of them in one group."""
    at = F.timestamp_add("MINUTE", (F.col("id") * 2400 / 40_000).cast("int"), F.lit(T0))
    group = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5)
    return spark.range(40_000).select(
        group.alias("operation"),
        at.alias("start_time"),
        (F.pmod(F.xxhash64("id"), F.lit(10_000)) / 7.0).alias("v"),
    )


def test_quantiles_of_a_range(spark, spans):
    table = sketches.value_sketches(spans, "v")
    since, until = T0 + timedelta(hours=5), T0 + timedelta(hours=30)
    rows = sketches.quantiles(table, [0.0, 0.5, 0.99, 1.0], since=since, until=until).collect()
    inside = spans.where((F.col("start_time") >= since) & (F.col("start_time") < until))
    exact = {}
    for r in inside.select("operation", "v").collect():
        exact.setdefault(r.operation, []).append(r.v)
    assert len(rows) == 4 * len(exact)
    for r in rows:
        values = exact[r.operation]
        assert r["values"] == len(values)
        rank = sum(v <= r.quantile for v in values) / len(values)
        assert abs(rank - r.share) <= 2 * sketches.rank_error()
    for r in sketches.share_below(table, 700, since=since, until=until).collect():
        values = exact[r.operation]
        assert abs(r.share - sum(v <= 700 for v in values) / len(values)) <= 2 * sketches.rank_error()
    assert sketches.quantiles(table.limit(0), [0.5]).count() == 0
    nulls = spans.withColumn("v", F.lit(None).cast("double"))
    assert sketches.value_sketches(nulls, "v").count() == 0


def test_users_of_ranges(spark):
    rows = [(T0 + timedelta(days=d), "VIEW", u) for d in range(4) for u in range(10 * d, 10 * d + 25)]
    rows += [(T0, "VIEW", None), (T0, "CLICK", 3), (T0 + timedelta(days=3), "VIEW", 31)] * 5
    table = sketches.user_sketches(
        spark.createDataFrame(rows, "timestamp timestamp, event_type string, user_id long")
    )
    views = {r.event_type: r.users for r in sketches.distinct_users(table, ["event_type"]).collect()}
    assert views == {"VIEW": 55, "CLICK": 1}
    last = sketches.distinct_users(table, since=T0 + timedelta(days=2)).first()
    assert (last.users, last.events) == (35, 55)
    got = sketches.returning_users(table.where("event_type = 'VIEW'")).orderBy("slot").collect()
    assert [tuple(r)[1:] for r in got] == [
        (25, 0, 25, 0),
        (25, 15, 10, 10),
        (25, 15, 10, 10),
        (25, 15, 10, 10),
    ]


def test_users_above_the_exact_size(spark):
    df = spark.range(200_000).select(
        F.lit(T0).alias("timestamp"), F.lit("VIEW").alias("event_type"), (F.col("id") % 50_000).alias("user_id")
    )
    users = sketches.distinct_users(sketches.user_sketches(df)).first().users
    assert abs(users - 50_000) <= 4 * sketches.count_error() * 50_000


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, plan):
    left = spark.range(1000).withColumn("a", F.col("id") % 7)
    right = spark.range(0, 2000, 3).withColumn("b", F.col("id") % 5)
    for name, df, count in (("b_left", left, 4), ("b_right", right, 4), ("b_wide", right, 8)):
        buckets.write_bucketed(df, name, str(tmp_path / name), ["id"], count)
    want = sorted(map(tuple, left.join(right, "id").collect()))
    for other, shuffles in (("b_right", 0), ("b_wide", 1)):
        joined = buckets.bucketed_join(spark, "b_left", other, ["id"])
        assert plan(joined).count("Exchange hashpartitioning") + plan(joined).split(
            "\n\n\n"
        )[0].count("Exchange") == shuffles
        assert sorted(map(tuple, joined.collect())) == want
    grouped = spark.table("b_left").groupBy("id").agg(F.count("*"))
    assert "Exchange" not in plan(grouped).split("\n\n\n")[0]


def test_ledger(spark, tmp_path, plan):
    path = str(tmp_path / "ledger")
    ledger = buckets.KeyLedger(spark, path, "ledger_a", buckets=4)

    def take(keys, run, ledger=ledger):
        rows = spark.createDataFrame([(k,) for k in keys], "event_id string")
        kept = materialise(ledger.unseen(rows, "event_id", run))
        ledger.record(kept, "event_id", run)
        return sorted(r.event_id or "" for r in kept.collect())

    assert take(["a", "b", None], "day1") == ["", "a", "b"]
    assert take(["b", "c"], "day2") == ["c"]
    assert take(["a", "b", None], "day1") == ["", "a", "b"]  # repeated: the same, nothing added
    assert take([], "day3") == []
    assert ledger.keys().count() == 3
    # A session that does not know the table finds its keys.
    again = buckets.KeyLedger(spark, path, "ledger_b", buckets=4)
    assert take(["c", "d"], "day4", again) == ["d"]
    text = plan(again.unseen(spark.range(5).select(F.col("id").cast("string").alias("event_id")), "event_id", "z"))
    tree = text.split("\n\n\n")[0]
    assert tree.count("Exchange") == 1  # the new rows only
    assert "Bucketed: true" in text


def test_nested_changes():
    cases = [
        (T.IntegerType(), T.LongType(), "widened"),
        (T.LongType(), T.IntegerType(), "narrowed"),
        (T.FloatType(), T.DoubleType(), "widened"),
        (T.IntegerType(), T.DoubleType(), "widened"),
        (T.LongType(), T.DoubleType(), "type"),
        (T.DecimalType(10, 2), T.DecimalType(12, 2), "widened"),
        (T.DecimalType(10, 2), T.DecimalType(10, 4), "type"),
        (T.DateType(), T.TimestampType(), "widened"),
        (T.StringType(), T.LongType(), "type"),
        (T.ArrayType(T.LongType()), T.LongType(), "type"),
    ]
    for wanted, found, issue in cases:
        assert quality._walk("x", wanted, found)[0][3] == issue
    deep = T.ArrayType(T.StructType().add("a", T.MapType(T.StringType(), T.IntegerType())))
    found = T.ArrayType(
        T.StructType().add("a", T.MapType(T.StringType(), T.LongType())).add("b", T.LongType())
    )
    got = {path: issue for path, _, _, issue in quality._walk("x", deep, found)}
    assert got == {"x[].a.key": None, "x[].a.value": "widened", "x[].b": "extra"}


def test_reasons(spark):
    good = '"event_id":"1","user_id":1,"timestamp":"2024-01-01T00:00:00Z","event_type":"VIEW"'
    cases = {
        None: ("empty", None),
        "": ("not json", None),
        "[1]": ("not json", None),
        "{" + good: ("not json", None),
        "{" + good.replace('"user_id":1,', "") + "}": ("missing", "user_id"),
        "{" + good.replace('"user_id":1,', '"user_id":null,') + "}": ("missing", "user_id"),
        "{" + good.replace(':1,', ':1.5,') + "}": ("type", "user_id"),
        "{" + good.replace("2024-01-01T00:00:00Z", "soon") + "}": ("type", "timestamp"),
        "{" + good + ',"amount":"much"}': ("type", "amount"),
        "{" + good + ',"location":[]}': ("type", "location"),
        "{" + good + ',"amount":3}': ("other", None),
    }
    df = spark.createDataFrame([(t,) for t in cases], "raw_value string")
    got = {r.raw_value: (r.reason, r.field) for r in with_reason(df).collect()}
    assert got == cases
    shape = rejected_shape(df).first()
    assert (shape.messages, shape.json_messages) == (11, 8)
    assert "VARIANT" in shape.shape or "OBJECT" in shape.shape


@pytest.fixture
def feed(spark, tmp_path):
    rows = [
        (T0 + timedelta(minutes=3 * i), i % 4, "VIEW", "c", float(i)) for i in range(40)
    ]
    df = spark.createDataFrame(
        rows, "timestamp timestamp, user_id long, event_type string, category string, amount double"
    )
    df.repartition(3).write.parquet(str(tmp_path / "feed"))
    return spark.readStream.schema(df.schema).parquet(str(tmp_path / "feed")), df


def test_sessions_merge_below_the_exchange(spark, feed, tmp_path):
    name = next(iter(LOCAL_SESSIONS))
    before = spark.conf.get(name)
    stream, _ = feed
    query = start(
        Sink(
            "sessions",
            windows.user_sessions(stream),
            str(tmp_path / "c"),
            path=str(tmp_path / "o"),
            settings=LOCAL_SESSIONS,
        )
    )
    assert wait_all([query], 300)
    text = query._jsq.explainInternal(False)
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "MergingSessions" in above and "MergingSessions" in below
    assert spark.conf.get(name) == before


def test_state_completes_what_was_written(spark, feed, tmp_path):
    stream, df = feed
    rows = windows.window_agg(stream)
    query = start(Sink("held", rows, str(tmp_path / "c"), path=str(tmp_path / "o")))
    assert wait_all([query], 300)
    checkpoint = str(tmp_path / "c")
    assert state_operators(spark, checkpoint).count() == 2
    held = open_windows(spark, checkpoint)
    assert held.count() > 0
    written = spark.read.schema(rows.schema).parquet(str(tmp_path / "o"))
    whole = windows.window_agg(df).select(*written.columns)
    both = written.unionByName(held)
    assert both.exceptAll(whole).isEmpty() and whole.exceptAll(both).isEmpty()
    sizes = state_sizes(spark, checkpoint)
    per_user = stored_state(spark, checkpoint, 1)
    assert sizes.where("operator = 1").agg(F.sum("keys")).first()[0] == per_user.count()
