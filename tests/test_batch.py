"""Edges of the batch operators, and brute-force comparisons on small frames."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir import schema
from clickweir.functions import columns
from clickweir.operators import alerts, clean, joins, layout, quality, runs, summary, windows
from clickweir.operators.buckets import KeyLedger
from clickweir.plans.batch import run_day
from clickweir.sources import batch

T0 = datetime(2024, 1, 1)


def event(event_id, user=1, minute=0.0, kind="VIEW", amount=None, **more):
    row = {
        "event_id": event_id,
        "user_id": user,
        "timestamp": T0 + timedelta(minutes=minute),
        "event_type": kind,
        "category": None,
        "amount": amount,
        "properties": None,
        "tags": None,
        "location": None,
    }
    return {**row, **more}


NULLABLE = T.StructType([T.StructField(f.name, f.dataType) for f in schema.EVENT.fields])


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, NULLABLE)


# --- cleaning and enrichment


def test_clean_keeps_the_earliest_copy_and_drops_null_keys(frame):
    rows = [
        event("a", minute=5, category="late"),
        event("a", minute=1, kind="  view "),
        event(None),
        event("b", amount=3.0),
    ]
    got = {r["event_id"]: r for r in clean.clean_events(frame(rows)).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"]["event_type"] == "VIEW"
    assert got["a"]["category"] == "UNKNOWN"
    assert got["a"]["amount"] == 0.0


def test_dedup_is_the_same_for_every_partitioning(frame):
    rows = [
        event("k", category=c, properties={"x": p}, tags=[c])
        for c in "abc"
        for p in ("1", "2")
    ]
    seen = {
        tuple(clean.dedup(frame(rows).repartition(n), ["event_id"], ["timestamp"]).first())[4]
        for n in (1, 2, 5)
    }
    assert seen == {"a"}


def test_dedup_cuts_copies_before_the_shuffle(frame, plan):
    text = plan(clean.dedup(frame([event("a")]), ["event_id"], ["timestamp"]))
    assert text.count("WindowGroupLimit") >= 2


def test_enrich_null_guards(frame):
    got = clean.enrich_events(frame([event("a")]), null_label="none").first()
    assert (got["tag_count"], got["has_properties"], got["amount_category"]) == (0, False, "none")
    filled = frame([event("a", properties={"k": "v"}, tags=["x", "y"], amount=1000.0)])
    got = clean.enrich_events(filled).first()
    assert (got["tag_count"], got["has_properties"], got["amount_category"]) == (2, True, "large")


@pytest.mark.parametrize(
    "amount, label",
    [(None, "unknown"), (99.99, "0-100"), (100.0, "100-500"), (5000.0, "5000+"), (-1.0, "0-100")],
)
def test_amount_ranges(frame, amount, label):
    assert clean.enrich_stream(frame([event("a", amount=amount)])).first()["amount_range"] == label


def test_location_text(frame):
    places = [None, ("KR", "Seoul", 1.0, 2.0), (None, "Seoul", None, None), ("KR", None, None, None)]
    rows = [event(str(i), location=p) for i, p in enumerate(places)]
    got = [r["location_info"] for r in clean.enrich_stream(frame(rows)).orderBy("event_id").collect()]
    assert got == ["Unknown Location", "Seoul, KR", "Seoul, Unknown", "Unknown, KR"]


def test_label_range_wants_one_label_more():
    with pytest.raises(ValueError):
        columns.label_range(F.lit(1), [1, 2], ["a", "b"])


def test_sensitive_text(spark):
    df = spark.createDataFrame([("my password",), ("Password",), (None,), ("ok",)], "body string")
    kept = {r["body"] for r in clean.drop_sensitive(df, "body").collect()}
    assert kept == {"Password", None, "ok"}


def test_paths(spark):
    df = spark.createDataFrame(
        [("s3://my-bucket/k",), ("s3a://b/k",), ("s3a://ok1/x",), ("http://x/y",)], "p string"
    )
    got = df.select(columns.switch_scheme(F.col("p")), columns.is_bucket_path(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [
        ("s3a://my-bucket/k", True),
        ("s3a://b/k", False),
        ("s3a://ok1/x", True),
        ("http://x/y", False),
    ]


# --- quality


def test_empty_table_scores_zero(frame):
    got = quality.quality_report(frame([]), as_of=T0).first()
    assert got["quality_score"] == 0.0
    assert got["total_records"] == 0
    assert got["duplicate_records"] == 0
    assert got["latest_timestamp"] is None
    gate = quality.quality_gate(quality.quality_report(frame([]))).collect()
    assert {r["check_name"] for r in gate if not r["passed"]} == {"min_rows"}


def test_one_row_and_all_null_amounts(frame):
    got = quality.quality_report(frame([event("a")]), as_of=T0 + timedelta(hours=2)).first()
    assert got["quality_score"] == 100.0
    assert got["outlier_records"] == 0
    assert got["staleness_hours"] == pytest.approx(2.0)


def test_score_formula_and_bounds(frame):
    rows = [event("a"), event("a"), event(None, kind=None), event("b")]
    got = quality.quality_report(frame(rows)).first()
    assert got["quality_score"] == pytest.approx(100 - (2 / 4 * 30 + 1 / 4 * 20))
    worst = [event(None, kind=None, user_id=None, timestamp=None) for _ in range(5)]
    assert quality.quality_report(frame(worst)).first()["quality_score"] == 0.0


def test_null_keys_are_one_group_of_duplicates(frame):
    rows = [event(None), event(None), event(None), event("a")]
    assert quality.duplicate_count(frame(rows), ["event_id"]).first()[0] == 2


def test_outliers_against_three_sigma(frame):
    rows = [event(str(i), amount=float(i % 3)) for i in range(60)] + [event("x", amount=500.0)]
    assert quality.outlier_count(frame(rows)).first()[0] == 1


def test_schema_compliance_uses_the_files_own_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).selectExpr("id as a", "cast(id as string) as b").write.parquet(path)
    expected = T.StructType().add("a", T.IntegerType()).add("c", T.StringType())
    verdict = quality.schema_compliance(spark.read.parquet(path), expected)
    assert {r["column_name"]: r["issue"] for r in verdict.collect()} == {
        "a": "type",
        "b": "extra",
        "c": "missing",
    }
    got = quality.is_compliant(verdict).first()
    assert (got["missing_columns"], got["extra_columns"], got["is_compliant"]) == (["c"], ["b"], False)


def test_profile_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    got = quality.column_profile(df).first()
    assert (got["null_count"], got["distinct_count"]) == (1, 2)
    assert quality.column_profile(df.limit(0)).first()["distinct_count"] == 0


def test_split_rows_names_broken_rules(frame):
    rules = {"id": F.col("event_id").isNotNull(), "amount": F.col("amount") > 0}
    good, bad = quality.split_rows(frame([event("a", amount=1.0), event(None)]), rules)
    assert good.count() == 1
    assert bad.first()["broken_rules"] == ["id", "amount"]


# --- summaries


def test_summary_counts_add_up_and_users_are_distinct(frame):
    rows = [event(str(i), user=i % 3, minute=i, amount=10.0) for i in range(120)]
    detail = clean.prepare_day(frame(rows))
    hourly = summary.with_ratios(summary.hourly_summary(detail))
    assert hourly.agg(F.sum("event_count")).first()[0] == 120
    assert {r["unique_users"] for r in hourly.collect()} == {3}
    rollup = summary.daily_rollup(hourly).first()
    exact = summary.daily_rollup_exact(detail).first()
    assert (rollup["total_unique_users"], exact["distinct_users"]) == (6, 3)


# --- windows


def test_every_event_is_in_duration_over_slide_windows(frame):
    rows = [event(str(i), user=i, minute=i * 1.7) for i in range(50)]
    got = windows.window_agg(frame(rows), keys=["event_type"])
    assert got.agg(F.sum("event_count")).first()[0] == 50 * 5


def random_events(seed, n=400, users=3, kinds=("VIEW", "ADD_TO_CART", "PURCHASE", "SEARCH")):
    rng = random.Random(seed)
    return [
        event(str(i), user=rng.randrange(users), minute=rng.randrange(600) / 4, kind=rng.choice(kinds))
        for i in range(n)
    ]


@pytest.mark.parametrize("n", [40, 400])
def test_sessions_equal_sparks_session_windows(frame, n):
    df = frame(random_events(n, n))
    ours = windows.user_sessions(df, gap="2 minutes").drop("session_value")
    theirs = (
        df.groupBy("user_id", F.session_window("timestamp", "2 minutes").alias("w"))
        .agg(F.count("*").alias("events_in_session"))
        .select("user_id", F.col("w.start"), F.col("w.end"), "events_in_session")
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def test_a_pause_of_exactly_the_gap_does_not_split(frame):
    df = frame([event("a", minute=0), event("b", minute=10), event("c", minute=20.1)])
    got = windows.user_sessions(df, gap="10 minutes").orderBy("session_start").collect()
    assert [r["events_in_session"] for r in got] == [2, 1]


def brute_ordered(rows, pattern, width, slide):
    found = set()
    for user in {r["user_id"] for r in rows}:
        mine = sorted((r["timestamp"], r["event_type"]) for r in rows if r["user_id"] == user)
        start = T0 - timedelta(minutes=width)
        while start <= mine[-1][0]:
            end, done, at = start + timedelta(minutes=width), 0, None
            for t, kind in mine:
                if start <= t < end and done < len(pattern) and kind == pattern[done]:
                    if at is None or t > at:
                        done, at = done + 1, t
            if done == len(pattern):
                found.add((user, start))
            start += timedelta(minutes=slide)
    return found


@pytest.mark.parametrize("chunk", ["1 minute", "5 minutes"])
def test_ordered_pattern_against_brute_force(frame, chunk):
    rows = random_events(3, 250)
    got = windows.match_ordered(frame(rows), chunk=chunk)
    expected = brute_ordered(rows, schema.PURCHASE_PATTERN, 20, 5)
    assert {(r["user_id"], r["window_start"]) for r in got.collect()} == expected
    assert expected


def test_same_time_is_not_later(frame):
    rows = [event("a", kind="VIEW"), event("b", kind="ADD_TO_CART"), event("c", minute=1, kind="PURCHASE")]
    assert windows.match_ordered(frame(rows)).isEmpty()


def test_counted_types_agree_with_listed_types(frame):
    df = frame(random_events(5, 120))
    free = windows.match_all(windows.user_windows(df))
    fixed = windows.match_all(windows.user_windows(df, types=schema.PURCHASE_PATTERN))
    keys = ["user_id", "window_start", "events_in_session"]
    assert sorted(map(tuple, free.select(keys).collect())) == sorted(
        map(tuple, fixed.select(keys).collect())
    )


def test_sequence_is_written_out(frame):
    df = frame([event("a"), event("b"), event("c", kind="SEARCH"), event("d", kind=None)])
    got = windows.user_windows(df, slide="20 minutes").select(
        windows.event_sequence(F.col("type_counts")).alias("s"), "events_in_session"
    )
    assert tuple(got.first()) == (["SEARCH", "VIEW", "VIEW"], 4)


# --- runs


def brute_degraded(rows, n, factor):
    found, seen = set(), {}
    for op, start, seconds in sorted(rows, key=lambda r: (r[0], r[1])):
        last = seen.setdefault(op, [])
        last.append(seconds)
        if len(last) >= n and seconds > factor * sum(last[-n:]) / n:
            found.add((op, start))
    return found


@pytest.mark.parametrize("chunk", ["10 minutes", "1 hour", "1 day"])
def test_degradation_crosses_chunk_borders(spark, chunk):
    rng = random.Random(1)
    rows = [
        ("a" if rng.random() < 0.8 else "b", T0 + timedelta(minutes=7 * i), float(rng.choice([1, 1, 1, 9])))
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "operation string, start_time timestamp, duration_seconds double")
    got = runs.degraded_runs(df, chunk=chunk)
    assert {(r["operation"], r["start_time"]) for r in got.collect()} == brute_degraded(rows, 5, 1.5)


def test_zero_duration_run(spark):
    df = spark.createDataFrame([("a", T0, T0, 5)], schema.RUN)
    got = runs.with_run_metrics(df).first()
    assert (got["duration_seconds"], got["throughput_per_second"]) == (0.0, 0.0)


def test_histogram_ends_with_the_count_and_quantiles_interpolate(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 700)], "v double")
    hist = runs.bucket_counts(df, "v", [2, 4, 600])
    assert [tuple(r) for r in hist.orderBy("le").collect()] == [
        (2.0, 2),
        (4.0, 4),
        (600.0, 4),
        (float("inf"), 5),
    ]
    assert runs.bucket_quantile(hist, 0.5).first()[0] == pytest.approx(2.5)
    assert runs.bucket_quantile(hist, 0.99).first()[0] == 600.0
    assert runs.bucket_quantile(hist, 0.2).first()[0] == pytest.approx(1.0)


def test_durations():
    assert runs.seconds_in("5 minutes") == 300
    with pytest.raises(ValueError):
        runs.seconds_in("soon")


def test_error_rate_and_slow_runs(frame, spark):
    rows = [event("a", kind="ERROR"), event("b"), event("c", minute=6)]
    got = alerts.error_rate(frame(rows)).collect()
    assert [(r["error_count"], r["error_rate"]) for r in got] == [(1, 0.5)]


# --- joins


def test_salted_join_equals_plain_join(spark, plan):
    left = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    right = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    right = right.unionByName(right)
    got = joins.salted_join(left, right, ["k"], salts=4, share=0.1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
    assert joins.hot_keys(left, ["k"], 0.1).collect()[0]["k"] == 7


def test_lookup_is_broadcast_only_when_small(spark, plan):
    left, right = spark.range(1000).toDF("k"), spark.range(50).toDF("k")
    assert "BroadcastHashJoin" in plan(joins.lookup_join(left, right, ["k"], max_rows=50))
    assert "SortMergeJoin" in plan(joins.lookup_join(left, right, ["k"], max_rows=49))
    assert "SortMergeJoin" in plan(joins.merge_join(left, right, ["k"]))
    wide = right.withColumn("text", F.repeat(F.lit("x"), 1000))
    assert "SortMergeJoin" in plan(joins.lookup_join(left, wide, ["k"], max_bytes=50_000))
    assert joins.fits_broadcast(wide.limit(0))
    assert joins.fits_broadcast(wide.withColumn("a", F.array("k")), max_bytes=60_000)


def test_stats_stay_in_the_plan(spark, plan):
    df = spark.range(10).select(F.col("id").cast("double").alias("x"))
    got = joins.with_stats(df, ["x"])
    assert got.first()["x_mean"] == 4.5
    assert "CartesianProduct" not in plan(got) and "NestedLoop" not in plan(got)


# --- sources and layout


@pytest.fixture
def days(frame, tmp_path):
    rows = [event(str(i), minute=i * 100, amount=float(i)) for i in range(60)]
    df = frame(rows).withColumn("date", F.to_date("timestamp"))
    path = str(tmp_path / "days")
    layout.write_partitioned(df, path, ["date"])
    return path


def test_day_scan_prunes_partitions_and_pushes_filters(spark, days, plan):
    df = batch.read_events(spark, days, dates=["2024-01-02"]).where("amount > 3").select("amount")
    text = plan(df)
    assert "PartitionFilters: [isnotnull(date" in text
    assert "GreaterThan(amount,3.0)" in text
    assert "ReadSchema: struct<amount:double>" in text
    assert df.count() > 0


def test_schema_stays_as_given(spark, days):
    before = len(schema.EVENT.fields)
    batch.read_events(spark, days)
    assert len(schema.EVENT.fields) == before


def test_rewriting_a_day_leaves_the_others(spark, days):
    day = batch.read_events(spark, days, dates=["2024-01-02"]).where("amount < 20").collect()
    df = spark.createDataFrame(day, T.StructType([*NULLABLE.fields, T.StructField("date", T.DateType())]))
    others = batch.read_events(spark, days).where("date <> '2024-01-02'").count()
    assert layout.write_partitioned(df, days, ["date"]) == len(day)
    assert batch.read_events(spark, days).count() == others + len(day)


def test_run_day(spark, days, tmp_path, frame):
    target = str(tmp_path / "out")
    for _ in range(2):
        got = run_day(spark, days, target, "2024-01-02", as_of=T0).first()
    detail = spark.read.parquet(f"{target}/detailed")
    assert got["detail_rows"] == detail.count() > 0
    assert spark.read.parquet(f"{target}/summary").agg(F.sum("event_count")).first()[0] == got["detail_rows"]
    assert got["rollup_rows"] == spark.read.parquet(f"{target}/daily_rollup").count()
    assert spark.read.parquet(f"{target}/quality").count() == 1
    assert spark.read.parquet(f"{target}/runs").first()["records_processed"] == got["detail_rows"]


def test_run_day_drops_what_another_day_has_kept(spark, tmp_path, frame):
    rows = [event(str(i), minute=i * 100) for i in range(30)]  # 15 on each of the first two days
    rows += [event(str(i), minute=1440 + i) for i in range(5)]  # again on the second day
    source, target = str(tmp_path / "days"), str(tmp_path / "out")
    df = frame(rows).withColumn("date", F.to_date("timestamp"))
    layout.write_partitioned(df, source, ["date"])
    ledger = KeyLedger(spark, str(tmp_path / "ledger"), "ledger_days", buckets=4)
    kept = [
        run_day(spark, source, target, date, as_of=T0, ledger=ledger).first()["detail_rows"]
        for date in ("2024-01-01", "2024-01-02", "2024-01-01", "2024-01-02")
    ]
    assert kept == [15, 14, 15, 14]
    detail = spark.read.parquet(f"{target}/detailed")
    assert detail.count() == detail.select("event_id").distinct().count() == 29


def test_run_day_without_events(spark, days, tmp_path):
    for date, types in (("2031-01-01", ["VIEW"]), ("2024-01-02", ["NO SUCH TYPE"])):
        target = str(tmp_path / date)
        got = run_day(spark, days, target, date, types=types, as_of=T0).first()
        assert tuple(got)[1:] == (0, 0, 0)
        report = spark.read.parquet(f"{target}/quality")
        empty = {r["check_name"]: r["passed"] for r in quality.quality_gate(report).collect()}
        assert empty["min_rows"] is (date == "2024-01-02")


def test_run_day_wants_the_zone_of_the_dates(spark, days, tmp_path):
    with pytest.raises(ValueError, match="time zone"):
        run_day(spark, days, str(tmp_path / "o"), "2024-01-02", zone="Asia/Tokyo")


def test_empty_frames_are_written(spark, tmp_path):
    path = str(tmp_path / "none")
    assert layout.write_partitioned(spark.range(0).withColumn("p", F.lit(1)), path, ["p"]) == 0


def test_only_the_rows_of_this_write_are_counted(spark, tmp_path):
    df = spark.range(100).withColumn("p", F.col("id") % 4)
    for fmt in ("parquet", "json", "orc"):
        path = str(tmp_path / fmt)
        assert layout.write_partitioned(df, path, ["p"], fmt=fmt) == 100
        assert layout.write_partitioned(df.where("p = 1"), path, ["p"], fmt=fmt) == 25
        assert layout.write_partitioned(df.limit(0), path, ["p"], fmt=fmt) == 0
        assert spark.read.format(fmt).load(path).count() == 100
        assert layout.write_small(df, str(tmp_path / f"one-{fmt}"), ["id"], fmt=fmt) == 100


def test_compaction_keeps_rows_and_cuts_files(spark, tmp_path):
    source, target, by = (str(tmp_path / n) for n in ("many", "few", "by"))
    spark.range(1000).withColumn("p", F.col("id") % 3).repartition(20).write.parquet(source)
    got = layout.compact(spark, source, target).first()
    assert got["rows_before"] == got["rows_after"] == 1000
    assert len(spark.read.parquet(target).inputFiles()) == 1
    layout.compact(spark, source, by, by=["p"])
    assert len(spark.read.parquet(by).inputFiles()) == 3


def test_clustering_splits_a_hot_value(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "c")
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 10).alias("k"),
        F.xxhash64("id").alias("v"),
    )
    rows.write.parquet(source)
    assert layout.cluster_table(spark, source, target, ["k"], target_mb=1) == 400_000
    files = spark.read.parquet(target).select("k", F.input_file_name().alias("f"))
    sizes = [r["count"] for r in files.groupBy("f").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 2 * 400_000 / len(sizes)
    assert files.where("k = 5").select("f").distinct().count() > 1
    spread = files.groupBy("f").agg(F.count_distinct("k").alias("n"))
    assert spread.agg(F.max("n")).first()[0] < 10


def test_clustering_reads_small_splits(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "s"), str(tmp_path / "c")
    spark.range(1600).repartition(16).write.parquet(source)
    monkeypatch.setattr(layout, "SPLIT", "1m")  # less than Spark's cost of opening a file
    spark.sparkContext.setJobGroup("splits", "splits")
    try:
        assert layout.cluster_table(spark, source, target, ["id"]) == 1600
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker()
    stages = [s for j in jobs.getJobIdsForGroup("splits") for s in jobs.getJobInfo(j).stageIds]
    found = [info.numTasks for s in stages if (info := jobs.getStageInfo(s))]
    assert max(found) == 16


def test_cached_lets_go(spark):
    with layout.cached(spark.range(5)) as held:
        assert held.storageLevel.useMemory
    assert not held.storageLevel.useMemory


def test_merged_permissive_and_probe(spark, tmp_path):
    a, b = str(tmp_path / "in/a"), str(tmp_path / "in/b")
    spark.range(2).toDF("x").write.parquet(a)
    spark.range(3).select(F.col("id").alias("y")).write.parquet(b)
    merged = batch.read_merged(spark, [a, b])
    assert merged.columns == ["x", "y"] and merged.count() == 5
    (tmp_path / "in/broken.parquet").write_text("no parquet")
    assert batch.read_permissive(spark, str(tmp_path / "in")).count() == 5
    probe = batch.probe_paths(spark, [a, str(tmp_path / "none")]).collect()
    assert [(r["readable"], r["has_data"]) for r in probe] == [(True, True), (False, None)]


def test_count_by(spark, frame):
    got = batch.count_by(spark, frame([event("a"), event("b")]), "event_type")
    assert [tuple(r) for r in got.collect()] == [("VIEW", 2)]


def test_quantile_with_a_bound_of_zero(spark):
    values = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (5.0,)], "v double")
    hist = runs.bucket_counts(values, "v", schema.SCORE_BOUNDS)
    assert [r["quantile"] for r in runs.bucket_quantile(hist, 0.5).collect()] == [0.0]
    assert [r["quantile"] for r in runs.bucket_quantile(hist, 1.0).collect()] == [10.0]
    low = runs.bucket_counts(values.withColumn("v", F.col("v") - 20), "v", (-20, -10, 0))
    assert [r["quantile"] for r in runs.bucket_quantile(low, 0.5).collect()] == [-20.0]
    assert runs.bucket_quantile(runs.bucket_counts(values.limit(0), "v"), 0.5).count() == 0


def test_salted_join_with_maps(spark):
    left = spark.range(100).select(
        (F.col("id") % 3).alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"),
        F.array(F.create_map(F.lit("a"), F.col("id"))).alias("nested"),
    )
    right = spark.createDataFrame([(0, "x"), (1, "y")], "k long, name string")
    assert joins.salted_join(left, right, ["k"], salts=4, share=0.2).count() == 67
    with pytest.raises(ValueError, match="hot"):
        joins.salted_join(left, right, ["k"], share=0.5, hot=left.select("k").distinct()).count()


def test_null_counts_of_a_column_named_rows(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "rows long, entries string")
    got = {r["column_name"]: r["null_count"] for r in quality.null_counts(df).collect()}
    assert got == {"rows": 1, "entries": 2}


def test_ordered_pattern_spans_must_be_multiples(frame):
    with pytest.raises(ValueError, match="multiples"):
        windows.match_ordered(frame([]), slide="90 seconds", chunk="1 minute")


def test_ordered_pattern_of_one_busy_minute(spark):
    """200,000 events of one user in a minute: lists stay as short as their level."""
    kinds = F.array(*[F.lit(k) for k in ("PURCHASE", "ADD_TO_CART", "VIEW")])
    start = F.lit(1_704_067_200_000_000)
    busy = spark.range(200_000).select(
        F.lit(1).cast("long").alias("user_id"),
        F.timestamp_micros(start + F.col("id") * 290).alias("timestamp"),
        F.get(kinds, F.pmod("id", F.lit(3)).cast("int")).alias("event_type"),
    )
    assert windows.match_ordered(busy).count() == 4
    backwards = busy.withColumn(
        "timestamp",
        F.timestamp_micros(
            start + F.when(F.col("event_type") == "VIEW", 50_000_000)
            .when(F.col("event_type") == "ADD_TO_CART", 40_000_000)
            .otherwise(30_000_000)
        ),
    )
    assert windows.match_ordered(backwards).count() == 0


def test_user_windows_fold_before_they_copy(frame, plan):
    rows = frame([])
    for counted in (
        windows.user_windows(rows),
        windows.user_windows(rows, types=["VIEW"]),
        windows.window_agg(rows, exact_users=False),
    ):
        tree = plan(counted).split("\n\n")[0]
        first = max(tree.rfind("HashAggregate"), tree.rfind("SortAggregate"))
        assert tree.rfind("Expand") < first


def test_estimated_users_of_sliding_windows(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 50).alias("user_id"),
        F.timestamp_seconds(1_704_067_200 + F.col("id")).alias("timestamp"),
        F.lit("VIEW").alias("event_type"),
        F.lit("c").alias("category"),
        F.lit(1.0).alias("amount"),
    )
    exact, near = (
        {r["window_start"]: r for r in windows.window_agg(rows, exact_users=e).collect()}
        for e in (True, False)
    )
    assert exact.keys() == near.keys()
    for start, r in exact.items():
        assert near[start]["event_count"] == r["event_count"]
        assert abs(near[start]["unique_users"] - r["unique_users"]) <= 2


def test_skipped_files_are_named(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "broken.parquet").write_bytes(b"no table")
    assert batch.read_permissive(spark, str(tmp_path / "t")).count() == 5
    [gone] = batch.skipped_files(spark, str(tmp_path / "t")).collect()
    assert gone["file"].endswith("broken.parquet") and gone["bytes"] == 8


def test_scratch_is_removed(spark, tmp_path):
    from clickweir.workspace import materialise, scratch

    with scratch(spark) as folder:
        assert materialise(spark.range(3)).count() == 3
        assert Path(folder).exists()
    assert not Path(folder).exists()
