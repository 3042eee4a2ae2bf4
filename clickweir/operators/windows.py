"""Time-window aggregates, sessions and event patterns.

The functions take batch and streaming frames. On a stream they set the
watermark and run in append mode: a group comes out once its window closed.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir import schema
from clickweir.operators.runs import seconds_in


def _watermarked(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    return df.withWatermark(ts, delay) if df.isStreaming and delay else df


def _flat(df: DataFrame) -> DataFrame:
    """The window struct as two plain columns."""
    return df.withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    ).drop("window")


def _pane(duration: str, slide: str) -> str:
    """The widest span of time that all windows contain wholly or not at all."""
    return f"{gcd(seconds_in(duration), seconds_in(slide))} seconds"


def window_agg(
    df: DataFrame,
    *,
    duration: str = "5 minutes",
    slide: str | None = "1 minute",
    keys: Sequence[str] = ("event_type", "category"),
    ts: str = "timestamp",
    user: str = "user_id",
    amount: str = "amount",
    delay: str | None = "10 minutes",
    exact_users: bool = True,
) -> DataFrame:
    """Count, amount statistics and distinct users per window and ``keys``.

    ``slide=None`` gives tumbling windows. Exact distinct users come from a
    first aggregate per (window, keys, user), which spreads a busy window over
    all its users; no group holds a list. ``exact_users=False`` estimates them
    in one aggregate with a small fixed state per group.
    """
    marked = _watermarked(df, ts, delay)
    span = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    total = F.sum(amount).alias("total_amount")
    if not exact_users and slide and not df.isStreaming:
        panes = df.groupBy(F.window(ts, _pane(duration, slide))["start"].alias("pane"), *keys).agg(
            F.count("*").alias("events"),
            F.sum(amount).alias("amount_sum"),
            F.count(amount).alias("amount_n"),
            F.max(amount).alias("amount_max"),
            F.hll_sketch_agg(user).alias("users"),
        )
        return _flat(
            panes.groupBy(F.window("pane", duration, slide).alias("window"), *keys).agg(
                F.sum("events").alias("event_count"),
                F.sum("amount_sum").alias("total_amount"),
                F.try_divide(F.sum("amount_sum"), F.sum("amount_n")).alias("avg_amount"),
                F.max("amount_max").alias("max_amount"),
                F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_users"),
            )
        )
    if not exact_users:
        return _flat(
            marked.groupBy(span.alias("window"), *keys).agg(
                F.count("*").alias("event_count"),
                total,
                F.avg(amount).alias("avg_amount"),
                F.max(amount).alias("max_amount"),
                F.approx_count_distinct(user).alias("unique_users"),
            )
        )
    per_user = marked.groupBy(span.alias("window"), *keys, user).agg(
        F.count("*").alias("events"),
        F.sum(amount).alias("amount_sum"),
        F.count(amount).alias("amount_n"),
        F.max(amount).alias("amount_max"),
    )
    return _flat(
        per_user.groupBy("window", *keys).agg(
            F.sum("events").alias("event_count"),
            F.sum("amount_sum").alias("total_amount"),
            F.try_divide(F.sum("amount_sum"), F.sum("amount_n")).alias("avg_amount"),
            F.max("amount_max").alias("max_amount"),
            F.count(user).alias("unique_users"),
        )
    )


def user_windows(
    df: DataFrame,
    *,
    duration: str = "20 minutes",
    slide: str = "5 minutes",
    ts: str = "timestamp",
    user: str = "user_id",
    amount: str = "amount",
    delay: str | None = "30 minutes",
    types: Sequence[str] | None = None,
) -> DataFrame:
    """Per user and overlapping window: events, value, last activity, and which types.

    ``type_counts`` holds the events of the window as sorted ``(event_type, n)``
    pairs. It says the same as a list of all types in no particular order, but
    its size is the number of types, however busy the user.

    Given ``types``, only those are counted, with one counter each in a single
    aggregate: one shuffle less, and on a stream update mode is possible.

    A batch table is first folded to one row per (pane, user) or (pane, user,
    type); only those rows are copied into the windows they belong to.
    """
    if not df.isStreaming:
        return _user_windows_by_pane(df, duration, slide, ts, user, amount, types)
    marked = _watermarked(df, ts, delay)
    span = F.window(ts, duration, slide).alias("window")
    if types is not None:
        pairs = F.array(
            *[
                F.struct(F.lit(t).alias("event_type"), F.col(f"_n{i}").alias("n"))
                for i, t in sorted(enumerate(types), key=lambda pair: pair[1])
            ]
        )
        counted = marked.groupBy(span, user).agg(
            F.count("*").alias("events_in_session"),
            *[F.count_if(F.col("event_type") == t).alias(f"_n{i}") for i, t in enumerate(types)],
            F.sum(amount).alias("session_value"),
            F.max(ts).alias("last_activity"),
        )
        return _flat(
            counted.select(
                "window",
                user,
                "events_in_session",
                F.filter(pairs, lambda pair: pair["n"] > 0).alias("type_counts"),
                "session_value",
                "last_activity",
            )
        )
    per_type = marked.groupBy(span, user, "event_type").agg(
        F.count("*").alias("events"),
        F.sum(amount).alias("amount_sum"),
        F.max(ts).alias("last_ts"),
    )
    return _flat(
        per_type.groupBy("window", user).agg(
            F.sum("events").alias("events_in_session"),
            F.sort_array(
                F.collect_list(F.struct("event_type", F.col("events").alias("n")))
            ).alias("type_counts"),
            F.sum("amount_sum").alias("session_value"),
            F.max("last_ts").alias("last_activity"),
        )
    )


def _user_windows_by_pane(df, duration, slide, ts, user, amount, types) -> DataFrame:
    pane = F.window(ts, _pane(duration, slide))["start"].alias("pane")
    span = F.window("pane", duration, slide).alias("window")
    folded = [F.sum(amount).alias("amount_sum"), F.max(ts).alias("last_ts")]
    totals = [
        F.sum("amount_sum").alias("session_value"),
        F.max("last_ts").alias("last_activity"),
    ]
    if types is not None:
        counts = [
            F.count_if(F.col("event_type") == t).alias(f"_n{i}") for i, t in enumerate(types)
        ]
        panes = df.groupBy(pane, user).agg(F.count("*").alias("events"), *counts, *folded)
        pairs = F.array(
            *[
                F.struct(F.lit(t).alias("event_type"), F.sum(f"_n{i}").alias("n"))
                for i, t in sorted(enumerate(types), key=lambda pair: pair[1])
            ]
        )
        counted = panes.groupBy(span, user).agg(
            F.sum("events").alias("events_in_session"),
            F.filter(pairs, lambda pair: pair["n"] > 0).alias("type_counts"),
            *totals,
        )
        return _flat(counted)
    panes = df.groupBy(pane, user, "event_type").agg(F.count("*").alias("n"), *folded)
    listed = panes.groupBy(span, user).agg(
        F.sum("n").alias("events_in_session"),
        F.collect_list(F.struct("event_type", "n")).alias("pairs"),
        *totals,
    )

    def of_type(kind: Column) -> Column:
        same = F.filter("pairs", lambda pair: pair["event_type"].eqNullSafe(kind))
        n = F.aggregate(same, F.lit(0).cast("long"), lambda total, pair: total + pair["n"])
        return F.struct(kind.alias("event_type"), n.alias("n"))

    kinds = F.array_distinct(F.transform("pairs", lambda pair: pair["event_type"]))
    return _flat(
        listed.select(
            "window",
            user,
            "events_in_session",
            F.sort_array(F.transform(kinds, of_type)).alias("type_counts"),
            "session_value",
            "last_activity",
        )
    )


def event_count(type_counts: Column) -> Column:
    """Events in ``type_counts`` that have a type: the length of the written-out sequence."""
    known = F.filter(type_counts, lambda pair: pair["event_type"].isNotNull())
    return F.aggregate(known, F.lit(0).cast("long"), lambda total, pair: total + pair["n"])


def event_sequence(type_counts: Column) -> Column:
    """``type_counts`` written out as a list of types, null types left out.

    One entry per event, so for small windows; ``event_count`` has its length.
    """
    return F.flatten(
        F.transform(
            F.filter(type_counts, lambda pair: pair["event_type"].isNotNull()),
            lambda pair: F.array_repeat(pair["event_type"], pair["n"].cast("int")),
        )
    )


def has_all_types(type_counts: Column, pattern: Sequence[str]) -> Column:
    """True when every type of ``pattern`` occurs."""
    types = F.transform(type_counts, lambda pair: pair["event_type"])
    hit = F.lit(True)
    for step in pattern:
        hit = hit & F.coalesce(F.array_contains(types, step), F.lit(False))
    return hit


def match_all(
    windows: DataFrame, pattern: Sequence[str] = schema.PURCHASE_PATTERN
) -> DataFrame:
    """Windows of ``user_windows`` in which all types of ``pattern`` occur, in any order."""
    flagged = windows.withColumn(
        "has_purchase_pattern", has_all_types(F.col("type_counts"), pattern)
    )
    return flagged.where("has_purchase_pattern")


def _composed(moves: Column, size: int) -> Column:
    """One table of moves for several in order: steps done after, by steps done before."""

    def from_state(start: int) -> Column:
        return F.aggregate(
            moves, F.lit(start), lambda state, part: F.get(part["move"], state)
        )

    return F.array(*[from_state(start) for start in range(size)], F.lit(size))


def match_ordered(
    df: DataFrame,
    *,
    pattern: Sequence[str] = schema.PURCHASE_PATTERN,
    duration: str = "20 minutes",
    slide: str = "5 minutes",
    chunk: str = "1 minute",
    instant: str = "10 milliseconds",
    ts: str = "timestamp",
    user: str = "user_id",
    delay: str | None = "30 minutes",
) -> DataFrame:
    """User windows in which the types of ``pattern`` follow one another in time.

    Each step must come strictly later than the one before it, so the events of
    one user at one exact time make at most one step: they are one row with the
    steps seen there as bits. Tables of moves (steps done at the end, by steps
    done at the start) can be put one after the other, so they are composed in
    levels: the times of an ``instant`` (at most its microseconds), the instants
    of a ``chunk``, the chunks of a window. No row gathers more than the level
    above holds of the level below, however many events a user has.
    ``slide`` and ``duration`` must be multiples of ``chunk``.
    """
    size = len(pattern)
    if any(seconds_in(span) % seconds_in(chunk) for span in (duration, slide)):
        raise ValueError(f"{duration} and {slide} must be multiples of {chunk}")
    steps = F.lit(0)
    for kind in dict.fromkeys(pattern):
        bits = sum(1 << i for i, step in enumerate(pattern) if step == kind)
        steps = F.when(F.col("event_type") == kind, bits).otherwise(steps)
    marked = _watermarked(
        df.select(user, ts, "event_type").where(F.col("event_type").isin(*pattern)),
        ts,
        delay,
    )
    # As a number: a stream may have only one event time column.
    at = F.unix_micros(F.col(ts).cast("timestamp")).alias("at")
    times = marked.groupBy(F.window(ts, instant).alias("part"), user, at).agg(
        F.bit_or(steps).alias("steps")
    )

    def after(state: Column, time: Column) -> Column:
        return state + F.getbit(time["steps"].cast("long"), state).cast("int")

    def level(rows: DataFrame, span: Column) -> DataFrame:
        listed = rows.groupBy(span.alias("next"), user).agg(
            F.sort_array(
                F.collect_list(F.struct(F.col("part.start").alias("at"), "move"))
            ).alias("moves")
        )
        return listed.select(
            F.col("next").alias("part"), user, _composed(F.col("moves"), size).alias("move")
        )

    instants = times.groupBy("part", user).agg(
        F.sort_array(F.collect_list(F.struct("at", "steps"))).alias("times")
    )
    moves = instants.select(
        "part",
        user,
        F.array(
            *[F.aggregate("times", F.lit(start), after) for start in range(size)], F.lit(size)
        ).alias("move"),
    )
    chunks = level(moves, F.window(F.window_time("part"), chunk))
    spans = level(chunks, F.window(F.window_time("part"), duration, slide))
    matched = spans.where(F.get("move", F.lit(0)) == size)
    return _flat(matched.select(F.col("part").alias("window"), user))


def user_sessions(
    df: DataFrame,
    *,
    gap: str = "30 minutes",
    ts: str = "timestamp",
    user: str = "user_id",
    amount: str = "amount",
    delay: str | None = "30 minutes",
) -> DataFrame:
    """Sessions per user: runs of events with no pause longer than ``gap``.

    ``session_end`` is the last event plus ``gap``. Streams use Spark's
    session windows; start them with ``settings=LOCAL_SESSIONS`` (of
    ``streaming.run``), so that a hot user's events are folded to sessions in every
    task before the shuffle. The batch form first folds the events of each (user,
    gap-long slot) into one row - two events of a slot are always in one
    session - so the ordered pass per user sees slots and not events.
    """
    events = F.count("*").alias("events_in_session")
    value = F.sum(amount).alias("session_value")
    if df.isStreaming:
        spans = (
            _watermarked(df, ts, delay)
            .groupBy(F.session_window(ts, gap).alias("window"), user)
            .agg(events, value)
        )
        return spans.select(
            user,
            F.col("window.start").alias("session_start"),
            F.col("window.end").alias("session_end"),
            "events_in_session",
            "session_value",
        )
    pause = F.expr(f"interval '{gap}'")
    slots = df.groupBy(user, F.window(ts, gap).alias("slot")).agg(
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.count("*").alias("events"),
        F.sum(amount).alias("amount_sum"),
    )
    in_order = Window.partitionBy(user).orderBy("first_ts")
    opened = F.coalesce(
        F.col("first_ts") > F.lag("last_ts").over(in_order) + pause, F.lit(True)
    )
    numbered = slots.withColumn("opened", opened.cast("long")).withColumn(
        "session", F.sum("opened").over(in_order)
    )
    return (
        numbered.groupBy(user, "session")
        .agg(
            F.min("first_ts").alias("session_start"),
            (F.max("last_ts") + pause).alias("session_end"),
            F.sum("events").alias("events_in_session"),
            F.sum("amount_sum").alias("session_value"),
        )
        .drop("session")
    )


def open_only(windows: DataFrame, events: DataFrame, ts: str, delay: str) -> DataFrame:
    """The batch windows that ``closed_only`` leaves out.

    A drained append-mode stream still holds them: computed from the stored
    events they complete what it has written.
    """
    latest = F.date_trunc("millisecond", events.agg(F.max(ts)).scalar())
    return windows.where(F.col("window_end") > latest - F.expr(f"interval '{delay}'"))


def closed_only(windows: DataFrame, events: DataFrame, ts: str, delay: str) -> DataFrame:
    """Batch windows that an append-mode stream over the same events would have emitted."""
    latest = events.agg(F.max(ts)).scalar()
    return windows.where(F.col("window_end") <= latest - F.expr(f"interval '{delay}'"))
