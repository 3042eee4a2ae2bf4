"""The daily batch job: check, clean, enrich, write, summarise."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from clickweir import schema
from clickweir.operators import clean, layout, quality, summary
from clickweir.operators.buckets import KeyLedger
from clickweir.sources import batch


def run_day(
    spark: SparkSession,
    source: str,
    target: str,
    date: str,
    *,
    types: Sequence[str] = schema.KEPT_TYPES,
    as_of: datetime | None = None,
    zone: str = "UTC",
    ledger: KeyLedger | None = None,
) -> DataFrame:
    """Process one day of events and return one row with the rows written.

    The detail is written once and the summary is computed from the written
    files; the rollup likewise from the written summary. Nothing is computed
    twice, and all three agree. Every output has one folder per event date, and
    a re-run replaces that folder whole and no other. A day without events, or
    without any that are kept, gives empty outputs. The run itself becomes a
    row of the run history in ``runs``. With a ``ledger`` of event ids, events that
    another day has kept already are dropped, and those kept here are recorded.

    Hours and weekdays follow the time zone of the session, which must be the
    one the dates of ``source`` are in.
    """
    found = spark.conf.get("spark.sql.session.timeZone")
    if found != zone:
        raise ValueError(f"the session's time zone is {found}, the dates are in {zone}")
    began = datetime.now(timezone.utc)
    events = batch.read_events(spark, source, dates=[date])
    report = quality.quality_report(events, as_of=as_of)
    layout.write_small(report, f"{target}/quality/date={date}")

    if ledger:
        events = ledger.unseen(events, "event_id", date)
    detail = clean.prepare_day(events, types=types, as_of=as_of).drop("date")
    detail_path = f"{target}/detailed/date={date}"
    detail_rows = layout.write_partitioned(detail, detail_path, ["hour"], replace="static")

    written = spark.read.schema(detail.schema).parquet(detail_path)
    if ledger:
        ledger.record(written, "event_id", date)
    hourly = summary.with_ratios(summary.hourly_summary(written))
    summary_path = f"{target}/summary/date={date}"
    summary_rows = layout.write_small(hourly, summary_path, ["hour", "event_type"])

    rollup = summary.daily_rollup(spark.read.schema(hourly.schema).parquet(summary_path))
    rollup_rows = layout.write_small(rollup, f"{target}/daily_rollup/date={date}")
    run = [("run_day", began, datetime.now(timezone.utc), detail_rows)]
    spark.createDataFrame(run, schema.RUN).write.mode("overwrite").parquet(
        f"{target}/runs/date={date}"
    )
    return spark.createDataFrame(
        [(date, detail_rows, summary_rows, rollup_rows)],
        "date string, detail_rows long, summary_rows long, rollup_rows long",
    )
