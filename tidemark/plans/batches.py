"""Stored/new batches and audit rows derived from the events table.

The events table spans 30 days. The *stored* layer is every event before
``SPLIT_AT``; the *new* batch is every event from ``NEW_FROM`` on, so the
two overlap for five days (late, re-delivered data) and together cover the
whole table. Both are day-partitioned by ``transaction_date``; the new
batch carries one extra column (``batch``) to show which side a merged row
came from.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.casts import conform
from tidemark.operators.audit import STATUS_COMPLETED, STATUS_FAILED, STATUS_STARTED, format_time_utc
from tidemark.plans.tables import load
from tidemark.schema import EVENT_SPEC, PARTITION_COLUMN

# Fixed values of the batch split.
SPLIT_AT = _dt.datetime(2024, 1, 20)
NEW_FROM = _dt.datetime(2024, 1, 15)
EVENT_KEYS = ["event_id", PARTITION_COLUMN]


def _ntz(t: _dt.datetime):
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = conform(load(spark, sf_dir, "events"), EVENT_SPEC)
    return events.withColumn(PARTITION_COLUMN, F.to_date("ts"))


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rows(spark, sf_dir).where(F.col("ts") < _ntz(SPLIT_AT))


def new_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rows(spark, sf_dir).where(F.col("ts") >= _ntz(NEW_FROM)).withColumn("batch", F.lit("new"))


def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit record per event: job = user, start = ts, end = ts + value s,
    status from the event type (error -> FAILED, signup -> Started)."""
    ev = load(spark, sf_dir, "events")
    end = F.timestamp_add("MICROSECOND", (F.col("value") * 1_000_000).cast("bigint"), F.col("ts"))
    status = (
        F.when(F.col("event_type") == "error", F.lit(STATUS_FAILED))
        .when(F.col("event_type") == "signup", F.lit(STATUS_STARTED))
        .otherwise(F.lit(STATUS_COMPLETED))
    )
    return ev.select(
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("etl_run_id"),
        F.concat(F.lit("job_"), F.col("user_id").cast("string")).alias("etl_job_name"),
        format_time_utc(F.col("ts")).alias("etl_start_time"),
        format_time_utc(end).alias("etl_end_time"),
        status.alias("etl_status"),
    )
