"""Registered queries, one per operator of the inventory.

Fixed parameters (run stamp, window end, batch split) make results
repeatable so they can be compared with the oracle SQL in
``tidemark.plans.oracle``. Queries that exercise sinks write to a fresh
folder under the session's checkpoint root and return what they read back.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import cast_rejects, conform, reject_array, reject_counts, rejected_rows, to_bigint, to_double, to_json_text, to_string, to_timestamp, to_timestamp_ntz
from tidemark.functions.ids import content_id, run_stamp
from tidemark.functions.paths import partition_key, path_date, path_hour, trailing_days_on_date, trailing_days_on_timestamp
from tidemark.operators.audit import METRIC_FIELDS, latest_run, watermark, with_parsed_times
from tidemark.operators.dedup import dedup_by_key, dedup_latest, distinct_rows, dup_count
from tidemark.operators.flatten import flatten_structs
from tidemark.operators.merge import (
    existing_partitions,
    merge_insert_only,
    merge_union,
    restrict_by_frame,
    touched_partitions,
    touched_summary,
)
from tidemark.plans.batches import EVENT_KEYS, NEW_FROM, audit_rows, event_rows, new_events, stored_events
from tidemark.plans.catalog import register
from tidemark.plans.compaction import compact_partitions
from tidemark.plans.etl import read_partitions, scan_window, upsert_partitions
from tidemark.plans.landing import delivery, nested_results, order_envelopes
from tidemark.plans.tables import load
from tidemark.plans.transform import flatten_records, transform
from tidemark.schema import PARTITION_COLUMN, RESULT_SHAPE
from tidemark.session import release_shuffles, scratch_path
from tidemark.sinks.audit import append_audit, read_audit
from tidemark.sinks.parquet import write_partitioned
from tidemark.sinks.retention import drop_expired
from tidemark.sources.files import DAY_PARTITION, file_inventory
from tidemark.sources.ledger import NewFiles
from tidemark.sources.nested import read_nested
from tidemark.sources.partitions import file_system

# Fixed values of the test runs.
RUN_TS = _dt.datetime(2024, 2, 1, 0, 0, 0)
AS_OF = _dt.date(2024, 1, 30)
WINDOW_DAYS = 7
INCREMENTAL_WINDOW_DAYS = 14
RETENTION_DAYS = 10
LAYOUT_MAX_RECORDS = 100
LINE_KEYS = ["l_orderkey", "l_linenumber"]


# -- flatten job and its parts ---------------------------------------------


@register("flatten_pipeline")
def q_flatten_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(nested_results(spark, sf_dir), run_ts=RUN_TS)


DELIVERY_DAY = _dt.date(2024, 1, 30)


def land_nested(spark: SparkSession, sf_dir: str, day=DELIVERY_DAY) -> str:
    """Write the nested records as one delivery under ``date=D/hr=H``."""
    root = scratch_path(spark, "landing")
    nested = delivery(nested_results(spark, sf_dir).drop("source_path"), day)
    write_partitioned(nested, root, ["date", "hr"], mode="error", dynamic=False)
    return root


def _landed_schema(spark: SparkSession, sf_dir: str):
    return nested_results(spark, sf_dir).drop("source_path").schema


@register("scan_nested")
def q_scan_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = land_nested(spark, sf_dir)
    recs = read_nested(spark, root, _landed_schema(spark, sf_dir), fmt="parquet", base_path=root)
    items = F.when(F.col("data").isNull(), F.lit(0)).otherwise(F.size("data"))
    return (
        recs.select(
            F.col("module.o_orderkey").alias("o_orderkey"),
            F.col("customerInfo.c_custkey").alias("c_custkey"),
            items.alias("n"),
            path_date(F.col("source_path")).alias("date_"),
            path_hour(F.col("source_path")).alias("hr_"),
        )
        .groupBy("o_orderkey", "c_custkey", "date_", "hr_")
        .agg(F.sum("n").cast("bigint").alias("n_items"))
    )


@register("file_lineage")
def q_file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = land_nested(spark, sf_dir)
    recs = read_nested(spark, root, _landed_schema(spark, sf_dir), fmt="parquet", base_path=root)
    flat = flatten_records(recs, keep=["source_path"])
    return flat.select(
        "o_orderkey",
        "l_linenumber",
        "l_partkey",
        path_date(F.col("source_path")).alias("date_"),
        path_hour(F.col("source_path")).alias("hr_"),
        F.col("source_path").startswith("file:").alias("is_uri"),
    )


@register("struct_flatten")
def q_struct_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = order_envelopes(load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer"))
    return flatten_structs(env, ["module", "customerInfo"], keep=["source_path"])


@register("explode_records")
def q_explode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_records(nested_results(spark, sf_dir), outer=False)


@register("explode_outer_records")
def q_explode_outer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_records(nested_results(spark, sf_dir), outer=True)


@register("project")
def q_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")


@register("add_columns")
def q_add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.withColumns(
        {
            "l_quantity": to_bigint(F.col("l_quantity")),
            PARTITION_COLUMN: F.to_date("l_shipdate"),
            "ale_transform_time": run_stamp(RUN_TS),
        }
    )


# -- casts ---------------------------------------------------------------------

EVENT_TARGET = [
    ("event_id", "string"),
    ("ts", "timestamp_ntz"),
    ("user_id", "int"),
    ("event_type", "string"),
    ("value", "bigint"),
    ("props", "string"),
    ("props_k", "bigint"),
]


@register("conform_schema")
def q_conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(load(spark, sf_dir, "events"), EVENT_TARGET, missing="null")


def _k_text():
    return F.regexp_extract(F.col("props"), r"([0-9]+)", 1)


@register("cast_bigint")
def q_cast_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    st = T.StringType()
    return ev.select(
        "event_id",
        to_bigint(F.col("value"), T.DoubleType()).alias("value_bigint"),
        to_bigint(F.col("props"), st).alias("props_bigint"),
        to_bigint(_k_text(), st).alias("k_bigint"),
        to_bigint(F.col("event_type"), st).alias("type_bigint"),
        to_bigint(F.col("value").cast("string"), st).alias("value_text_bigint"),
    )


@register("cast_double")
def q_cast_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = T.StringType()
    ev = load(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        to_double(F.col("user_id"), T.LongType()).alias("user_double"),
        to_double(F.col("props"), st).alias("props_double"),
        to_double(_k_text(), st).alias("k_double"),
        to_double(F.col("event_type"), st).alias("type_double"),
    )


@register("cast_whitespace")
def q_cast_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts padded with a tab and a carriage return cast like bare ones."""
    st = T.StringType()
    padded = F.concat(F.lit("\t"), F.col("user_id").cast("string"), F.lit("\r"))
    return load(spark, sf_dir, "events").select(
        "event_id", to_bigint(padded, st).alias("padded_bigint"), to_double(padded, st).alias("padded_double")
    )


@register("cast_string")
def q_cast_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        to_string(F.col("l_orderkey")).alias("orderkey_text"),
        to_string(F.col("l_linenumber")).alias("linenumber_text"),
        to_string(F.col("l_shipdate")).alias("shipdate_text"),
        to_string(F.col("l_returnflag")).alias("l_returnflag"),
    )


@register("array_text")
def q_array_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line numbers of each order: as text the way a cast renders them, and as JSON."""
    li = load(spark, sf_dir, "lineitem")
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("lines"))
    pairs = F.transform("lines", lambda x: F.struct(x.alias("line")))
    return lines.select("l_orderkey", to_string(F.col("lines")).alias("lines_text"), to_json_text(pairs).alias("lines_json"))


@register("other_case_names")
def q_other_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spec and keys whose names are spelled in another case than the table's columns."""
    spec = [("EVENT_ID", "bigint"), ("Ts", "timestamp_ntz"), ("user_ID", "int"), ("Event_Type", "string")]
    out = conform(load(spark, sf_dir, "events"), spec)
    kept = dedup_by_key(out, ["event_id", "EVENT_type"])
    return kept.select(*(F.col(c).alias(c.lower()) for c in kept.columns))


# 2024-01-01 00:00:00 UTC in epoch seconds (fixed value)
EPOCH_2024 = 1_704_067_200


@register("cast_timestamp")
def q_cast_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    epoch_s = F.col("event_id") * F.lit(3600) + F.lit(EPOCH_2024)
    return ev.select(
        "event_id",
        to_timestamp_ntz(F.col("ts").cast("string"), T.StringType()).alias("ts_from_text"),
        to_timestamp_ntz(epoch_s, T.LongType()).alias("ts_from_epoch_s"),
        to_timestamp_ntz(epoch_s * F.lit(1000), T.LongType(), unit="ms").alias("ts_from_epoch_ms"),
        to_timestamp_ntz(F.col("event_type"), T.StringType()).alias("ts_bad"),
    )


ZONES = {"Europe/Berlin": 1, "Asia/Tokyo": 9, "UTC": 0}


@register("cast_timestamp_named_zones")
def q_cast_timestamp_named_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named zones give their instant; a time without a date gives NULL, whatever the day of the run."""
    st = T.StringType()
    ev = load(spark, sf_dir, "events").where("ts IS NOT NULL")
    names = F.array(*map(F.lit, ZONES))
    text = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.get(names, F.pmod("event_id", F.lit(len(ZONES))).cast("int")))
    time_only = F.date_format("ts", "HH:mm:ss")
    return ev.select(
        "event_id",
        to_timestamp_ntz(text, st).alias("utc_wall_clock"),
        F.unix_micros(to_timestamp(text, st)).alias("instant_us"),
        to_timestamp_ntz(time_only, st).alias("no_day"),
    )


@register("cast_timestamp_zoned")
def q_cast_timestamp_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets are kept as instants; numbers out of range become NULL."""
    st = T.StringType()
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00"))
    huge = F.col("event_id") + F.lit(10**15)
    epoch_s = F.col("event_id") * F.lit(3600) + F.lit(EPOCH_2024)
    return load(spark, sf_dir, "events").select(
        "event_id",
        F.unix_micros(to_timestamp(text, st)).alias("instant_us"),
        to_timestamp_ntz(text, st).alias("utc_wall_clock"),
        F.unix_micros(to_timestamp(epoch_s, T.LongType())).alias("epoch_us"),
        F.unix_micros(to_timestamp(huge, T.LongType())).alias("huge_us"),
    )


@register("derive_date")
def q_derive_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.to_date("ts").alias(PARTITION_COLUMN),
        F.to_date(F.date_format("ts", "yyyy-MM-dd")).alias("date_from_text"),
    )


REJECT_SPEC = [
    ("event_id", "bigint"),
    ("ts", "timestamp_ntz"),
    ("user_id", "int"),
    ("event_type", "bigint"),
    ("value", "bigint"),
    ("props", "bigint"),
]


@register("cast_rejects")
def q_cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_rejects(load(spark, sf_dir, "events"), REJECT_SPEC)


@register("rejected_rows")
def q_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected value with its row's key, beside the count of its column."""
    events = load(spark, sf_dir, "events")
    marked = events.select("event_id", reject_array(events, REJECT_SPEC).alias("errors"))
    rows = rejected_rows(marked, ["event_id"], "errors")
    return rows.join(reject_counts(rows), ["column_name", "target_type"])


# -- paths, partition keys and windows ------------------------------------------


def event_paths():
    """Landing path of each event; some are malformed on purpose (no hour,
    two date= segments) to exercise the path rules."""
    day = F.date_format("ts", "yyyy-MM-dd")
    hr = F.hour("ts").cast("string")
    name = F.concat(F.col("event_id").cast("string"), F.lit(".avro"))
    normal = F.concat(F.lit("landing/events/date="), day, F.lit("/hr="), hr, F.lit("/"), name)
    no_hour = F.concat(F.lit("landing/events/date="), day, F.lit("/"), name)
    replay = F.concat(F.lit("landing/date="), day, F.lit("/replay/date=1999-12-31/hr="), hr, F.lit("/"), name)
    return (
        F.when(F.col("event_type") == "error", no_hour)
        .when(F.col("event_type") == "signup", replay)
        .otherwise(normal)
    )


@register("path_partitions")
def q_path_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    ev = events.select("event_id", event_paths().alias("file_path"))
    return ev.select(
        "event_id", "file_path", path_date(F.col("file_path")).alias("date_"), path_hour(F.col("file_path")).alias("hr_")
    )


@register("partition_keys")
def q_partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = load(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct()
    return days.select(partition_key(F.col("day"), "events/").alias("partition_key"), "day")


@register("trailing_days")
def q_trailing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    return ev.where(trailing_days_on_timestamp(F.col("ts"), AS_OF, WINDOW_DAYS)).select(
        "event_id", "ts", "user_id", "event_type", "value"
    )


@register("trailing_partition_days")
def q_trailing_partition_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same window on the stored table's partition column: other days' files are not opened."""
    target = scratch_path(spark, "trailing")
    rows = event_rows(spark, sf_dir)
    write_partitioned(rows, target, [PARTITION_COLUMN])
    stored = spark.read.schema(rows.schema).parquet(target)
    return stored.where(trailing_days_on_date(F.col(PARTITION_COLUMN), AS_OF, WINDOW_DAYS))


@register("retention")
def q_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions older than the retention horizon, with their row counts."""
    rows = event_rows(spark, sf_dir)
    horizon = F.date_sub(F.lit(AS_OF), RETENTION_DAYS - 1)
    return (
        rows.where(F.col(PARTITION_COLUMN) < horizon)
        .groupBy(PARTITION_COLUMN)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


# -- ids and stamps -------------------------------------------------------------


@register("surrogate_key")
def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    return ev.select("event_id", content_id("event_id", "user_id", "event_type", "ts").alias("row_id"))


@register("stamp_rows")
def q_stamp_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    return ev.select("event_id", "ts", run_stamp(RUN_TS).alias("ale_transform_time"))


# -- dedup ---------------------------------------------------------------------------


@register("distinct_rows")
def q_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(load(spark, sf_dir, "documents").drop("doc_id"))


@register("dedup_by_key")
def q_dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_by_key(load(spark, sf_dir, "lineitem"), LINE_KEYS).select(*LINE_KEYS)


@register("dedup_latest")
def q_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(load(spark, sf_dir, "lineitem"), LINE_KEYS, ["l_shipdate"])


@register("dup_count")
def q_dup_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dup_count(load(spark, sf_dir, "lineitem"), LINE_KEYS)


# -- merge and partitions ---------------------------------------------------------


@register("merge_union")
def q_merge_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_union(new_events(spark, sf_dir), stored_events(spark, sf_dir))


@register("merge_insert_only")
def q_merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_insert_only(new_events(spark, sf_dir), stored_events(spark, sf_dir), EVENT_KEYS)


@register("touched_partitions")
def q_touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return touched_partitions(new_events(spark, sf_dir), PARTITION_COLUMN)


@register("existing_partitions")
def q_existing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    touched = touched_partitions(new_events(spark, sf_dir), PARTITION_COLUMN)
    return existing_partitions(touched, stored_events(spark, sf_dir), PARTITION_COLUMN)


def _write_stored(spark: SparkSession, sf_dir: str) -> str:
    target = scratch_path(spark, "stored")
    stored = stored_events(spark, sf_dir).withColumn("batch", F.lit(None).cast("string"))
    write_partitioned(stored, target, [PARTITION_COLUMN])
    return target


@register("scan_partitions")
def q_scan_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _write_stored(spark, sf_dir)
    new = new_events(spark, sf_dir)
    stored = read_partitions(spark, target, new.schema[PARTITION_COLUMN], touched_summary(new, PARTITION_COLUMN))
    return restrict_by_frame(stored, new, PARTITION_COLUMN)


@register("partition_overwrite")
def q_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _write_stored(spark, sf_dir)
    write_partitioned(new_events(spark, sf_dir), target, [PARTITION_COLUMN])
    return spark.read.parquet(target)


@register("upsert_partitions")
def q_upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _write_stored(spark, sf_dir)
    upsert_partitions(spark, new_events(spark, sf_dir), target, EVENT_KEYS)
    return spark.read.parquet(target)


@register("upsert_new_wins")
def q_upsert_new_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _write_stored(spark, sf_dir)
    upsert_partitions(spark, new_events(spark, sf_dir), target, EVENT_KEYS, prefer="new")
    return spark.read.parquet(target)


@register("upsert_latest")
def q_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row seen last wins: in the overlap a stored copy is an hour later for
    even ids and an hour earlier for odd ones."""
    target = scratch_path(spark, "stored")
    even = F.pmod("event_id", F.lit(2)) == 0
    hour = F.expr("INTERVAL 1 HOUR")
    overlap = F.col("ts") >= F.lit(NEW_FROM.isoformat(sep=" ")).cast("timestamp_ntz")
    cols = ["event_id", "ts", PARTITION_COLUMN, "batch", "seen"]
    stored = stored_events(spark, sf_dir).withColumns(
        {"batch": F.lit(None).cast("string"), "seen": F.when(even, F.col("ts") + hour).otherwise(F.col("ts") - hour)}
    )
    write_partitioned(stored.select(*cols), target, [PARTITION_COLUMN])
    new = new_events(spark, sf_dir).withColumn("seen", F.col("ts"))
    upsert_partitions(spark, new.select(*cols), target, EVENT_KEYS, prefer="latest", order_by=["seen"])
    return spark.read.parquet(target)


@register("upsert_string_partition")
def q_upsert_string_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition values whose folder names are escaped."""
    target = scratch_path(spark, "stored")
    kind = F.concat("event_type", F.lit(": a,b {"), F.pmod("event_id", F.lit(3)).cast("string"))
    stored = stored_events(spark, sf_dir).withColumns({"kind": kind, "batch": F.lit(None).cast("string")})
    cols = ["event_id", "value", "kind", "batch"]
    write_partitioned(stored.select(*cols), target, ["kind"])
    new = new_events(spark, sf_dir).withColumn("kind", kind).select(*cols)
    upsert_partitions(spark, new, target, ["event_id", "kind"], part_col="kind", prefer="new")
    return spark.read.parquet(target)


@register("upsert_extra_columns")
def q_upsert_extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that only the stored side has outlive a rebuild."""
    target = scratch_path(spark, "stored")
    note = F.concat(F.lit("kept-"), F.col("event_id").cast("string"))
    stored = stored_events(spark, sf_dir).withColumns({"note": note, "batch": F.lit(None).cast("string")})
    write_partitioned(stored, target, [PARTITION_COLUMN])
    upsert_partitions(spark, new_events(spark, sf_dir), target, EVENT_KEYS, prefer="new")
    return spark.read.option("mergeSchema", "true").parquet(target)


@register("replay_idempotent")
def q_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _write_stored(spark, sf_dir)
    for _ in range(2):  # the same batch delivered twice
        upsert_partitions(spark, new_events(spark, sf_dir), target, EVENT_KEYS)
    return spark.read.parquet(target)


# -- audit -------------------------------------------------------------------------


@register("audit_append")
def q_audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "audit")
    append_audit(audit_rows(spark, sf_dir), root)
    return read_audit(spark, root)


@register("audit_scan")
def q_audit_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "audit")
    append_audit(audit_rows(spark, sf_dir), root)
    parsed = with_parsed_times(read_audit(spark, root))
    return parsed.select(
        "etl_run_id",
        "etl_job_name",
        F.unix_micros("start_ts").alias("start_us"),
        F.unix_micros("end_ts").alias("end_us"),
        "etl_status",
    )


@register("latest_run")
def q_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_run(audit_rows(spark, sf_dir))


@register("watermark")
def q_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    wm = watermark(audit_rows(spark, sf_dir))
    return wm.select("etl_job_name", F.unix_micros("watermark_ts").alias("watermark_us"))


# -- files -------------------------------------------------------------------------


def _land_events(spark: SparkSession, df: DataFrame, root: str, max_records: int | None = None) -> None:
    write_partitioned(
        df.withColumn("date", F.to_date("ts")), root, ["date"], mode="append", dynamic=False,
        max_records_per_file=max_records,
    )


@register("file_inventory")
def q_file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "events-landing")
    _land_events(spark, event_rows(spark, sf_dir), root)
    inv = file_inventory(spark, root, glob="*.parquet")
    return inv.groupBy("date").agg((F.min("length") > 0).alias("files_nonempty"))


@register("partition_file_counts")
def q_partition_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of one file a day each: a day in both has two files."""
    root = scratch_path(spark, "events-landing")
    for rows in (stored_events(spark, sf_dir), new_events(spark, sf_dir).drop("batch")):
        by_day = rows.withColumn("date", F.to_date("ts")).repartition("date")
        write_partitioned(by_day, root, ["date"], mode="append", dynamic=False, rebalance=False,
                          max_records_per_file=None)
    inv = file_inventory(spark, root, glob="*.parquet")
    return inv.groupBy("date").agg(F.count(F.lit(1)).alias("n_files"))


@register("incremental_files")
def q_incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land two deliveries; read only the window's files newer than the first."""
    root = scratch_path(spark, "events-landing")
    rows = event_rows(spark, sf_dir)
    _land_events(spark, stored_events(spark, sf_dir).drop("batch"), root)
    _age_files(spark, root, 3600)
    mark = _dt.datetime.now(_dt.timezone.utc) - _dt.timedelta(minutes=30)
    _land_events(spark, rows.where(F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")), root)
    schema = rows.schema.add("date", "date")
    fresh = scan_window(spark, root, schema, mark, AS_OF, INCREMENTAL_WINDOW_DAYS, fmt="parquet")
    return fresh.select("event_id", "ts", "date")


def _age_files(spark: SparkSession, root: str, seconds: int) -> None:
    """Set back the times of all files under ``root`` (a delivery of some time ago)."""
    fs, where = file_system(spark, root)
    files = fs.listFiles(where, True)
    while files.hasNext():
        status = files.next()
        fs.setTimes(status.getPath(), status.getModificationTime() - 1000 * seconds, -1)


@register("file_ledger")
def q_file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries, each run reads what the ledger lacks: run 1 the stored
    days; run 2 files stamped within the same seconds; run 3 files that came last
    with the oldest times; run 4 nothing."""
    root, ledger = scratch_path(spark, "ledger-landing"), scratch_path(spark, "ledger")
    rows = event_rows(spark, sf_dir)
    schema = rows.schema.add("date", "date")
    noon = F.hour("ts") < 12
    later = rows.where(F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    out = None
    for run, delivery_rows in enumerate((stored_events(spark, sf_dir), later.where(noon), later.where(~noon), None), 1):
        if run == 3:
            aside = scratch_path(spark, "late")
            _land_events(spark, delivery_rows, aside)
            _age_files(spark, aside, 86_400)
            _put_files(spark, aside, root)
        elif delivery_rows is not None:
            _land_events(spark, delivery_rows, root)
        files = NewFiles(spark, file_inventory(spark, root, glob="*.parquet", partitions=DAY_PARTITION), ledger, "events")
        found = files.read(schema, "parquet", root).select("event_id", "ts", "date", F.lit(run).alias("run"))
        files.done(f"run-{run}")
        out = found if out is None else out.unionByName(found)
    return out


def _put_files(spark: SparkSession, source: str, root: str) -> None:
    """Move the data files of one landing folder into another; their times stay."""
    fs, where = file_system(spark, source)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = [s.getPath() for folder in fs.listStatus(where) if folder.isDirectory() for s in fs.listStatus(folder.getPath())]
    for f in files:
        to = path(f"{root}/{f.getParent().getName()}")
        fs.mkdirs(to)
        fs.rename(f, path(to, f.getName()))


COMPACTION_APPENDS = 5


@register("compaction")
def q_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that got a file or more in each of five appends, compacted."""
    target = scratch_path(spark, "compaction")
    rows = event_rows(spark, sf_dir)
    for k in range(COMPACTION_APPENDS):
        some = rows.where(F.pmod("event_id", F.lit(COMPACTION_APPENDS)) == k)
        write_partitioned(some, target, [PARTITION_COLUMN], mode="append", dynamic=False)
    part = rows.schema[PARTITION_COLUMN]
    days = compact_partitions(spark, target, part)
    back = spark.read.schema(rows.schema).parquet(target).withColumn("_file", F.col("_metadata.file_path"))
    per_day = back.groupBy(PARTITION_COLUMN).agg(
        F.count(F.lit(1)).alias("n_rows"), F.bit_xor(F.col("event_id")).alias("ids"), (F.count_distinct("_file") <= 2).alias("few_files")
    )
    return per_day.withColumn("days_compacted", F.lit(days).cast("bigint"))


@register("retention_drop")
def q_retention_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days before the horizon go (a dry run names the same); the rows of the others stay."""
    target, tombs = scratch_path(spark, "retention"), scratch_path(spark, "tombstones")
    rows = event_rows(spark, sf_dir)
    write_partitioned(rows, target, [PARTITION_COLUMN])
    part, before = rows.schema[PARTITION_COLUMN], AS_OF - _dt.timedelta(days=RETENTION_DAYS - 1)
    planned = drop_expired(spark, target, part, before, tombs, dry_run=True).select(F.col("value").alias("planned"))
    planned = spark.createDataFrame(planned.toArrow())  # as they were before anything went
    gone = drop_expired(spark, target, part, before, tombs)
    day = F.col("value").cast("date").alias(PARTITION_COLUMN)
    expired = gone.join(planned, F.col("value") == F.col("planned")).select(day, F.lit(0).cast("bigint").alias("n_rows"), F.lit("expired").alias("state"))
    left = spark.read.schema(rows.schema).parquet(target).groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("n_rows"))
    return left.withColumn("state", F.lit("kept")).unionByName(expired)


@register("nested_records")
def q_nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of each order, cut at two items: all full but the last."""
    small = nested_results(spark, sf_dir, max_items=2).where("data IS NOT NULL")
    sizes = small.select(F.col("module.o_orderkey").alias("o_orderkey"), F.size("data").alias("n"))
    return sizes.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("n").cast("bigint").alias("n_items"), F.sum((F.col("n") == 2).cast("bigint")).alias("n_full")
    )


@register("write_layout")
def q_write_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "layout")
    write_partitioned(event_rows(spark, sf_dir), root, [PARTITION_COLUMN], max_records_per_file=LAYOUT_MAX_RECORDS)
    back = spark.read.parquet(root).withColumn("_file", F.col("_metadata.file_path"))
    per_file = back.groupBy(PARTITION_COLUMN, "_file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy(PARTITION_COLUMN).agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        (F.max("n") <= LAYOUT_MAX_RECORDS).alias("within_cap"),
    )


# -- streaming --------------------------------------------------------------------

STREAM_FILES_PER_TRIGGER = 32


def _land_two_deliveries(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Stored days, then the overlapping new days: the overlap arrives twice."""
    _land_events(spark, stored_events(spark, sf_dir), root)
    _land_events(spark, new_events(spark, sf_dir).drop("batch"), root)


@register("stream_ingest")
def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.streaming.ingest import stream_ingest

    landing = scratch_path(spark, "stream-landing")
    target = scratch_path(spark, "stream-target")
    ckpt = scratch_path(spark, "stream-ckpt")
    rows = event_rows(spark, sf_dir)
    schema = rows.schema.add("date", "date")
    _land_two_deliveries(spark, sf_dir, landing)
    stream_ingest(spark, landing, schema, target, ckpt, EVENT_KEYS,
                  transform=lambda b: b.drop("date"), max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    return spark.read.parquet(target)


@register("stream_dedup")
def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.streaming.dedup import stream_dedup, write_stream_files
    from tidemark.streaming.ingest import file_stream

    landing = scratch_path(spark, "stream-landing")
    target = scratch_path(spark, "stream-dedup")
    ckpt = scratch_path(spark, "stream-ckpt")
    schema = event_rows(spark, sf_dir).schema.add("date", "date")
    _land_two_deliveries(spark, sf_dir, landing)
    stream = file_stream(spark, landing, schema, max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    deduped = stream_dedup(stream.drop("date"), ["event_id"], "ts", "31 days")
    write_stream_files(deduped, target, ckpt)
    return spark.read.parquet(target)


# -- the whole job --------------------------------------------------------------------

ETL_JOB = "orders_results"
ETL_SECOND_DELIVERY_FROM = _dt.datetime(1998, 1, 1)
ETL_REDELIVERED_FROM = _dt.datetime(1997, 7, 1)


@register("etl_end_to_end")
def q_etl_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental runs of the full job over landed nested files.

    Delivery 1 (the day before AS_OF): records of orders before 1998; run 1.
    Delivery 2 (AS_OF): records from 1998 on, plus a re-delivery of the
    second half of 1997. Run 2 lists only the trailing window's day folders,
    reads only files newer than the watermark (start of run 1), and the
    insert-only merge keeps the already stored copies.
    """
    from tidemark.plans.etl import run_etl

    landing = scratch_path(spark, "etl-landing")
    target = scratch_path(spark, "etl-target")
    audit = scratch_path(spark, "etl-audit")
    nested = nested_results(spark, sf_dir).drop("source_path")
    od = F.col("module.o_orderdate")

    def lit_ts(t):
        return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")

    def deliver(df, day):
        write_partitioned(delivery(df, day), landing, ["date", "hr"], mode="append", dynamic=False)
        release_shuffles(spark)

    def run():
        run_etl(spark, landing, target, audit, ETL_JOB, nested.schema, as_of=AS_OF, days=WINDOW_DAYS,
                fmt="parquet", run_ts=RUN_TS)

    deliver(nested.where(od < lit_ts(ETL_SECOND_DELIVERY_FROM)), AS_OF - _dt.timedelta(days=1))
    _age_files(spark, landing, 3600)  # so the second run, which takes what came since the first began, leaves it
    run()
    deliver(nested.where(od >= lit_ts(ETL_REDELIVERED_FROM)), AS_OF)
    run()
    stored = spark.read.parquet(target)
    # file_path (and the id hashed over it) names files; keep stable columns
    return stored.drop("file_path", "ale_id")


REJECT_SHAPE_TYPES = {"o_orderstatus": "bigint", "c_name": "double"}


@register("run_metrics")
def q_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same delivery and a re-delivery, files chosen by the
    ledger; two columns get types that their texts do not have. What the runs
    read, rejected, found stored and wrote stands in their audit records."""
    from dataclasses import replace

    from tidemark.plans.etl import run_etl

    landing, target, audit, ledger, rejects = (scratch_path(spark, f"metrics-{n}") for n in ("landing", "target", "audit", "ledger", "rejects"))
    nested = nested_results(spark, sf_dir).drop("source_path")
    shape = replace(RESULT_SHAPE, spec=[(n, REJECT_SHAPE_TYPES.get(n, t)) for n, t in RESULT_SHAPE.spec])
    again = nested.where(F.pmod("module.o_orderkey", F.lit(3)) == 0)
    for run, rows in enumerate((nested, again), 1):
        write_partitioned(delivery(rows, AS_OF), landing, ["date", "hr"], mode="append", dynamic=False)
        release_shuffles(spark)
        run_etl(spark, landing, target, audit, ETL_JOB, nested.schema, as_of=AS_OF, days=WINDOW_DAYS, fmt="parquet", run_ts=RUN_TS,
                shape=shape, run_id=f"run-{run}", ledger_root=ledger, reject_target=rejects)
    kept = spark.read.parquet(rejects).groupBy("run_id").agg(F.count(F.lit(1)).alias("reject_rows"))
    runs = read_audit(spark, audit, ETL_JOB, metrics=True)
    return runs.join(kept, runs["etl_run_id"] == kept["run_id"], "left").select("etl_run_id", "etl_status", *METRIC_FIELDS, "reject_rows")


@register("flat_layer")
def q_flat_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run that also keeps the flat, not de-duplicated rows in a second
    output (the reference configures such a layer but never writes it)."""
    from tidemark.plans.etl import run_etl

    landing = scratch_path(spark, "flat-landing")
    target = scratch_path(spark, "flat-target")
    flat_target = scratch_path(spark, "flat-layer")
    audit = scratch_path(spark, "flat-audit")
    nested = nested_results(spark, sf_dir).drop("source_path")
    write_partitioned(delivery(nested, AS_OF), landing, ["date", "hr"], mode="append", dynamic=False)
    release_shuffles(spark)
    summary = run_etl(spark, landing, target, audit, ETL_JOB, nested.schema, as_of=AS_OF, days=WINDOW_DAYS,
                      fmt="parquet", run_ts=RUN_TS, flat_target=flat_target)
    flat = spark.read.parquet(flat_target).drop("file_path", "ale_id")
    return flat.withColumn("run_flat_rows", F.lit(summary["flat_rows"]).cast("bigint"))


@register("surrogate_key_random")
def q_surrogate_key_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random (UUID v4) ids: one per row, all distinct."""
    from tidemark.functions.ids import random_id

    ids = load(spark, sf_dir, "events").select(random_id().alias("row_id"))
    return ids.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("row_id").alias("n_ids"),
        F.min(F.length("row_id")).alias("id_len"),
    )
