"""Semantics on small hand-written rows (one test per decided behaviour)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import (
    cast_rejects,
    conform,
    epoch_to_timestamp_ntz,
    resolve_columns,
    to_bigint,
    to_double,
    to_timestamp_ntz,
)
from tidemark.functions.ids import content_id
from tidemark.functions.paths import path_date, path_hour, trailing_days_on_date
from tidemark.operators.audit import (
    FLOOR_TIME,
    audit_record,
    job_watermark,
    latest_run,
    watermark,
)
from tidemark.operators.dedup import dedup_by_key, dedup_latest, dup_count
from tidemark.operators.flatten import explode_records, flatten_structs
from tidemark.operators.merge import (
    existing_partitions,
    merge_dedup,
    merge_insert_only,
    merge_union,
    touched_partitions,
)
from tidemark.operators.nest import attach_children, nest_children


def col_values(df, c):
    return [r[c] for r in df.collect()]


# -- casts (legacy-style lenient casts, independent of ANSI mode) -------------------


def test_string_to_bigint_keeps_integer_part(spark):
    vals = ["12.7", " 42 ", "-3", "+5.", "abc", "", "1e3", "99999999999999999999", None, ".5"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = col_values(df.select(to_bigint(F.col("s"), T.StringType()).alias("b")), "b")
    assert got == [12, 42, -3, 5, None, None, None, None, None, None]


def test_double_to_bigint_truncates_and_nulls_out_of_range(spark):
    df = spark.createDataFrame([(12.7,), (-12.7,), (1e30,), (float("nan"),), (None,)], "d double")
    got = col_values(df.select(to_bigint(F.col("d"), T.DoubleType()).alias("b")), "b")
    assert got == [12, -12, None, None, None]


def test_casts_do_not_fail_under_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    df = spark.createDataFrame([("x",)], "s string")
    row = df.select(to_bigint(F.col("s"), T.StringType()).alias("b"), to_double(F.col("s"), T.StringType()).alias("d")).first()
    assert row["b"] is None and row["d"] is None


def test_epoch_seconds_and_millis_to_wall_clock(spark):
    df = spark.createDataFrame([(0,), (86_400,), (None,)], "e long")
    out = df.select(
        epoch_to_timestamp_ntz(F.col("e")).alias("s"),
        epoch_to_timestamp_ntz(F.col("e") * 1000, unit="ms").alias("ms"),
    ).collect()
    assert out[0]["s"] == dt.datetime(1970, 1, 1) and out[1]["s"] == dt.datetime(1970, 1, 2)
    assert out[1]["ms"] == dt.datetime(1970, 1, 2) and out[2]["s"] is None


def test_text_to_timestamp_ntz_bad_is_null(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("junk",)], "s string")
    got = col_values(df.select(to_timestamp_ntz(F.col("s"), T.StringType()).alias("t")), "t")
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None]


def test_conform_missing_columns(spark):
    df = spark.createDataFrame([(1, "2")], "A long, b string")
    out = conform(df, [("a", "string"), ("B", "bigint"), ("c", "double")], missing="null")
    assert out.columns == ["a", "B", "c"]
    assert out.first().asDict() == {"a": "1", "B": 2, "c": None}
    with pytest.raises(ValueError):
        conform(df, [("c", "double")])


def test_resolve_columns_case_insensitive_and_ambiguous(spark):
    df = spark.createDataFrame([(1, 2)], "primaryKey long, testId long")
    assert resolve_columns(df, ["primarykey", "TESTID"]) == {"primarykey": "primaryKey", "TESTID": "testId"}


def test_cast_rejects_counts(spark):
    df = spark.createDataFrame([("1", "x"), ("y", None), (None, "2.5")], "a string, b string")
    rows = {r["column_name"]: r["rejected"] for r in cast_rejects(df, [("a", "bigint"), ("b", "double")]).collect()}
    assert rows == {"a": 1, "b": 1}


# -- paths ------------------------------------------------------------------------------


def test_path_partitions_first_segment_and_missing(spark):
    paths = [
        "s3a://b/k/date=2024-01-05/hr=7/f.avro",
        "s3a://b/date=2024-01-05/x/date=1999-01-01/hr=3/f.avro",
        "s3a://b/k/f.avro",
        "s3a://b/date=notadate/hr=x/f",
    ]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    out = df.select(path_date(F.col("p")).alias("d"), path_hour(F.col("p")).alias("h")).collect()
    assert [(r["d"], r["h"]) for r in out] == [
        (dt.date(2024, 1, 5), 7),
        (dt.date(2024, 1, 5), 3),
        (None, None),
        (None, None),
    ]


def test_trailing_window_inclusive(spark):
    days = [dt.date(2024, 1, d) for d in range(20, 32)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    kept = col_values(df.where(trailing_days_on_date(F.col("d"), dt.date(2024, 1, 30), 7)), "d")
    assert kept == [dt.date(2024, 1, d) for d in range(24, 31)]


# -- flatten / explode / nest ----------------------------------------------------------

NESTED = T.StructType(
    [
        T.StructField("module", T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])),
        T.StructField("customerInfo", T.StructType([T.StructField("country", T.StringType()), T.StructField("name", T.StringType())])),
        T.StructField("data", T.ArrayType(T.StructType([T.StructField("v", T.LongType())]))),
    ]
)


def nested_rows(spark):
    return spark.createDataFrame(
        [((1, "m1"), ("DE", "c1"), [(10,), (11,)]), ((2, "m2"), ("FR", "c2"), []), ((3, "m3"), None, None)], NESTED
    )


def test_flatten_collision_rules(spark):
    df = nested_rows(spark)
    with pytest.raises(ValueError):
        flatten_structs(df, ["module", "customerInfo"])
    pref = flatten_structs(df, ["module", "customerInfo"], on_collision="prefix")
    assert pref.columns == ["id", "name", "country", "customerInfo_name"]
    first = flatten_structs(df, ["module", "customerInfo"], on_collision="first")
    assert first.columns == ["id", "name", "country"]


def test_explode_drops_empty_and_null_outer_keeps(spark):
    flat = flatten_structs(nested_rows(spark), ["module"], keep=["data"])
    inner = explode_records(flat, "data")
    assert sorted((r["id"], r["v"]) for r in inner.collect()) == [(1, 10), (1, 11)]
    outer = explode_records(flat, "data", outer=True)
    assert sorted((r["id"], r["v"]) for r in outer.collect()) == [(1, 10), (1, 11), (2, None), (3, None)]


def test_nest_bounds_array_size_and_roundtrips(spark):
    child = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    chunks = nest_children(child, ["k"], "data", max_items=16)
    sizes = [r["n"] for r in chunks.select(F.size("data").alias("n")).collect()]
    assert max(sizes) <= 16
    back = explode_records(chunks, "data", on_collision="first")
    assert sorted((r["k"], r["v"]) for r in back.collect()) == sorted((i % 3, i) for i in range(1000))


def test_attach_children_keeps_childless_parents(spark):
    parents = spark.createDataFrame([(1,), (2,)], "pk long")
    child = spark.createDataFrame([(1, 5)], "fk long, v long")
    chunks = nest_children(child, ["fk"], "data")
    out = attach_children(parents, chunks, "pk", "fk", child, "data")
    got = {r["pk"]: (None if r["data"] is None else len(r["data"])) for r in out.collect()}
    assert got == {1: 1, 2: None}


# -- dedup -------------------------------------------------------------------------------------


def test_dedup_by_key_null_keys_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k long, v long")
    assert dedup_by_key(df, ["K"]).count() == 2


def test_dedup_latest_deterministic_and_nulls_lose(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, 5, "b"), (1, 5, "c"), (2, 1, "x"), (2, None, "y")], "k long, t long, v string"
    )
    latest = {r["k"]: (r["t"], r["v"]) for r in dedup_latest(df, ["k"], ["t"]).collect()}
    assert latest == {1: (5, "c"), 2: (1, "x")}
    earliest = {r["k"]: (r["t"], r["v"]) for r in dedup_latest(df, ["k"], ["t"], latest=False).collect()}
    assert earliest == {1: (5, "b"), 2: (1, "x")}


def test_dup_count_null_safe(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k long, v long")
    got = sorted((r["v"], r["dup_count"]) for r in dup_count(df, ["k"]).collect())
    assert got == [(1, 2), (2, 2), (3, 1)]


# -- merge ----------------------------------------------------------------------------------------


def test_merge_union_by_name_missing_columns(spark):
    new = spark.createDataFrame([(1, "n")], "k long, batch string")
    stored = spark.createDataFrame([(2,)], "k long")
    assert sorted((r["k"], r["batch"]) for r in merge_union(new, stored).collect()) == [(1, "n"), (2, None)]


def test_merge_insert_only_keeps_stored_and_null_keys(spark):
    stored = spark.createDataFrame([(1, "s"), (None, "s")], "k long, v string")
    new = spark.createDataFrame([(1, "n"), (None, "n"), (2, "n"), (2, "n")], "k long, v string")
    got = sorted(((r["k"] or 0), r["v"]) for r in merge_insert_only(new, stored, ["k"]).collect())
    assert got == [(0, "s"), (1, "s"), (2, "n")]
    upsert = sorted(((r["k"] or 0), r["v"]) for r in merge_dedup(new, stored, ["k"], prefer="new").collect())
    assert upsert == [(0, "n"), (1, "n"), (2, "n")]


def test_touched_and_existing_partitions(spark):
    new = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),), (None,)], "d date")
    stored = spark.createDataFrame([(dt.date(2024, 1, 2),), (None,), (dt.date(2023, 1, 1),)], "d date")
    touched = touched_partitions(new, "d")
    assert touched.count() == 3
    assert sorted(col_values(existing_partitions(touched, stored, "d"), "d"), key=str) == sorted([dt.date(2024, 1, 2), None], key=str)


# -- ids -----------------------------------------------------------------------------------------------


def test_content_id_repeatable_and_null_position_safe(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "x", None), (1, None, "x")], "a long, b string, c string")
    ids = col_values(df.select(content_id("a", "b", "c").alias("i")), "i")
    assert ids[0] == ids[2] and ids[0] != ids[1]
    pairs = [("a|b", "c"), ("a", "b|c"), (None, ""), ("", None), (None, None)]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert df.select(content_id("a", "b")).distinct().count() == len(pairs)


# -- audit ----------------------------------------------------------------------------------------------


def test_audit_latest_and_watermark(spark):
    t = dt.datetime
    rows = [
        audit_record(spark, "r1", "j", t(2024, 1, 1, 10), t(2024, 1, 1, 11), "COMPLETED"),
        audit_record(spark, "r2", "j", t(2024, 1, 2, 10), None, "FAILED"),
        audit_record(spark, "r3", "k", t(2024, 1, 3, 10), None, "Started"),
    ]
    audits = rows[0].unionByName(rows[1]).unionByName(rows[2])
    latest = {r["etl_job_name"]: r["etl_run_id"] for r in latest_run(audits).collect()}
    assert latest == {"j": "r2", "k": "r3"}
    wm = watermark(audits).select("etl_job_name", F.unix_micros("watermark_ts").alias("us"))
    wm = {r["etl_job_name"]: r["us"] for r in wm.collect()}
    assert wm["j"] == int(t(2024, 1, 1, 10, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    assert wm["k"] == -62135596800000000
    assert job_watermark(audits, "j") == t(2024, 1, 1, 10, tzinfo=dt.timezone.utc)
    assert job_watermark(audits, "k") == FLOOR_TIME
    assert job_watermark(audits, "nope") == FLOOR_TIME


# -- nested scan from JSON files ----------------------------------------------------------


def test_read_nested_json_with_schema_and_lineage(spark):
    from tidemark.plans.transform import flatten_records
    from tidemark.session import scratch_path
    from tidemark.sources.nested import read_nested

    root = scratch_path(spark, "json-landing")
    rows = nested_rows(spark).withColumn("date", F.lit("2024-01-30").cast("date")).withColumn("hr", F.lit(3))
    rows.write.partitionBy("date", "hr").json(root)
    recs = read_nested(spark, root, NESTED, fmt="json", base_path=root)
    flat = flatten_records(recs, keep=["source_path"], on_collision="prefix")
    got = sorted((r["id"], r["v"]) for r in flat.collect())
    assert got == [(1, 10), (1, 11)]
    assert all("/date=2024-01-30/hr=3/" in r["source_path"] for r in flat.collect())


def test_double_text_prefilter_keeps_all_parseable_forms(spark):
    vals = ["1.5", " -2e3 ", ".5", "+7.", "NaN", "-Infinity", "1.5d", "abc", "{\"k\": 1}", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = col_values(df.select(to_double(F.col("s"), T.StringType()).alias("d")), "d")
    plain = col_values(df.select(F.trim(F.col("s")).try_cast("double").alias("d")), "d")
    same = [(a == b) or (a != a and b != b) for a, b in zip(got, plain)]  # NaN != NaN
    assert all(same), list(zip(vals, got, plain))


def test_zoned_timestamp_from_epoch_and_text(spark):
    from tidemark.functions.casts import to_timestamp

    df = spark.createDataFrame([(86_400, "2024-01-02 03:04:05+00:00")], "e long, s string")
    row = df.select(
        F.unix_micros(to_timestamp(F.col("e"), T.LongType())).alias("a"),
        F.unix_micros(to_timestamp(F.col("e") * 1000, T.LongType(), unit="ms")).alias("b"),
        F.unix_micros(to_timestamp(F.col("s"), T.StringType())).alias("c"),
    ).first()
    assert row["a"] == row["b"] == 86_400_000_000
    assert row["c"] == int(dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000


def test_discover_lists_only_window_files_newer_than_watermark(spark):
    import time

    from tidemark.session import scratch_path
    from tidemark.sources.files import discover, file_inventory

    root = scratch_path(spark, "inv")
    base = spark.range(10).withColumn("v", F.col("id"))
    base.withColumn("date", F.lit("2024-01-20").cast("date")).write.partitionBy("date").parquet(root)
    time.sleep(1.1)
    mark = dt.datetime.now(dt.timezone.utc)
    time.sleep(1.1)
    for day in ("2024-01-20", "2024-01-29", "2024-01-10"):
        base.withColumn("date", F.lit(day).cast("date")).write.mode("append").partitionBy("date").parquet(root)
    found = discover(spark, root, dt.date(2024, 1, 30), 14, mark, glob="*.parquet")
    days = sorted({r["date"] for r in found.collect()})
    assert days == [dt.date(2024, 1, 20), dt.date(2024, 1, 29)]
    assert set(found.columns) >= {"path", "modificationTime", "length", "date"}
    assert file_inventory(spark, root + "/missing").count() == 0


def test_merge_prefer_latest_keeps_greatest_order_value(spark):
    stored = spark.createDataFrame([(1, 5, "s"), (2, 9, "s"), (3, None, "s")], "k long, t long, v string")
    new = spark.createDataFrame([(1, 7, "n"), (2, 3, "n"), (3, 1, "n"), (4, 1, "n")], "k long, t long, v string")
    got = sorted((r["k"], r["v"]) for r in merge_dedup(new, stored, ["k"], prefer="latest", order_by=["t"]).collect())
    assert got == [(1, "n"), (2, "s"), (3, "n"), (4, "n")]


def test_path_key_is_anchored_and_no_rows_mean_no_rejects(spark):
    from pyspark.sql import functions as F

    from tidemark.functions.casts import cast_rejects
    from tidemark.functions.paths import path_value

    df = spark.createDataFrame([("a/update=1/date=2/f",), ("date=3/f",), ("a/update=4/f",)], "p string")
    assert [r[0] for r in df.select(path_value(F.col("p"), "date")).collect()] == ["2", "3", None]
    assert [r["rejected"] for r in cast_rejects(df.limit(0), [("p", "bigint")]).collect()] == [0]
