"""Properties of the incremental job: no-op when idle, incremental = one-shot,
replays harmless."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidemark.plans.etl import run_etl, scan_window, upsert_partitions
from tidemark.plans.landing import delivery, nested_results
from tidemark.session import scratch_path
from tidemark.sinks.audit import read_audit
from tidemark.sinks.parquet import write_partitioned

STABLE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "transaction_date", "o_custkey", "l_quantity"]


def _nested(spark, sf):
    return nested_results(spark, sf).drop("source_path")


def _deliver(df, root, day):
    write_partitioned(delivery(df, day), root, ["date", "hr"], mode="append", dynamic=False)


def _keys(spark, target):
    return sorted(tuple(r) for r in spark.read.parquet(target).select(*STABLE).collect())


def test_empty_run_is_noop_and_audited(spark, sf_small):
    landing, target, audit = (scratch_path(spark, n) for n in ("l", "t", "a"))
    schema = _nested(spark, sf_small).schema
    out = run_etl(spark, landing, target, audit, "job", schema, fmt="parquet")
    assert out["partitions"] == 0
    assert read_audit(spark, audit).count() == 1


def test_incremental_equals_one_shot_and_replay_is_harmless(spark, sf_small):
    nested = _nested(spark, sf_small)
    schema = nested.schema
    d1, d2 = dt.date(2024, 1, 29), dt.date(2024, 1, 30)
    cut = F.col("module.o_orderdate") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")

    one_land, one_target, one_audit = (scratch_path(spark, n) for n in ("l", "t", "a"))
    _deliver(nested, one_land, d2)
    time.sleep(1.1)
    run_etl(spark, one_land, one_target, one_audit, "job", schema, fmt="parquet")

    inc_land, inc_target, inc_audit = (scratch_path(spark, n) for n in ("l", "t", "a"))
    _deliver(nested.where(cut), inc_land, d1)
    time.sleep(1.1)
    first = run_etl(spark, inc_land, inc_target, inc_audit, "job", schema, fmt="parquet")
    time.sleep(1.1)
    # second delivery: the rest, plus a full re-delivery of the first part
    _deliver(nested, inc_land, d2)
    second = run_etl(spark, inc_land, inc_target, inc_audit, "job", schema, fmt="parquet")
    assert first["partitions"] > 0 and second["partitions"] > 0
    assert _keys(spark, one_target) == _keys(spark, inc_target)

    # a third run with nothing new changes nothing
    third = run_etl(spark, inc_land, inc_target, inc_audit, "job", schema, fmt="parquet")
    assert third["flat_rows"] >= 0  # files of the watermark's own second are read again
    assert _keys(spark, one_target) == _keys(spark, inc_target)


def test_upsert_prefer_new_rebuilds_only_touched_partitions(spark):
    import datetime as dt

    from tidemark.plans.etl import upsert_partitions

    target = scratch_path(spark, "t")
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    stored = spark.createDataFrame([(1, "s", d1), (2, "s", d2)], "k long, v string, transaction_date date")
    write_partitioned(stored, target, ["transaction_date"])
    new = spark.createDataFrame([(2, "n", d2), (3, "n", d3), (3, "m", d3)], "k long, v string, transaction_date date")
    upsert_partitions(spark, new, target, ["k", "transaction_date"], prefer="new")
    got = sorted((r["k"], r["v"]) for r in spark.read.parquet(target).collect())
    assert got == [(1, "s"), (2, "n"), (3, "n")]
    upsert_partitions(spark, new, target, ["k", "transaction_date"], prefer="stored")
    again = sorted((r["k"], r["v"]) for r in spark.read.parquet(target).collect())
    assert again == got


def test_job_entry_point_runs_one_incremental_run(spark, sf_small):
    import datetime as dt

    from tidemark.jobs.etl_job import main

    nested = _nested(spark, sf_small)
    landing, target, audit = (scratch_path(spark, n) for n in ("l", "t", "a"))
    _deliver(nested, landing, dt.date(2024, 1, 30))
    time.sleep(1.1)
    ddl = nested.schema.simpleString()[len("struct<"):-1]
    out = main(["--landing", landing, "--target", target, "--audit", audit, "--job", "j",
                "--schema-ddl", ddl, "--format", "parquet", "--days", "7", "--as-of", "2024-01-30"])
    assert out["partitions"] > 0 and out["flat_rows"] == nested.selectExpr("explode(data)").count()
    assert read_audit(spark, audit).count() == 1


def _rows(spark, target, *cols):
    rows = spark.read.option("mergeSchema", "true").parquet(target).select(*cols).collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_merge_keeps_null_and_escaped_partitions(spark):
    ddl = "k long, v string, p string"
    stored = spark.createDataFrame([(1, "s", "a:b"), (2, "s", "p,q"), (5, "s", "r{s"), (9, "s", None), (7, "s", "b")], ddl)
    new = spark.createDataFrame([(2, "n", "p,q"), (3, "n", "a:b"), (9, "n", None), (4, "n", ""), (6, "n", "r{s")], ddl)
    for prefer, winner in (("stored", "s"), ("new", "n")):
        target = scratch_path(spark, "t")
        write_partitioned(stored, target, ["p"])
        assert upsert_partitions(spark, new, target, ["k", "p"], part_col="p", prefer=prefer) == 4
        assert _rows(spark, target, "k", "v") == [
            (1, "s"), (2, winner), (3, "n"), (4, "n"), (5, "s"), (6, "n"), (7, "s"), (9, winner)]


def test_rebuild_keeps_stored_columns_and_leaves_no_staged_copy(spark):
    import os

    from tidemark.session import checkpoint_root

    target = scratch_path(spark, "t")
    stored = spark.createDataFrame([(1, "01", "x"), (2, "01", "y")], "k long, p string, extra string")
    write_partitioned(stored, target, ["p"])
    new = spark.createDataFrame([(2, "01", "n")], "k long, p string, v string")
    upsert_partitions(spark, new, target, ["k", "p"], part_col="p", prefer="new")
    assert _rows(spark, target, "k", "extra") == [(1, "x"), (2, None)]
    root = checkpoint_root(spark).removeprefix("file:") + "/tidemark"
    assert not [d for d in os.listdir(root) if d.startswith(("merge-", "flat-", "batch-"))]


def test_latest_goes_by_its_order_and_keys_need_the_partition(spark):
    target = scratch_path(spark, "t")
    ddl = "k long, amount long, t long, p string"
    write_partitioned(spark.createDataFrame([(1, 900, 1, "x")], ddl), target, ["p"])
    new = spark.createDataFrame([(1, 100, 9, "x"), (1, 500, 5, "x")], ddl)
    with pytest.raises(ValueError):
        upsert_partitions(spark, new, target, ["k", "p"], part_col="p", prefer="latest")
    with pytest.raises(ValueError):
        upsert_partitions(spark, new, target, ["k"], part_col="p")
    upsert_partitions(spark, new, target, ["k", "p"], part_col="p", prefer="latest", order_by=["t"])
    assert _rows(spark, target, "amount") == [(100,)]


def test_run_that_died_before_its_audit_doubles_nothing(spark, sf_small, monkeypatch):
    import tidemark.plans.etl as etl

    nested = _nested(spark, sf_small)
    landing, target, flat, audit = (scratch_path(spark, n) for n in ("l", "t", "f", "a"))
    _deliver(nested, landing, dt.date(2024, 1, 30))

    def die(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(etl, "append_audit", die)
        with pytest.raises(RuntimeError):
            run_etl(spark, landing, target, audit, "job", nested.schema, fmt="parquet", flat_target=flat)
    want = spark.read.parquet(target).count(), spark.read.parquet(flat).count()
    again = run_etl(spark, landing, target, audit, "job", nested.schema, fmt="parquet", flat_target=flat)
    assert again["flat_rows"] == want[1]
    assert (spark.read.parquet(target).count(), spark.read.parquet(flat).count()) == want


def test_file_of_the_watermarks_own_second_is_read(spark):
    import glob
    import os

    landing = scratch_path(spark, "l")
    spark.range(3).coalesce(1).write.parquet(landing)
    noon = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
    for path in glob.glob(landing.removeprefix("file:") + "/*.parquet"):
        os.utime(path, (noon.timestamp(), noon.timestamp()))
    schema = spark.range(1).schema
    for after, n in ((noon + dt.timedelta(milliseconds=500), 3), (noon + dt.timedelta(seconds=1), 0)):
        assert scan_window(spark, landing, schema, after, fmt="parquet").count() == n


def test_job_takes_another_record_shape(spark):
    from tidemark.schema import RecordShape

    landing, target, audit = (scratch_path(spark, n) for n in ("l", "t", "a"))
    schema = "head struct<site:string>, device string, rows array<struct<at:string,amount:string>>"
    recs = spark.createDataFrame([(("s1",), "d1", [("2024-01-01 01:00:00", "7"), ("2024-01-02 02:00:00", "x")])], schema)
    recs.write.parquet(landing)
    shape = RecordShape(
        spec=[("site", "string"), ("device", "string"), ("at", "timestamp_ntz"), ("amount", "bigint"), ("more", "double")],
        keys=["site", "at", "day"], event_time="at", part_col="day", envelope=["head"], keep=["device"],
        array_col="rows", missing="null")
    out = run_etl(spark, landing, target, audit, "job", recs.schema, fmt="parquet", shape=shape)
    assert (out["partitions"], out["flat_rows"]) == (2, 2)
    got = _rows(spark, target, "site", "device", "amount", "more", F.col("day").cast("string"))
    assert sorted(got, key=lambda r: r[-1]) == [("s1", "d1", 7, None, "2024-01-01"), ("s1", "d1", None, None, "2024-01-02")]


def test_awkward_job_names_find_their_audit(spark):
    from tidemark.operators.audit import audit_record
    from tidemark.sinks.audit import append_audit

    root = scratch_path(spark, "a")
    t = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    names = ["a:b", "x/y", "a[1]", "10%"]
    for name in names:
        append_audit(audit_record(spark, name, name, t, t, "COMPLETED"), root)
    for name in names:
        assert [r["etl_run_id"] for r in read_audit(spark, root, name).collect()] == [name]


def test_job_entry_point_accepts_schema_json(spark, sf_small, tmp_path):
    import datetime as dt
    import json

    from tidemark.jobs.etl_job import main

    nested = _nested(spark, sf_small)
    landing, target, audit = (scratch_path(spark, n) for n in ("l", "t", "a"))
    _deliver(nested, landing, dt.date(2024, 1, 30))
    schema_file = tmp_path / "schema.json"
    schema_file.write_text(json.dumps(nested.schema.jsonValue()))
    time.sleep(1.1)
    args = ["--landing", landing, "--target", target, "--audit", audit, "--job", "j",
            "--schema-json", str(schema_file), "--format", "parquet", "--days", "0"]
    first = main(args)
    second = main(args)  # nothing new since the first run
    assert first["flat_rows"] > 0 and second["flat_rows"] == 0 and second["partitions"] == 0


def test_window_defaults_to_today(spark):
    import datetime as dt

    from tidemark.plans.etl import scan_window

    landing = scratch_path(spark, "l")
    today = dt.datetime.now(dt.timezone.utc).date()
    for day in (today, today - dt.timedelta(days=10)):
        spark.range(3).withColumn("date", F.lit(day.isoformat()).cast("date")).write.mode("append") \
            .partitionBy("date").parquet(landing)
    schema = spark.range(1).schema
    recs = scan_window(spark, landing, schema, dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc), days=7, fmt="parquet")
    assert recs.count() == 3


def test_read_audit_for_one_job_lists_only_its_folder(spark):
    import datetime as dt

    from tidemark.operators.audit import audit_record
    from tidemark.sinks.audit import append_audit

    root = scratch_path(spark, "a")
    t = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    append_audit(audit_record(spark, "r1", "j1", t, t, "COMPLETED"), root)
    append_audit(audit_record(spark, "r2", "j2", t, t, "COMPLETED"), root)
    assert [r["etl_run_id"] for r in read_audit(spark, root, "j1").collect()] == ["r1"]
    assert read_audit(spark, root).count() == 2
    assert read_audit(spark, root, "nope").count() == 0


def _opened(df) -> set[str]:
    """Partition folders that a frame's scans list."""
    return {f.rsplit("/", 2)[-2] for f in df.inputFiles()}


def test_merge_opens_only_the_touched_folders(spark):
    """One old and one new day: what lies between them is neither listed nor opened."""
    import datetime as dt

    from tidemark.operators.merge import touched_summary
    from tidemark.plans.etl import read_partitions

    target = scratch_path(spark, "t")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    stored = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "k long, transaction_date date")
    write_partitioned(stored, target, ["transaction_date"])
    new = spark.createDataFrame([(0, days[0]), (99, days[59])], "k long, transaction_date date")
    part = new.schema["transaction_date"]
    read = read_partitions(spark, target, part, touched_summary(new, part.name), [new.schema["k"]])
    assert _opened(read) == {"transaction_date=2024-01-01", "transaction_date=2024-02-29"}
    assert sorted(r.k for r in read.collect()) == [0, 59]
    far = spark.createDataFrame([(7, dt.date(2025, 1, 1))], "k long, transaction_date date")
    assert read_partitions(spark, target, part, touched_summary(far, part.name)) is None


def test_touched_folders_of_odd_values(spark, monkeypatch):
    import datetime as dt

    from tidemark.operators import merge
    from tidemark.plans import etl

    at = [dt.datetime(2024, 1, 1, 10, 30), dt.datetime(2024, 1, 1, 11)]
    for ddl, values in (("string", ["a:b", "p,q", None, "x=y", "z"]), ("timestamp", [*at, None]), ("timestamp_ntz", at), ("bigint", [1, -5, None])):
        target = scratch_path(spark, "t")
        stored = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"k long, p {ddl}")
        write_partitioned(stored, target, ["p"])
        for some in (values[:2], values[1:]):
            new = stored.where(stored["k"].isin([values.index(v) for v in some]))
            read = etl.read_partitions(spark, target, new.schema["p"], merge.touched_summary(new, "p"))
            assert len(_opened(read)) == len(some)
            assert sorted((tuple(r) for r in read.select("k", "p").collect()), key=str) == sorted((tuple(r) for r in new.collect()), key=str)
    monkeypatch.setattr(merge, "MAX_FOLDERS", 1)  # more values than may be named: a filter over the root
    touched = merge.touched_summary(stored, "p")
    assert touched["values"] is None and touched["partitions"] == 3
    assert etl.read_partitions(spark, target, stored.schema["p"], touched).count() == 3
