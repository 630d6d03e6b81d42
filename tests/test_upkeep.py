"""File ledger, compaction, retention, rejected rows and counted nesting."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tidemark.functions.casts import conform, reject_array, reject_counts, rejected_rows
from tidemark.operators.nest import nest_children
from tidemark.plans.compaction import compact_partitions
from tidemark.plans.queries import _age_files
from tidemark.session import scratch_path
from tidemark.sinks.parquet import write_partitioned
from tidemark.sinks.retention import drop_expired, tombstones
from tidemark.sources import ledger as ledger_module
from tidemark.sources.files import DAY_PARTITION, file_inventory
from tidemark.sources.ledger import NewFiles

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def _land(spark, root, ids, day=DAYS[0]):
    rows = spark.createDataFrame([(i, day) for i in ids], "k long, date date").coalesce(1)
    write_partitioned(rows, root, ["date"], mode="append", dynamic=False, rebalance=False)
    return rows.schema


def _run(spark, root, ledger, schema, done=True):
    files = NewFiles(spark, file_inventory(spark, root, glob="*.parquet", partitions=DAY_PARTITION), ledger, "job")
    got = sorted(r.k for r in files.read(schema, "parquet", root).collect())
    if done:
        files.done("run")
    return got


def test_each_file_is_read_once(spark, monkeypatch):
    root, ledger = scratch_path(spark, "l"), scratch_path(spark, "g")
    schema = _land(spark, root, [1, 2])
    assert _run(spark, root, ledger, schema, done=False) == [1, 2]  # died before the ledger
    assert _run(spark, root, ledger, schema) == [1, 2]
    _land(spark, root, [3])  # within the second of the run before
    assert _run(spark, root, ledger, schema) == [3]
    assert _run(spark, root, ledger, schema) == []
    monkeypatch.setattr(ledger_module, "MAX_NAMED", 0)  # files chosen by the join
    for path in [f"{d}/{f}" for d, _, names in os.walk(root.removeprefix("file:")) for f in names if f.endswith(".crc")]:
        os.remove(path)
    _land(spark, root, [4], DAYS[1])
    assert _run(spark, root, ledger, schema) == [4]
    _age_files(spark, f"{root}/date=2024-01-02", 99)  # put again: another time
    assert _run(spark, root, ledger, schema) == [4]


def _files(root, day):
    return sorted(f for f in os.listdir(f"{root.removeprefix('file:')}/date={day}") if f.endswith(".parquet"))


def test_compaction_rewrites_crowded_days_only(spark):
    root = scratch_path(spark, "c")
    for k in range(4):
        schema = _land(spark, root, range(100 * k, 100 * k + 50))
    _land(spark, root, [7, 8], DAYS[1])
    before, fine = sorted(r.k for r in spark.read.parquet(root).collect()), _files(root, DAYS[1])
    assert len(_files(root, DAYS[0])) == 4
    assert compact_partitions(spark, root, schema["date"], target_bytes=1 << 20) == 1
    assert len(_files(root, DAYS[0])) == 1 and _files(root, DAYS[1]) == fine
    assert sorted(r.k for r in spark.read.parquet(root).collect()) == before
    assert compact_partitions(spark, root, schema["date"], target_bytes=1 << 20) == 0


def test_compaction_cuts_a_large_day(spark):
    root = scratch_path(spark, "c")
    for k in range(6):
        schema = _land(spark, root, range(4000 * k, 4000 * k + 4000))
    size = sum(os.path.getsize(f"{root.removeprefix('file:')}/date={DAYS[0]}/{f}") for f in _files(root, DAYS[0]))
    compact_partitions(spark, root, schema["date"], target_bytes=size // 3 + 1)
    assert 1 < len(_files(root, DAYS[0])) <= 3 and spark.read.parquet(root).count() == 24000


def test_retention_is_safe_to_repeat(spark):
    root, tombs = scratch_path(spark, "r"), scratch_path(spark, "t")
    rows = spark.createDataFrame([(1, DAYS[0]), (2, DAYS[1]), (3, DAYS[2]), (4, None)], "k long, date date")
    write_partitioned(rows, root, ["date"])
    part = rows.schema["date"]
    assert drop_expired(spark, root, part, DAYS[2], tombs, dry_run=True).count() == 2
    assert spark.read.parquet(root).count() == 4 and tombstones(spark, tombs).count() == 0
    gone = drop_expired(spark, root, part, DAYS[2], tombs)
    assert sorted(r.value for r in gone.collect()) == ["2024-01-01", "2024-01-02"]
    assert sorted(r.k for r in spark.read.parquet(root).collect()) == [3, 4]
    assert drop_expired(spark, root, part, DAYS[2], tombs).count() == 0
    assert sorted(r.k for r in spark.read.parquet(root).collect()) == [3, 4]


def test_rejected_values(spark):
    rows = spark.createDataFrame([(1, "12", "x", 1.5), (2, "n/a", "2024-01-01", 2.0), (3, None, "10:00", None)], "id long, a string, b string, c double")
    spec = [("id", "bigint"), ("a", "bigint"), ("b", "timestamp_ntz"), ("c", "bigint"), ("absent", "int")]
    marked = rows.withColumn("errors", reject_array(rows, spec))
    found = rejected_rows(marked, ["id"], "errors")
    assert sorted(tuple(r) for r in found.collect()) == [(1, "b", "x", "timestamp_ntz"), (2, "a", "n/a", "bigint"), (3, "b", "10:00", "timestamp_ntz")]
    assert {(r.column_name, r.rejected) for r in reject_counts(found).collect()} == {("a", 1), ("b", 2)}
    assert conform(rows, spec, missing="null").where("b IS NULL").count() == 2


def test_chunks_are_full_but_the_last(spark):
    child = spark.range(0, 5000, 1, 7).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 40).alias("k"), F.col("id").alias("v"))
    out = nest_children(child, ["k"], "data", max_items=50)
    sizes = {}
    for r in out.select("k", F.size("data").alias("n")).collect():
        sizes.setdefault(r.k, []).append(r.n)
    total = {r.k: r["count"] for r in child.groupBy("k").count().collect()}
    assert len(sizes[None]) == 34
    for k, n in total.items():
        assert sorted(sizes[k], reverse=True) == [50] * (n // 50) + ([n % 50] if n % 50 else [])
    assert sorted(r.v for r in out.selectExpr("inline(data)").collect()) == list(range(5000))
