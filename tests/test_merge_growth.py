"""Wide rows of a run are shuffled once a write, not once more for their keys."""

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup_latest, dedup_repeated, repeated_keys
from tidemark.plans import etl
from tidemark.session import scratch_path


def _never(*_args, **_kwargs):
    raise AssertionError("not for this input")


def test_repeated_keys_alone_are_aggregated(spark):
    rows = spark.range(0, 300, 1, 4).select(
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id") % 280).alias("k"), F.col("id").alias("v"))
    got = dedup_repeated(rows, ["k"], repeated_keys(rows, ["k"]))
    assert sorted(map(str, got.collect())) == sorted(map(str, dedup_latest(rows, ["k"], []).collect()))


def test_unique_batch_is_not_aggregated_by_key(spark, monkeypatch):
    rows = spark.range(0, 100).select(F.col("id").alias("k"), F.lit(dt.date(2024, 1, 1)).alias("transaction_date"))
    monkeypatch.setattr(etl, "dedup_latest", _never)
    target = scratch_path(spark, "unique")
    for n in (100, 0):
        wrote = Observation("wrote")
        etl.upsert_partitions(spark, rows, target, ["k", "transaction_date"], observed=wrote)
        assert wrote.get == {"rows_written": n}
    assert spark.read.parquet(target).count() == 100


def test_few_and_many_repeats_give_one_row_a_key(spark):
    for per_key in (1, 3):
        unique = spark.range(0, 100).select((F.col("id") / per_key).cast("long").alias("k"), F.col("id").alias("v"))
        rows = unique.unionByName(unique.where("v = 7")).unionByName(unique.where("v = 7").withColumn("v", F.lit(900).cast("long")))
        rows = rows.withColumn("transaction_date", F.lit(dt.date(2024, 1, 1)))
        target = scratch_path(spark, "repeats")
        etl.upsert_partitions(spark, rows, target, ["k", "transaction_date"])
        want = {r.k: r.v for r in dedup_latest(rows, ["k"], []).collect()}
        got = [(r.k, r.v) for r in spark.read.parquet(target).collect()]
        assert dict(got) == want and len(got) == len(want)


def test_flat_rows_are_shuffled_by_day_once_for_both_outputs(spark, sf_small, monkeypatch):
    from tidemark.plans.landing import delivery, nested_results
    from tidemark.sinks.parquet import write_partitioned

    nested = nested_results(spark, sf_small).drop("source_path").where("module.o_orderkey < 200")
    landing, target, audit, flat = (scratch_path(spark, n) for n in ("l", "t", "a", "f"))
    write_partitioned(delivery(nested, dt.date(2024, 1, 30)), landing, ["date", "hr"])
    shuffled = []

    def noted(df, path, parts, **options):
        shuffled.append(options.get("rebalance", True))
        write_partitioned(df, path, parts, **options)

    monkeypatch.setattr(etl, "write_partitioned", noted)
    out = etl.run_etl(spark, landing, target, audit, "job", nested.schema, fmt="parquet", flat_target=flat)
    n = nested.selectExpr("explode(data)").count()
    assert shuffled == [False, False]
    assert n == out["rows_read"] == out["rows_written"] == spark.read.parquet(flat).count() == spark.read.parquet(target).count()
