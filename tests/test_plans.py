"""Physical-plan checks: pushdown, pruning, no Python in the hot path."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators.dedup import dedup_latest, dup_count
from tidemark.plans.tables import load
from tidemark.session import scratch_path
from tidemark.sinks.parquet import write_partitioned


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_no_python_udf(spark, sf_small):
    p = plan(entry.entry(spark))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_trailing_window_pushed_to_scan(spark, sf_small):
    p = plan(entry.queries()["trailing_days"](spark, sf_small))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p


def test_flagship_prunes_childless_branch_and_columns(spark, sf_small):
    p = plan(entry.entry(spark))
    # plain explode drops NULL arrays, so the childless-order branch is gone
    assert "LeftAnti" not in p


def test_dedup_and_dup_count_use_aggregates_not_windows(spark, sf_small):
    li = load(spark, sf_small, "lineitem")
    for df in (dedup_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]), dup_count(li, ["l_orderkey"])):
        p = plan(df)
        assert "Window" not in p
        assert "partial" in p.lower() or "Partial" in p


def test_partition_filter_on_stored_read(spark, sf_small):
    ev = load(spark, sf_small, "events").withColumn("transaction_date", F.to_date("ts"))
    target = scratch_path(spark, "plan-test")
    write_partitioned(ev, target, ["transaction_date"])
    from tidemark.operators.merge import touched_summary
    from tidemark.plans.etl import read_partitions

    day = ev.where(F.col("transaction_date") == dt.date(2024, 1, 3))
    part = ev.schema["transaction_date"]
    df = read_partitions(spark, target, part, touched_summary(day, part.name))
    p = plan(df)
    assert "PartitionFilters: [isnotnull(transaction_date" in p
    assert df.count() == ev.where(F.col("transaction_date") == dt.date(2024, 1, 3)).count()
