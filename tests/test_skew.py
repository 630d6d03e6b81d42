"""One key holding a third of all rows: exact results, bounded groups."""

from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup_by_key, dedup_latest, dup_count
from tidemark.operators.flatten import explode_records
from tidemark.operators.merge import merge_insert_only
from tidemark.operators.nest import nest_children

N = 30_000
HOT = -1  # never produced by the other rows


def skewed(spark):
    # rows 0..N-1; every third row carries the hot key
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
        (F.col("id") % 97).alias("t"),
    )


def test_dedup_latest_on_hot_key(spark):
    df = skewed(spark).repartition(8)
    got = {r["k"]: (r["t"], r["v"]) for r in dedup_latest(df, ["k"], ["t"]).collect()}
    hot = max(((v % 97), v) for v in range(0, N, 3))
    assert got[HOT] == hot
    assert len(got) == 1 + sum(1 for v in range(N) if v % 3 != 0)
    assert dedup_by_key(df, ["k"]).count() == len(got)


def test_dup_count_on_hot_key(spark):
    df = skewed(spark).repartition(8)
    counts = dict(dup_count(df, ["k"]).groupBy("k").agg(F.max("dup_count").alias("c")).collect())
    assert counts[HOT] == N // 3
    assert all(c == 1 for k, c in counts.items() if k != HOT)


def test_insert_only_merge_with_hot_stored_key(spark):
    stored = skewed(spark).where(F.col("v") < N // 2)
    new = skewed(spark).where(F.col("v") >= N // 3).withColumn("v", F.col("v") + N)
    merged = merge_insert_only(new, stored, ["k"])
    keys = [r["k"] for r in merged.select("k").collect()]
    assert keys.count(HOT) == stored.where(F.col("k") == HOT).count()  # hot key not re-inserted
    assert merged.count() == stored.count() + new.where(F.col("k") != HOT).where(F.col("v") >= N + N // 2).count()


def test_nest_splits_hot_parent_into_bounded_chunks(spark):
    df = skewed(spark).repartition(8)
    chunks = nest_children(df, ["k"], "data", max_items=128)
    hot = chunks.where(F.col("k") == HOT).select(F.size("data").alias("n")).collect()
    assert len(hot) >= (N // 3) // 128 and max(r["n"] for r in hot) <= 128
    back = explode_records(chunks, "data", on_collision="first")
    assert back.count() == N and back.select("v").distinct().count() == N
