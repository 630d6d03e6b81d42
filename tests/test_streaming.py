"""Streaming ingest: the file-source checkpoint is the watermark."""

from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sinks.parquet import write_partitioned
from tidemark.streaming.dedup import stream_dedup, write_stream_files
from tidemark.streaming.ingest import file_stream, stream_ingest

SCHEMA = "k long, v string, transaction_date date, date date"


def _land(spark, root, rows, day):
    df = spark.createDataFrame(rows, "k long, v string, transaction_date date")
    write_partitioned(df.withColumn("date", F.lit(day).cast("date")), root, ["date"], mode="append", dynamic=False)


def test_rerun_reads_only_new_files_and_merge_is_idempotent(spark):
    import datetime as dt

    d = dt.date(2024, 1, 5)
    landing, target, ckpt = (scratch_path(spark, n) for n in ("sl", "st", "sc"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        stream_ingest(spark, landing, schema, target, ckpt, ["k", "transaction_date"], transform=lambda b: b.drop("date"))
        return sorted((r["k"], r["v"]) for r in spark.read.parquet(target).collect())

    _land(spark, landing, [(1, "a", d), (2, "a", d)], "2024-01-29")
    assert run() == [(1, "a"), (2, "a")]
    assert run() == [(1, "a"), (2, "a")]  # nothing new: no-op
    _land(spark, landing, [(2, "b", d), (3, "b", d)], "2024-01-30")  # key 2 re-delivered
    assert run() == [(1, "a"), (2, "a"), (3, "b")]


def test_stream_dedup_across_micro_batches(spark):
    import datetime as dt

    d = dt.date(2024, 1, 5)
    landing, target, ckpt = (scratch_path(spark, n) for n in ("dl", "dt", "dc"))
    for day in ("2024-01-28", "2024-01-29", "2024-01-30"):
        _land(spark, landing, [(1, "x", d), (2, "x", d)], day)
    stream = file_stream(spark, landing, spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1)
    events = stream.withColumn("ts", F.to_timestamp(F.lit("2024-01-05 00:00:00"))).drop("date")
    write_stream_files(stream_dedup(events, ["k"], "ts", "1 day"), target, ckpt)
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == [1, 2]
