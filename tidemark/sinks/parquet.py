"""Day-partitioned parquet output.

* Only the partitions present in the written frame are replaced (dynamic
  partition overwrite, set per write, not per session).
* Layout: ``REBALANCE(partition column)`` lets AQE hash rows to tasks by
  partition value and split a hot value over several tasks, so a day that
  holds a third of the data is written by many tasks, not one; small days
  are coalesced. ``maxRecordsPerFile`` bounds file size.
* A merge that reads the partitions it replaces is first staged in the
  shared checkpoint folder; the overwrite then reads only the staged copy,
  so a failure at any point leaves a re-runnable state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import remove_path, scratch_path


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    mode: str = "overwrite",
    dynamic: bool = True,
    max_records_per_file: int | None = 5_000_000,
    rebalance: bool = True,
    compression: str = "snappy",
    counted: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """``counted`` may observe the rows: behind the layout's shuffle, as an empty shuffle goes from the plan with all before it."""
    out = counted(df.hint("rebalance", *partition_by) if rebalance else df)
    writer = out.write.mode(mode).option("compression", compression)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.partitionBy(*partition_by).parquet(path)


@contextmanager
def staged(df: DataFrame, spark: SparkSession, name: str = "stage") -> Iterator[DataFrame]:
    """Write ``df`` to a fresh folder under the checkpoint root and read it back;
    the folder goes when the block ends.

    Cuts lineage to the inputs (here: the partitions about to be replaced).
    zstd: what is read once or twice and goes should take little room.
    """
    where = scratch_path(spark, name)
    df.write.mode("error").option("compression", "zstd").parquet(where)
    try:
        yield spark.read.schema(df.schema).parquet(where)
    finally:
        remove_path(spark, where)
