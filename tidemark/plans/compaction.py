"""Compaction of partition folders that have gathered small files.

Appends leave a few files a run in every folder they touch. A folder with more
files than its bytes need is rewritten to as many as they do need: its rows are
staged, dealt over that number of tasks by a hash of the row, and swapped in by
the same dynamic overwrite that merges use. Folders that are fine are not read.
A run that dies before the swap has changed nothing; one that dies after it has
done its work. It must not run beside a merge into the same folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import touched_summary
from tidemark.plans.etl import read_partitions
from tidemark.sinks.parquet import staged, write_partitioned
from tidemark.sources.files import file_inventory


def partition_files(spark: SparkSession, target: str, part: T.StructField, target_bytes: int) -> DataFrame:
    """Per stored partition: n_files, n_bytes and the files its bytes need."""
    files = file_inventory(spark, target, glob="*.parquet", partitions=T.StructType([part]))
    value = F.col(f"`{part.name}`").cast(part.dataType).alias(part.name)
    found = files.groupBy(value).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    return found.withColumn("needed", F.greatest(F.ceil(F.col("n_bytes") / target_bytes), F.lit(1)))


def compact_partitions(spark: SparkSession, target: str, part: T.StructField, target_bytes: int = 512 << 20) -> int:
    """Rewrite partitions that hold more files than needed; returns how many."""
    sizes = partition_files(spark, target, part, target_bytes)
    with staged(sizes.where(F.col("n_files") > F.col("needed")), spark, "compaction") as crowded:
        touched = touched_summary(crowded, part.name)
        if not touched["partitions"]:
            return 0
        rows = read_partitions(spark, target, part, touched)
        wanted = crowded.select(F.col(f"`{part.name}`").alias("_part"), "needed")
        met = rows.join(wanted, rows[f"`{part.name}`"].eqNullSafe(F.col("_part")))
        with staged(met.select(*rows.columns, "needed"), spark, "compacted") as kept:
            share = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if c != part.name]), F.col("needed"))
            # a given number of tasks, so that adaptive planning does not merge shares again
            files = crowded.agg(F.sum("needed")).first()[0]
            tasks = max(2 * files, int(spark.conf.get("spark.sql.shuffle.partitions")))
            dealt = kept.withColumn("_share", share).repartition(tasks, f"`{part.name}`", "_share").select(*rows.columns)
            write_partitioned(dealt, target, [part.name], rebalance=False, max_records_per_file=None)
    return touched["partitions"]
