"""Retention: partitions older than a horizon go, by their folders alone.

Only folder names are read. The list of what is to go is written first (a
tombstone), then the folders are deleted; a run that died in between is finished
by the next one, which deletes what its tombstones still name. NULL partitions
and folders whose value does not read as the partition's type stay.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.partitions import all_folders, file_system, folder_value

TOMBSTONE = T.StructType([T.StructField("folder", T.StringType()), T.StructField("value", T.StringType()), T.StructField("run", T.StringType())])


def expired_partitions(spark: SparkSession, target: str, part: T.StructField, before) -> DataFrame:
    """folder, value of the partitions below ``before`` (a dry run: nothing changes)."""
    named = [(n, folder_value(spark, n)) for n in all_folders(spark, target, part.name)]
    folders = spark.createDataFrame(named, T.StructType(TOMBSTONE.fields[:2]))
    return folders.where(F.col("value").try_cast(part.dataType) < F.lit(before).cast(part.dataType))


def tombstones(spark: SparkSession, root: str) -> DataFrame:
    """folder, value, run of everything that was ever to go."""
    try:
        return spark.read.schema(TOMBSTONE).json(root)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], TOMBSTONE)
        raise


def drop_expired(spark: SparkSession, target: str, part: T.StructField, before, tombstone_root: str, dry_run: bool = False) -> DataFrame:
    """folder, value of the partitions that went (or, in a dry run, would go)."""
    found = expired_partitions(spark, target, part, before)
    if dry_run:
        return found
    run = uuid.uuid4().hex[:12]
    found.withColumn("run", F.lit(run)).coalesce(1).write.mode("append").json(tombstone_root)
    _finish(spark, target, part, before, tombstone_root)
    return tombstones(spark, tombstone_root).where(F.col("run") == run).select("folder", "value")


def _finish(spark: SparkSession, target: str, part: T.StructField, before, tombstone_root: str) -> None:
    """Delete what stands and a tombstone names; a folder that was filled anew above the horizon is not named."""
    standing = set(all_folders(spark, target, part.name))
    below = F.col("value").try_cast(part.dataType) < F.lit(before).cast(part.dataType)
    fs, where = file_system(spark, target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for row in tombstones(spark, tombstone_root).where(below).select("folder").distinct().toLocalIterator():
        if row["folder"] in standing:
            fs.delete(path(where, row["folder"]), True)
