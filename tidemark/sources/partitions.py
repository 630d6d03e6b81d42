"""Partition folders of a stored table, addressed by value.

Spark lists every file of a table before it prunes folders, so a read through
the table's root costs its whole history. Here the folders that a batch touches
are named as Spark's writer names them (escaped values, one name for NULL) and
only these are listed and opened. What is looked at on the driver are folder
names, bounded by ``MAX_FOLDERS``; callers fall back to a partition filter over
the root beyond it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import SparkSession

MAX_FOLDERS = 10_000
# up to so many folders are looked up one by one, more by one listing of the root
SINGLE_LOOKUPS = 32
UNESCAPED = re.compile(r"[A-Za-z0-9 _.-]+")


def file_system(spark: SparkSession, path: str):
    """(file system, path object) of whatever store holds ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folder_name(spark: SparkSession, column: str, value: str | None) -> str:
    """``column=value`` as Spark's writer spells it; ``value`` is the value cast to text."""
    if value and UNESCAPED.fullmatch(value) and UNESCAPED.fullmatch(column):
        return f"{column}={value}"
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)


def folder_value(spark: SparkSession, name: str) -> str | None:
    """The value of a folder name, as text (None for the folder of NULL)."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    value = utils.unescapePathName(name.split("=", 1)[1])
    return None if value == utils.DEFAULT_PARTITION_NAME() else value


def all_folders(spark: SparkSession, root: str, column: str) -> list[str]:
    """Names of the partition folders under ``root``: one listing, no file is looked at."""
    fs, where = file_system(spark, root)
    if not fs.exists(where):
        return []
    prefix = folder_name(spark, column, "x")[:-1]
    names = (s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())
    return sorted(n for n in names if n.startswith(prefix))


def stored_folders(spark: SparkSession, root: str, column: str, values: Iterable[str | None]) -> list[str]:
    """Paths of the folders of ``values`` that exist."""
    names = sorted({folder_name(spark, column, v) for v in values})
    root = root.rstrip("/")
    if len(names) <= SINGLE_LOOKUPS:
        fs, _ = file_system(spark, root)
        path = spark._jvm.org.apache.hadoop.fs.Path
        return [f"{root}/{n}" for n in names if fs.exists(path(f"{root}/{n}"))]
    held = set(all_folders(spark, root, column))
    return [f"{root}/{n}" for n in names if n in held]
