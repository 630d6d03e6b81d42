"""Merging a new batch into stored, day-partitioned data.

The reference unions the new flat rows with the stored rows of the touched
partitions and drops key duplicates. Here the same net effect is a union plus
an anti join (insert-only merge), which is deterministic: a row already
stored is never replaced, so replaying a batch is harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedup import _keys, dedup_latest
from tidemark.sources.partitions import MAX_FOLDERS


def merge_union(new: DataFrame, stored: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns missing on one side become NULL."""
    return new.unionByName(stored, allowMissingColumns=True)


def _null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    return [left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in keys]


def anti_by_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other`` (NULL keys match NULL).

    ``other`` is reduced to its distinct keys first: one row per key, so a hot
    key on the stored side cannot skew the join; the skewed side, if any, is
    ``df`` (the left side of an anti join, which AQE can split).
    """
    keys = _keys(df, keys)
    other_keys = other.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    return df.join(other_keys, _null_safe_on(df, other_keys, keys), "left_anti")


def merge_insert_only(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """stored ∪ (new rows whose key is not stored); one row per new key,
    chosen deterministically (greatest row) when the batch repeats a key."""
    fresh = dedup_latest(anti_by_keys(new, stored, keys), keys, order_by=[])
    return stored.unionByName(fresh, allowMissingColumns=True)


def merge_dedup(
    new: DataFrame,
    stored: DataFrame,
    keys: Sequence[str],
    prefer: str = "stored",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Union then one row per key with an explicit winner.

    ``prefer``: ``stored`` (insert-only), ``new`` (upsert: new rows replace
    stored ones) or ``latest`` (greatest ``order_by``).
    """
    if prefer == "stored":
        return merge_insert_only(new, stored, keys)
    if prefer == "new":
        fresh = dedup_latest(new, keys, order_by=[])
        return fresh.unionByName(anti_by_keys(stored, fresh, keys), allowMissingColumns=True)
    if prefer == "latest":
        return dedup_latest(merge_union(new, stored), keys, order_by)
    raise ValueError(f"unknown prefer {prefer!r}")


def touched_partitions(df: DataFrame, part_col: str) -> DataFrame:
    """Distinct partition values of a batch (one tiny aggregate).

    Only the partition column is read, so Catalyst prunes the scan down to
    the leaves it is derived from.
    """
    return df.select(F.col(f"`{part_col}`")).distinct()


def existing_partitions(touched: DataFrame, stored: DataFrame, part_col: str) -> DataFrame:
    """Touched partition values that already hold stored data (semi join).

    The stored side is first cut to the touched range, a partition filter, so
    the folders of other days are not opened.
    """
    part = T.StructField(part_col, touched.schema[part_col].dataType, True)
    stored = stored.where(within_touched(part, touched_summary(touched, part_col)))
    stored_parts = stored.select(F.col(f"`{part_col}`")).distinct()
    return touched.join(stored_parts, _null_safe_on(touched, stored_parts, [part_col]), "left_semi")


def touched_summary(df: DataFrame, part_col: str) -> Row:
    """One row: ``partitions`` and ``rows`` of a batch, the least and greatest
    partition value as text (``lo``, ``hi``), whether one is NULL (``has_null``)
    and the ``values`` as text, NULL included (None if there are more than
    ``MAX_FOLDERS``). One pruned aggregate; what it brings to the driver is bounded."""
    part = F.col(f"`{part_col}`")
    counts = df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    some = counts.select("part", F.col("part").cast("string").alias("text"), "n").limit(MAX_FOLDERS + 1).collect()
    if len(some) <= MAX_FOLDERS:
        known = [r for r in some if r["part"] is not None]
        lo, hi = (f(known, key=lambda r: r["part"])["text"] if known else None for f in (min, max))
        return Row(partitions=len(some), rows=sum(r["n"] for r in some), lo=lo, hi=hi, has_null=len(known) < len(some), values=[r["text"] for r in some])
    return counts.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.min("part").cast("string").alias("lo"),
        F.max("part").cast("string").alias("hi"),
        F.coalesce(F.bool_or(F.col("part").isNull()), F.lit(False)).alias("has_null"),
        F.lit(None).alias("values"),
    ).first()


def within_touched(part: T.StructField, touched: Row) -> Column:
    """Partition filter: the column lies in the range of a ``touched_summary``."""
    col = F.col(f"`{part.name}`")
    lo, hi = (F.lit(touched[k]).cast(part.dataType) for k in ("lo", "hi"))
    cond = col.between(lo, hi) if touched["lo"] is not None else F.lit(False)
    return cond | col.isNull() if touched["has_null"] else cond


def restrict_by_frame(stored: DataFrame, parts: DataFrame, part_col: str) -> DataFrame:
    """Stored rows whose partition value occurs in ``parts`` (null-safe semi
    join; the list never reaches the driver)."""
    values = parts.select(F.col(f"`{part_col}`").alias("_part")).distinct()
    return stored.join(values, stored[f"`{part_col}`"].eqNullSafe(values["_part"]), "left_semi")
