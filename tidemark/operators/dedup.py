"""Duplicate removal.

All variants are aggregations with a map-side (partial) step, so a key that
holds a third of all rows is first collapsed to one row per map task before
anything crosses the shuffle. Window functions (``row_number`` over the key)
would instead send every row of a hot key to one task; they are not used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import resolve_columns


def _keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    resolved = resolve_columns(df, keys)
    missing = [k for k in keys if k not in resolved]
    if missing:
        raise ValueError(f"unknown key columns {missing}; have {df.columns}")
    return [resolved[k] for k in keys]


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact-duplicate removal over all columns (hash aggregate, partial first)."""
    return df.distinct()


def dedup_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, survivor arbitrary (NULL keys compare equal)."""
    return df.dropDuplicates(_keys(df, keys))


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    latest: bool = True,
) -> DataFrame:
    """One row per key: the greatest (``latest``) or least by ``order_by``,
    ties broken by the remaining columns in schema order, so the survivor is
    fully determined. NULLs in ordering columns lose.

    Implemented as ``max``/``min`` of a struct per key: an aggregate with a
    partial step, skew-safe, one shuffle.
    """
    keys = _keys(df, keys)
    order = _keys(df, order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    if latest:
        packed = F.struct(*[F.col(f"`{c}`") for c in order + rest])
    else:
        # NULLs must lose under min as well: order by (is-null, value)
        parts: list[Column] = []
        for i, c in enumerate(order + rest):
            parts += [F.col(f"`{c}`").isNull().alias(f"_n{i}"), F.col(f"`{c}`").alias(c)]
        packed = F.struct(*parts)
    agg = F.max(packed) if latest else F.min(packed)
    won = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(agg.alias("_w"))
    return won.select(*[F.col(f"`{c}`") if c in keys else F.col("_w").getField(c).alias(c) for c in df.columns])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """key_hash of the keys that several rows have, and of keys that share a hash with another."""
    key_hash = F.xxhash64(*[F.col(f"`{k}`") for k in _keys(df, keys)]).alias("key_hash")
    return df.groupBy(key_hash).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("key_hash")


def dedup_repeated(df: DataFrame, keys: Sequence[str], repeated: DataFrame) -> DataFrame:
    """``dedup_latest`` with no order, for ``repeated_keys`` that are known and few:
    only their rows are aggregated, the others pass as they are."""
    key_hash = F.xxhash64(*[df[f"`{k}`"] for k in _keys(df, keys)])
    alone = df.join(repeated, key_hash == repeated["key_hash"], "left_anti")
    several = df.join(repeated, key_hash == repeated["key_hash"], "left_semi")
    return alone.unionByName(dedup_latest(several, keys, order_by=[]))


def dup_count(df: DataFrame, keys: Sequence[str], name: str = "dup_count") -> DataFrame:
    """Every row plus the number of rows sharing its key.

    Aggregate-then-join rather than ``count() over (partition by key)``: the
    count is partial per task, and the join back is an inner equi-join whose
    skewed side AQE can split.
    """
    keys = _keys(df, keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    renamed = counts.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], name)
    cond = [df[f"`{k}`"].eqNullSafe(renamed[f"_k{i}"]) for i, k in enumerate(keys)]
    joined = df.join(renamed, cond, "inner")
    return joined.select(*[df[f"`{c}`"] for c in df.columns], F.col(name))
