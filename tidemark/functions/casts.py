"""Lenient casts and schema conformance.

Bad input becomes NULL instead of failing the job (the batch semantics of the
reference), independent of ``spark.sql.ansi.enabled``: every cast goes
through ``try_cast`` or a ``try_*`` function. Everything stays a Catalyst
expression, so a 100-column conformance is one codegen'd projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: an integral number with an optional fractional part that is
# dropped (string -> bigint keeps the integer part, '12.7' -> 12).
INTEGRAL_TEXT = r"^([+-]?[0-9]+)([.][0-9]*)?$"

# Epoch at 00:00 without a zone, the origin for numeric -> timestamp_ntz.
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# A time of day with a zone behind it (Z, a UTC offset or a zone's
# name), and the year that a text must begin with to have a date at all.
ZONE_END = r"[0-9]:[0-9]{1,2}(:[0-9]{1,2}([.][0-9]*)?)?\s*([A-Za-z]|[+-][0-9])"
DATE_START = r"^[+-]?[0-9]{4}"

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _as_type(t: T.DataType | str) -> T.DataType:
    if isinstance(t, T.DataType):
        return t
    return T._parse_datatype_string(t)


# Fixed value: the start every parseable floating-point text has (sign, then
# a digit, a dot, NaN or Infinity). Text not starting like this is skipped
# before the cast; it could not parse anyway.
FLOAT_START = r"(?i)^[+-]?([0-9.]|nan|inf)"


# Fixed value: the characters Spark's own casts strip from both ends of a text.
PADDING = "".join(map(chr, [*range(0x21), 0x7F]))


def _strip(col: Column) -> Column:
    """Without white space and control characters at the ends, as a cast reads it."""
    return F.trim(col, F.lit(PADDING))


def _integral(col: Column, target: str) -> Column:
    """Integer part of numeric text; junk and overflow -> NULL.

    The cast runs only on text the pattern matched: a failed string ->
    integral ``try_cast`` costs an exception per row, which on junk-heavy
    columns is most of the projection's time.
    """
    digits = F.regexp_extract(_strip(col), INTEGRAL_TEXT, 1)
    return F.when(digits != F.lit(""), digits.try_cast(target))


def to_bigint(col: Column, source: T.DataType | None = None) -> Column:
    """bigint; strings keep their integer part, junk and overflow -> NULL."""
    if isinstance(source, T.StringType):
        return _integral(col, "bigint")
    return col.try_cast("bigint")


def to_int(col: Column, source: T.DataType | None = None) -> Column:
    if isinstance(source, T.StringType):
        return _integral(col, "int")
    return col.try_cast("int")


def to_double(col: Column, source: T.DataType | None = None) -> Column:
    if isinstance(source, T.StringType):
        text = _strip(col)
        return F.when(text.rlike(FLOAT_START), text.try_cast("double"))
    return col.try_cast("double")


def to_string(col: Column, source: T.DataType | None = None) -> Column:
    """Text form; arrays render as ``[1, 2]``."""
    return col.try_cast("string")


def to_json_text(col: Column) -> Column:
    """JSON text of an array, struct or map (``to_string`` gives Spark's own rendering)."""
    return F.to_json(col)


def epoch_to_timestamp_ntz(col: Column, unit: str = "s") -> Column:
    """Epoch number -> wall-clock timestamp without a zone (no session tz)."""
    scale = {"s": 1_000_000, "ms": 1_000, "us": 1}[unit]
    micros = (col.try_cast("double") * F.lit(scale)).try_cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH_NTZ))


def ntz_as_utc_instant(col: Column) -> Column:
    """Wall-clock ``timestamp_ntz`` read as UTC -> zoned ``timestamp``.

    Independent of the session time zone (no DST gaps or repeats), so it can
    drive watermarks and epoch arithmetic.
    """
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), col)
    return F.timestamp_micros(micros)


def to_timestamp_ntz(col: Column, source: T.DataType | None = None, unit: str = "s") -> Column:
    """Wall-clock timestamp; a text with an offset or a named zone gives its UTC
    wall clock, a time without a date NULL (a cast would take the day of the run)."""
    if source is not None and isinstance(source, _NUMERIC):
        return epoch_to_timestamp_ntz(col, unit)
    if isinstance(source, T.StringType):
        text = _strip(col)
        instant = F.unix_micros(text.try_cast("timestamp"))
        shifted = F.timestamp_add("MICROSECOND", instant, F.expr(_EPOCH_NTZ))
        dated = F.when(text.rlike(ZONE_END), shifted).otherwise(text.try_cast("timestamp_ntz"))
        return F.when(text.rlike(DATE_START), dated)
    return col.try_cast("timestamp_ntz")


def to_timestamp(col: Column, source: T.DataType | None = None, unit: str = "s") -> Column:
    """Zoned timestamp; numbers are epoch seconds (or ``unit``), a time without a date is NULL."""
    if source is not None and isinstance(source, _NUMERIC):
        scale = {"s": 1_000_000, "ms": 1_000, "us": 1}[unit]
        # whole numbers stay exact; what does not fit in microseconds becomes NULL
        inexact = isinstance(source, (T.FloatType, T.DoubleType))
        micros = col.try_cast("double") * F.lit(scale) if inexact else F.try_multiply(
            col.try_cast("decimal(38,6)"), F.lit(scale))
        return F.timestamp_micros(micros.try_cast("bigint"))
    if isinstance(source, T.StringType):
        return F.when(_strip(col).rlike(DATE_START), _strip(col).try_cast("timestamp"))
    return col.try_cast("timestamp")


def to_date(col: Column, source: T.DataType | None = None) -> Column:
    """Calendar date; '' and junk -> NULL."""
    if isinstance(source, T.StringType):
        return F.nullif(_strip(col), F.lit("")).try_cast("date")
    return col.try_cast("date")


def cast_to(col: Column, target: T.DataType | str, source: T.DataType | None = None, unit: str = "s") -> Column:
    """Dispatch on the target type; the source type picks the text rules."""
    target = _as_type(target)
    if isinstance(target, T.LongType):
        return to_bigint(col, source)
    if isinstance(target, T.IntegerType):
        return to_int(col, source)
    if isinstance(target, T.DoubleType):
        return to_double(col, source)
    if isinstance(target, T.StringType):
        return to_string(col, source)
    if isinstance(target, T.TimestampNTZType):
        return to_timestamp_ntz(col, source, unit)
    if isinstance(target, T.TimestampType):
        return to_timestamp(col, source, unit)
    if isinstance(target, T.DateType):
        return to_date(col, source)
    return col.try_cast(target)


def resolve_columns(df: DataFrame, names: Iterable[str]) -> dict[str, str]:
    """Map each wanted name to the frame's column, ignoring case.

    Raises on unknown or ambiguous names instead of failing later in the plan.
    """
    by_lower: dict[str, list[str]] = {}
    for c in df.columns:
        by_lower.setdefault(c.lower(), []).append(c)
    out = {}
    for n in names:
        hits = by_lower.get(n.lower(), [])
        if len(hits) > 1:
            raise ValueError(f"column {n!r} is ambiguous: {hits}")
        if hits:
            out[n] = hits[0]
    return out


def conform(
    df: DataFrame,
    spec: Sequence[tuple[str, T.DataType | str]],
    missing: str = "error",
    unit: str = "s",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Project ``df`` onto a fixed (name, type) spec, lenient casts only.

    ``missing="null"`` fills absent columns with typed NULLs (schema drift);
    ``keep`` passes extra columns through uncast, after the spec columns.
    """
    resolved = resolve_columns(df, [n for n, _ in spec] + list(keep))
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for name, target in spec:
        target = _as_type(target)
        src = resolved.get(name)
        if src is None:
            if missing == "null":
                exprs.append(F.lit(None).cast(target).alias(name))
                continue
            raise ValueError(f"column {name!r} missing from input {df.columns}")
        exprs.append(cast_to(F.col(f"`{src}`"), target, types[src], unit).alias(name))
    spec_names = {n.lower() for n, _ in spec}
    for k in keep:
        if k.lower() not in spec_names and k in resolved:
            exprs.append(F.col(f"`{resolved[k]}`").alias(k))
    return df.select(*exprs)


def cast_rejects(
    df: DataFrame, spec: Sequence[tuple[str, T.DataType | str]], unit: str = "s"
) -> DataFrame:
    """Per spec column: rows where the input is set but the cast gave NULL.

    One pass, one global aggregate (partial per task, a single row per task
    crosses the shuffle), then unpivot to (column, target_type, rejected).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    resolved = resolve_columns(df, [n for n, _ in spec])
    sums = []
    for name, target in spec:
        target = _as_type(target)
        src = resolved[name]
        c = F.col(f"`{src}`")
        bad = c.isNotNull() & cast_to(c, target, types[src], unit).isNull()
        sums.append(F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).alias(name))
    pairs = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(_as_type(t).simpleString()).alias("target_type"),
            F.col(f"`{name}`").cast("bigint").alias("rejected"),
        )
        for name, t in spec
    ]
    return df.agg(*sums).select(F.inline(F.array(*pairs)))


REJECT = T.ArrayType(T.StructType([T.StructField(n, T.StringType(), True) for n in ("column_name", "raw", "target_type")]))


def reject_array(df: DataFrame, spec: Sequence[tuple[str, T.DataType | str]], unit: str = "s") -> Column:
    """Array of (column_name, raw, target_type): the values of a row that are set but do not cast."""
    types = {f.name: f.dataType for f in df.schema.fields}
    resolved = resolve_columns(df, [n for n, _ in spec])
    found = []
    for name, target in spec:
        src, target = resolved.get(name), _as_type(target)
        if src is None or types[src] == target:
            continue
        c = F.col(f"`{src}`")
        bad = c.isNotNull() & cast_to(c, target, types[src], unit).isNull()
        entry = F.struct(F.lit(name).alias("column_name"), c.try_cast("string").alias("raw"), F.lit(target.simpleString()).alias("target_type"))
        found.append(F.when(bad, entry))
    return F.filter(F.array(*found), lambda x: x.isNotNull()).cast(REJECT) if found else F.array().cast(REJECT)


def rejected_rows(df: DataFrame, keys: Sequence[str], errors_col: str) -> DataFrame:
    """One row a rejected value: the row's keys, column_name, raw, target_type."""
    return df.where(F.size(errors_col) > 0).select(*keys, F.inline(errors_col))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected values per column, from the rows of ``rejected_rows``."""
    return rejects.groupBy("column_name", "target_type").agg(F.count(F.lit(1)).alias("rejected"))
