"""The incremental ETL run (discovery -> scan -> flatten -> merge -> write -> audit).

Order matters for recovery: the audit record that moves the watermark is
written last, after the data. A run that dies anywhere before that is simply
re-run: it re-reads the same files, and the insert-only merge (append of
not-yet-stored keys) makes the replay harmless.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import rejected_rows, resolve_columns
from tidemark.functions.ids import content_id
from tidemark.operators.audit import STATUS_COMPLETED, audit_record, job_watermark
from tidemark.operators.dedup import dedup_latest, dedup_repeated, repeated_keys
from tidemark.operators.merge import anti_by_keys, merge_dedup, restrict_by_frame, touched_summary, within_touched
from tidemark.plans.transform import transform
from tidemark.schema import PARTITION_COLUMN, RESULT_SHAPE, RecordShape
from tidemark.session import release_shuffles
from tidemark.sinks.audit import append_audit, read_audit
from tidemark.sinks.parquet import staged, write_partitioned
from tidemark.sources.files import DAY_PARTITION, file_inventory, modified_since, window_globs
from tidemark.sources.ledger import NewFiles
from tidemark.sources.nested import empty_like, read_nested
from tidemark.sources.partitions import all_folders, stored_folders


ERRORS = "_errors"
# repeated keys are few if a batch has this many rows for each
FEW_REPEATED = 16
# a run of this many rows has its shuffle files dropped between its steps
RELEASE_ROWS = 1_000_000


def _missing(e: AnalysisException) -> bool:
    s = str(e)
    return "PATH_NOT_FOUND" in s or "Path does not exist" in s or "UNABLE_TO_INFER_SCHEMA" in s


def _part_field(df: DataFrame, part_col: str) -> T.StructField:
    return T.StructField(part_col, df.schema[part_col].dataType, True)


def read_partitions(
    spark: SparkSession,
    target: str,
    part: T.StructField,
    touched: Row,
    fields: Sequence[T.StructField] | None = None,
) -> DataFrame | None:
    """Stored rows of the batch's partitions (None if none of them is stored).

    Only the folders of these values are listed and opened, whatever characters
    the values hold. A batch of more than ``MAX_FOLDERS`` partitions reads the
    folders between its least and greatest value through a partition filter.
    ``part`` fixes the partition column's type, as folder names alone would read
    "01" as a number. ``fields``: read these columns only; without them all that
    any file of these folders has.
    """
    paths = [target] if touched["values"] is None else stored_folders(spark, target, part.name, touched["values"])
    if not paths:
        return None
    try:
        if fields is None:
            found = spark.read.option("basePath", target).option("mergeSchema", "true").parquet(*paths).schema.fields
            fields = [f for f in found if f.name != part.name]
        stored = spark.read.schema(T.StructType([*fields, part])).option("basePath", target).parquet(*paths)
    except AnalysisException as e:
        if _missing(e):
            return None
        raise
    return stored.where(within_touched(part, touched))


def upsert_partitions(
    spark: SparkSession,
    new: DataFrame,
    target: str,
    keys: Sequence[str],
    part_col: str = PARTITION_COLUMN,
    prefer: str = "stored",
    order_by: Sequence[str] = (),
    touched: Row | None = None,
    observed: Observation | None = None,
    laid_out: bool = False,
    late: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Merge ``new`` into ``target``; returns the number of touched partitions.

    ``keys`` must hold ``part_col``: a merge sees the touched partitions only,
    so a key that may move between partitions could not be kept unique.

    ``prefer="stored"`` (insert-only, the default): stored rows never change,
    so nothing is rewritten. Only the batch rows whose key is not stored yet
    are appended; the anti join reads just the key columns of the touched
    partitions. Repeated keys are found on the keys alone, so wide rows are
    aggregated only where a key has several. A crash anywhere is repaired by
    re-running: rows that made it are now "stored" and are not appended twice.

    ``prefer="new"`` / ``"latest"`` (greatest ``order_by``, which must be
    given): the touched partitions are rebuilt from stored + batch with the
    columns of both, staged under the checkpoint root (the merge reads what it
    replaces), then swapped in by dynamic partition overwrite. Untouched
    partitions are not rewritten in either mode.

    ``observed`` gets ``rows_written`` as the write itself counts them.
    ``laid_out``: the files of ``new`` hold few partitions each, so rows that go
    straight to an insert are not shuffled by partition again. ``late`` adds columns that
    follow from the others: behind the last shuffle, unless rows of a key must be told apart by them.
    """

    def counted(rows: DataFrame) -> DataFrame:
        return rows.observe(observed, F.count(F.lit(1)).alias("rows_written")) if observed else rows

    if prefer != "stored":
        new, late = late(new), lambda rows: rows

    if part_col.lower() not in {k.lower() for k in keys}:
        raise ValueError(f"keys {list(keys)} must hold the partition column {part_col!r}")
    if prefer == "latest" and not order_by:
        raise ValueError('prefer="latest" needs order_by')
    part = _part_field(new, part_col)
    if isinstance(part.dataType, T.StringType):
        # an empty value is stored in the NULL partition
        new = new.withColumn(part_col, F.nullif(F.col(f"`{part_col}`"), F.lit("")))
    if touched is None:
        touched = touched_summary(new, part_col)
    if not touched["partitions"]:
        return 0
    if prefer == "stored":
        names = resolve_columns(new, keys).values()
        stored = read_partitions(spark, target, part, touched, [new.schema[k] for k in names if k != part_col])
        # stored keys leave before the wide rows are reduced to one per key
        fresh = new if stored is None else anti_by_keys(new, stored, keys)
        with staged(repeated_keys(new, keys), spark, "repeated-keys") as repeated:
            n, rebalance, columns = repeated.count(), True, late(new).columns
            if n == 0:
                batch, rebalance = fresh.select(*new.columns), not (laid_out and stored is None)
                finish = lambda rows: late(counted(rows))
            else:
                fresh, finish = late(fresh), counted
                few = stored is None and n * FEW_REPEATED <= touched["rows"]
                batch = (dedup_repeated(fresh, keys, repeated) if few else dedup_latest(fresh, keys, order_by=[])).select(*columns)
            if touched["rows"] >= RELEASE_ROWS:
                release_shuffles(spark)
            write_partitioned(batch, target, [part_col], mode="append", dynamic=False, rebalance=rebalance, counted=finish)
        return touched["partitions"]
    stored = read_partitions(spark, target, part, touched)
    if stored is None:
        batch = dedup_latest(new, keys, order_by)
        write_partitioned(batch.select(*new.columns), target, [part_col], counted=counted)
        return touched["partitions"]
    merged = merge_dedup(new, restrict_by_frame(stored, new, part_col), keys, prefer, order_by)
    with staged(merged, spark, "merge") as rows:
        write_partitioned(rows, target, [part_col], counted=counted)
    return touched["partitions"]


def scan_window(
    spark: SparkSession,
    landing_root: str,
    schema: T.StructType,
    after,
    as_of=None,
    days: int | None = None,
    fmt: str = "json",
) -> DataFrame:
    """Records of files modified at or after the second of ``after``, within the
    trailing window.

    Object stores stamp whole seconds, so a file put later in the watermark's
    own second carries a time before it; reading that second again is harmless,
    as the merge is idempotent. The modification-time condition is on ``_metadata`` and prunes files at
    planning; the window is a path glob, so other days are never listed.
    """
    if days and as_of is None:
        as_of = _dt.datetime.now(_dt.timezone.utc).date()  # window ends today (UTC)
    paths = window_globs(landing_root, as_of, days) if days else landing_root
    try:
        df = read_nested(spark, paths, schema, fmt=fmt, base_path=landing_root)
    except AnalysisException as e:
        if _missing(e):
            return empty_like(spark, schema)
        raise
    return df.where(modified_since(F.col("_metadata.file_modification_time"), after))


def run_etl(
    spark: SparkSession,
    landing_root: str,
    target: str,
    audit_root: str,
    job_name: str,
    schema: T.StructType,
    as_of=None,
    days: int | None = None,
    fmt: str = "json",
    keys: Sequence[str] | None = None,
    run_id: str | None = None,
    run_ts: _dt.datetime | None = None,
    flat_target: str | None = None,
    shape: RecordShape = RESULT_SHAPE,
    ledger_root: str | None = None,
    reject_target: str | None = None,
) -> dict:
    """One incremental run. Returns a small summary (driver-side values).

    ``shape`` says which columns a record has and what becomes of them; ``keys``
    replaces the shape's own dedup key. ``flat_target``: optional second output
    holding every flat row of the run before key de-duplication
    (day-partitioned; rows already there from a run that died are not repeated).

    ``ledger_root``: choose files by the ledger of processed files instead of the
    watermark, so that each file is read once, however late it came or was
    stamped. ``reject_target``: keep every value that did not cast (row id, file,
    column, text, target type) there, one folder a run.

    The landing files are evaluated once: the flat rows, with the values that did
    not cast beside them, are staged under the checkpoint root; flat output,
    rejects and merge read the staged copy. Rows read, rejected and written are
    counted by the writes themselves and stand in the audit record.
    """
    start = _dt.datetime.now(_dt.timezone.utc)
    run_id = run_id or f"{job_name}-{uuid.uuid4().hex[:12]}"
    wm = job_watermark(read_audit(spark, audit_root, job_name), job_name)
    fresh_files = None
    if ledger_root:
        if days and as_of is None:
            as_of = _dt.datetime.now(_dt.timezone.utc).date()
        where = window_globs(landing_root, as_of, days) if days else None
        fresh_files = NewFiles(spark, file_inventory(spark, landing_root, paths=where, partitions=DAY_PARTITION), ledger_root, job_name)
        records = fresh_files.read(schema, fmt, landing_root)
    else:
        records = scan_window(spark, landing_root, schema, wm, as_of, days, fmt)
    records = records.select(*schema.fieldNames(), "source_path")
    # no separate distinct: the key dedup of the merge removes exact copies too
    flat = transform(records, shape, run_ts=run_ts or start.replace(tzinfo=None), distinct=False, errors_col=ERRORS)
    read, wrote = Observation("read"), Observation("written")
    rejected = F.coalesce(F.sum(F.size(ERRORS)), F.lit(0)).alias("rows_rejected")
    columns = [c for c in flat.columns if c != ERRORS]

    def identified(rows: DataFrame) -> DataFrame:
        """With the content id, which is hashed where it is written: no compression shortens it."""
        if "ale_id" in rows.columns:
            return rows
        return rows.withColumn("ale_id", content_id(*[n for n, _ in shape.spec])).select(*columns, *[c for c in rows.columns if c not in columns])

    if shape.id_mode == "content" and "ale_id" not in {n.lower() for n, _ in shape.spec}:
        flat = flat.drop("ale_id")
    # outputs are written by partition: one shuffle here instead of one each, gone when they are written;
    # rows that meet stored ones are shuffled again for that
    laid_out = bool(flat_target) or not all_folders(spark, target, shape.part_col)
    if laid_out:
        flat = flat.hint("rebalance", shape.part_col)
    flat = flat.observe(read, F.count(F.lit(1)).alias("rows_read"), rejected)
    with staged(flat, spark, "flat") as kept_rows:
        rows = kept_rows.drop(ERRORS)
        touched = touched_summary(rows, shape.part_col)
        if touched["rows"] >= RELEASE_ROWS:
            release_shuffles(spark)
        if flat_target and touched["partitions"]:
            part = _part_field(rows, shape.part_col)
            # a random id cannot tell rows of one file apart on a replay; the file and day can
            ids = ["file_path", "ale_id"] if shape.id_mode == "content" else ["file_path"]
            wide = identified(rows)
            kept = read_partitions(spark, flat_target, part, touched, [wide.schema[c] for c in ids])
            fresh = wide if kept is None else anti_by_keys(wide, kept, [*ids, shape.part_col])
            write_partitioned(fresh, flat_target, [shape.part_col], mode="append", dynamic=False, rebalance=kept is not None)
        if reject_target:
            # a replayed run writes its own folder again
            rejects = rejected_rows(identified(kept_rows), ["ale_id", "file_path"], ERRORS).withColumn("run_id", F.lit(run_id))
            write_partitioned(rejects, reject_target, ["run_id"], rebalance=False)
        replaced = upsert_partitions(spark, rows, target, keys or shape.keys, shape.part_col, touched=touched, observed=wrote, laid_out=laid_out, late=identified)
    written = wrote.get["rows_written"] if replaced else 0
    counts = read.get | {"rows_written": written, "rows_duplicate": read.get["rows_read"] - written}
    if fresh_files:
        fresh_files.done(run_id)
        fresh_files.forget()
    end = _dt.datetime.now(_dt.timezone.utc)
    append_audit(audit_record(spark, run_id, job_name, start, end, STATUS_COMPLETED, counts), audit_root)
    return {
        "run_id": run_id,
        "watermark": wm,
        "partitions": replaced,
        "flat_rows": touched["rows"],
        **counts,
    }
