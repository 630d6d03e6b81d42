"""Helpers shared by the operators: row slices of Arrow batches, hashing, tables that cut lineage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import release_shuffles, remove_path, scratch_path

BLANKS = frozenset(b"\t\n\v\f\r ")
SPLIT_ON_BLANKS = bytes(32 if b in BLANKS else b for b in range(256))
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LOWER_SPLIT_ON_BLANKS = LOWER.translate(SPLIT_ON_BLANKS)
SLICE_BYTES = 4 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's code to the Python workers, once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    if root.is_dir():  # else it runs from an archive, which the workers have already
        archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_code.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for source in sorted((root / "tidemark").rglob("*.py")):
                z.write(source, source.relative_to(root))
        context.addPyFile(archive)
    _shipped.add(context.applicationId)


def give_back() -> None:
    """Return memory that this worker has freed to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package's code on the workers, which give memory back when a task's input ends."""
    ship(df.sparkSession)

    def tidy(batches):
        yield from run(batches)
        give_back()

    return df.mapInArrow(tidy, schema)


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame lacks."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def crc_fold(column: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the column as text, modulo ``folds`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def cut(df: DataFrame, name: str, release: bool = False, **options) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint root and read it back.

    Later plans start from the files, so a lost executor repeats one read and
    not the steps before it. ``release`` asks the driver's JVM to collect its
    garbage, which lets Spark's cleaner drop the shuffle files of done steps; the
    second time is for plans that pending listener events held the first time.
    ``options`` go to the Parquet writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    if release:
        release_shuffles(df.sparkSession)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote, once nothing that is still to run reads them."""
    for table in tables:
        remove_path(table.sparkSession, table.cut_path)


def named_rows(docs: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """``docs`` with column ``name``: a number of the row that no other row has, in the order of the ids.

    Where no id repeats, that is the id; else the numbered rows are written, so
    that the numbers stay. Rows without an id have none.
    """
    named = F.col(id_col).cast("long")
    given = docs.filter(named.isNotNull()).groupBy(named.alias("id")).agg(F.count("*").alias("n"))
    if given.filter("n > 1").isEmpty():
        return docs.withColumn(name, named)
    order = [named.asc_nulls_first(), F.xxhash64(text_col)]
    ordered = docs.repartitionByRange(partitions_for(docs.sparkSession), *order).sortWithinPartitions(*order)
    return cut(ordered.withColumn(name, F.when(named.isNotNull(), F.monotonically_increasing_id())), "named")


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of a batch with about ``limit`` bytes of text each, at least one row."""
    column = batch.column(text)
    width = np.frombuffer(column.buffers()[1], dtype=np.int32 if pa.types.is_string(column.type) else np.int64)
    ends = width[column.offset : column.offset + len(column) + 1].astype(np.int64)
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1
        stop = min(max(stop, at + 1), len(column))
        yield batch.slice(at, stop - at)
        at = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (multiply and shift, three rounds)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def spans_to_rows(lengths: np.ndarray) -> np.ndarray:
    """0, 0, 1, 1, 1, ...: the row number of each element of rows of the given lengths."""
    return np.repeat(np.arange(len(lengths)), lengths)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(s, s + n) over all (s, n)."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def words(texts: pa.Array, table: bytes) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Words of each text: (numbers of all words one after another, the distinct words, words of each text).

    ``table`` maps every byte to a byte, separators to a blank; it leaves bytes
    above 127 as they are. A null text has no words.
    """
    codes, vocabulary, counts = arrow_words(texts, table)
    return codes, vocabulary.to_numpy(zero_copy_only=False).tolist(), counts  # to_pylist takes some ten times as long


def arrow_words(texts: pa.Array, table: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """As ``words``, with the distinct words as an Arrow array."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.int32), pa.array([], pa.large_string()), np.zeros(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = (held.slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if held is not None else b"").translate(table)
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(offsets - offsets[0])), pa.py_buffer(data))
    cuts = pc.split_pattern(plain, " ")
    some = pc.not_equal(cuts.values, pa.scalar("", cuts.values.type))
    upto = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    coded = cuts.values.filter(some).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.diff(upto[cuts.offsets.to_numpy()])
