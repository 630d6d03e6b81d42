"""Token-ID / binary output: directly addressable codes.

An id is cut into chunks, lowest bits first. Level 0 holds the first chunk of
every id and one bit that says whether the id goes on; level 1 holds the next
chunk of the ids that do, and so on. A directory of the number of set bits
before every 512th bit turns "which place has id i on the next level" into one
lookup and one count, so any token is read without decoding others.

Files are Parquet: a row is one segment (some whole documents of one shard, in
ascending id order) with its document directory and its code as a binary value.
Shards are ranges of document ids, so shard, segment and position are the
global order. Writing goes through Spark's commit, so a lost executor costs a
repeated task.

Nulls: a null text has no ids of its own (only the end id); null document ids
come first. Repeated document ids are all written, in the order of their texts.
An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, partitions_for, slices
from tidemark.llm.tokens import encoder, ids_crc32

MAGIC = b"DAC1"
LEVEL_BITS = (8, 8, 16)
RANK_STEP = 512
SEGMENT_IDS = 1 << 18
SCHEMA = "shard int, segment int, start long, n_ids long, doc_ids array<long>, lengths array<long>, code binary"
HEADER = struct.Struct("<4sII")
LEVEL = struct.Struct("<IQ")


def encode(ids: np.ndarray) -> bytes:
    """Directly addressable code of unsigned 32-bit ids."""
    parts, rest = [], np.asarray(ids, np.uint32)
    for level, bits in enumerate(LEVEL_BITS):
        chunk = (rest & np.uint32((1 << bits) - 1)).astype("<u1" if bits == 8 else "<u2")
        rest = rest >> np.uint32(bits)
        goes_on = rest > 0 if level < len(LEVEL_BITS) - 1 else np.zeros(len(rest), bool)
        bitmap = np.packbits(goes_on, bitorder="little")
        ones = np.add.reduceat(goes_on, np.arange(0, len(goes_on), RANK_STEP)) if len(goes_on) else np.zeros(0, int)
        before = np.cumsum(ones) - ones
        parts += [LEVEL.pack(bits, len(chunk)), chunk.tobytes(), bitmap.tobytes(), before.astype("<u4").tobytes()]
        rest = rest[goes_on]
    return HEADER.pack(MAGIC, len(LEVEL_BITS), RANK_STEP) + b"".join(parts)


class Code:
    """One encoded segment: random access by ``at``, everything at once by ``all``."""

    def __init__(self, data: bytes):
        magic, n_levels, self.step = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token code")
        at, self.levels = HEADER.size, []
        for _ in range(n_levels):
            bits, n = LEVEL.unpack_from(data, at)
            at += LEVEL.size
            chunk = np.frombuffer(data, "<u1" if bits == 8 else "<u2", n, at)
            at += chunk.nbytes
            bitmap = np.frombuffer(data, np.uint8, -(-n // 8), at)
            at += bitmap.nbytes
            before = np.frombuffer(data, "<u4", -(-n // self.step), at)
            at += before.nbytes
            self.levels.append((bits, chunk, bitmap, before))

    def __len__(self) -> int:
        return len(self.levels[0][1])

    def at(self, i: int) -> int:
        """Id number ``i``: one chunk a level, places found by the rank directories."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value, shift = 0, 0
        for bits, chunk, bitmap, before in self.levels:
            value |= int(chunk[i]) << shift
            shift += bits
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // self.step
            head = np.unpackbits(bitmap[block * self.step // 8 : i // 8 + 1], bitorder="little")
            i = int(before[block]) + int(head[: i - block * self.step].sum())
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level from the last."""
        above = np.zeros(0, np.uint32)
        for bits, chunk, bitmap, _ in reversed(self.levels):
            value = chunk.astype(np.uint32)
            goes_on = np.unpackbits(bitmap, count=len(chunk), bitorder="little").astype(bool)
            if goes_on.any():
                value[goes_on] |= above << np.uint32(bits)
            above = value
        return above


def _segments(docs: Iterator[tuple[int | None, np.ndarray]]) -> Iterator[pd.DataFrame]:
    """Segments of whole documents with at least SEGMENT_IDS ids each, but for the last."""
    shard, segment, start, held, room = TaskContext.get().partitionId(), 0, 0, [], 0

    def close() -> pd.DataFrame:
        ids = np.concatenate([x for _, x in held])
        return pd.DataFrame(
            {
                "shard": [shard],
                "segment": [segment],
                "start": [start],
                "n_ids": [len(ids)],
                "doc_ids": [[d for d, _ in held]],
                "lengths": [[len(x) for _, x in held]],
                "code": [encode(ids)],
            }
        )

    for doc_id, ids in docs:
        held.append((doc_id, ids))
        room += len(ids)
        if room >= SEGMENT_IDS:
            yield close()
            segment, start, held, room = segment + 1, start + room, [], 0
    if held:
        yield close()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False) -> None:
    """Encode every whole text, append ``end_id`` and write the ids in ascending document order."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange(partitions_for(spark), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text"
    )
    def documents(batches) -> Iterator[tuple[int | None, np.ndarray]]:
        enc, end = encoder(tokenizer, added_tokens), np.array([end_id], np.uint32)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = enc.encode(part.column("text"))
                at = 0
                for doc_id, n in zip(part.column("doc_id").to_pylist(), counts.tolist(), strict=True):
                    yield doc_id, np.concatenate([ids[at : at + n], end])
                    at += n

    def code(batches):
        for frame in _segments(documents(batches)):
            yield pa.RecordBatch.from_pandas(frame, schema=arrow_schema, preserve_index=False)

    arrow_schema = pa.schema(
        [
            ("shard", pa.int32()),
            ("segment", pa.int32()),
            ("start", pa.int64()),
            ("n_ids", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("lengths", pa.list_(pa.int64())),
            ("code", pa.binary()),
        ]
    )
    map_arrow(ordered, code, SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 (and ids), from the files alone."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    # one number a shard: as many rows as files were written
    totals = dict(stored.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect())
    before, base = 0, {}
    for shard, n in totals.items():
        base[shard], before = before, before + n
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def decode(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                at = {k: batch.column(k)[row] for k in ("shard", "start", "doc_ids", "lengths", "code")}
                ids, lengths = Code(at["code"].as_py()).all(), np.array(at["lengths"].as_py(), np.int64)
                ends = np.cumsum(lengths)
                own = [ids[e - n : e] for e, n in zip(ends, lengths, strict=True)]
                out = [
                    pa.array(at["doc_ids"].as_py(), pa.int64()),
                    pa.array(base[at["shard"].as_py()] + at["start"].as_py() + ends - lengths),
                    pa.array(lengths),
                    pa.array([ids_crc32(x) for x in own], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    out.append(pa.array([x.tolist() for x in own], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    return map_arrow(stored, decode, schema)
