"""Streaming key de-duplication with bounded state.

``dropDuplicatesWithinWatermark`` keeps a key in state only until the
watermark passes its event time plus the delay, so state does not grow with
the stream's history. A duplicate arriving later than that is no longer
recognised (and rows older than the watermark are dropped as late); when an
exact, unbounded horizon is required, use the batch merge instead
(``tidemark.plans.etl.upsert_partitions``), which checks against everything
stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.functions.casts import ntz_as_utc_instant


def stream_dedup(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop rows whose key was seen within ``delay`` of event time.

    A wall-clock (``timestamp_ntz``) event time is read as UTC for the
    watermark, through a helper column that is dropped again.
    """
    if isinstance(stream.schema[event_time].dataType, T.TimestampNTZType):
        helper = "_event_instant"
        marked = stream.withColumn(helper, ntz_as_utc_instant(stream[event_time]))
        deduped = marked.withWatermark(helper, delay).dropDuplicatesWithinWatermark(list(keys))
        return deduped.drop(helper)
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def write_stream_files(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Append to a file sink until all available input is processed.

    The file sink's commit log makes the output exactly-once per micro-batch.
    """
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(target).awaitTermination()
