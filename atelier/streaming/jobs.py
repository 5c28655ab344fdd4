"""Structured Streaming forms of the keyed merge, the first-seen filter and windowed counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from atelier.streaming import buckets as B


def stream_upsert(stream: DataFrame, target: str, checkpoint: str, *, update_cols: Sequence[str], order: Sequence[Column], key: Column | None = None, buckets: int = B.BUCKETS) -> StreamingQuery:
    """Merges each batch into the bucketed table at target; a batch's number names what it writes, so a repeated batch changes nothing.

    Only the first batch starts from nothing; a later one whose base is missing or can't be read fails, and the stream with it.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        B.merge(batch, batch_id, target, update_cols=update_cols, order=order, key=key, buckets=buckets)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_first_seen(stream: DataFrame, keys: Sequence[str], *, ts: str, within: str) -> DataFrame:
    """The first row of each key; keys are forgotten after the watermark."""
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, key: str, *, ts: str, size: str, late: str) -> DataFrame:
    return stream.withWatermark(ts, late).groupBy(F.window(ts, size), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
