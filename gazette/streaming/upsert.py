"""Streaming upsert: every micro-batch is one batch of the article table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gazette.plans import jobs
from gazette.streaming.ingest import aside, decode


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def drain_to_table(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    clock: Callable[[], datetime] = utc_now,
    interval_seconds: int | None = None,
) -> StreamingQuery:
    """Upsert the articles of every micro-batch; drains once, or keeps on at the interval.

    Messages that are no articles are set aside in the same commit. A refused batch
    is logged and set aside and the stream goes on. A stream with a new checkpoint is
    a writer of its own; a batch that is repeated from one checkpoint is found in the
    log. The query is returned running if an interval is given (normally
    constants.INGEST_INTERVAL_SECONDS).
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = f"stream {spark.sparkContext.getLocalProperty('sql.streaming.queryId')}"
        jobs.apply_batch(spark, root, decode(batch), writer, batch_id, clock(), aside(batch))

    writer = messages.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    if interval_seconds:
        return writer.trigger(processingTime=f"{interval_seconds} seconds").start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
