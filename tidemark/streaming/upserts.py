"""Micro-batches merged into a published dataset."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.publish import DEFAULT_BUCKETS, ConflictError, compact_if_due, publish_upsert


def stream_upsert(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    buckets: int = DEFAULT_BUCKETS,
    newest_wins: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start merging a stream into a dataset, the newest row per key winning.

    A micro-batch writes its own rows only, as a delta, so its cost does not grow with the
    dataset. Deltas are merged into the dataset apart from the batch, once they are many or
    large; a writer that comes in between only puts that off.

    The dataset remembers the last batch of each query (a query lives as long as
    its checkpoint), so a batch that is run again after a failure changes
    nothing. Without ``processing_time`` the query stops when what is there has
    been read.
    """
    context = stream.sparkSession.sparkContext

    def merge(batch: DataFrame, batch_id: int) -> None:
        # Set by the engine on the thread that runs the batch.
        query = context.getLocalProperty("sql.streaming.queryId")
        publish_upsert(batch, path, keys, order, buckets, newest_wins, batch_id=(query, batch_id), as_delta=True)
        try:
            compact_if_due(batch.sparkSession, path)
        except ConflictError as conflict:
            warnings.warn(f"not compacted: {conflict}", stacklevel=1)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    return writer.trigger(availableNow=True).start()
