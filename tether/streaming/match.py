"""Matching of a stream of query records, batch by batch, with the batch operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import serve


def match_stream(queries: DataFrame, providers: DataFrame, weights: DataFrame, sink: Callable[[DataFrame, int], None], model=None, checkpoint: str | None = None) -> StreamingQuery:
    """Start a stream that hands the matches of every micro-batch and its number to sink."""
    writer = queries.writeStream.foreachBatch(lambda df, n: sink(serve.match(df, providers, weights, model), n))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
