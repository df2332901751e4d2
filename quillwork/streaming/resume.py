"""Streams: append with resume, so that a micro-batch that is run again adds nothing twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import append_new


def append_stream(stream: DataFrame, path: str, key: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a stream's rows to a table, each key once: every micro-batch leaves out what the table has."""

    def write(batch: DataFrame, _: int) -> None:
        append_new(batch.dropDuplicates([key]), path, key)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
