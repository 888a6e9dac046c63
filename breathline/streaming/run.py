"""Starting and stopping streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

Sink = Callable[[DataFrame, int], None]

# Pace of the two jobs.
REALTIME_TRIGGER = "10 minutes"
ARCHIVE_TRIGGER = "30 minutes"


def start(rows: DataFrame, sink: Sink, checkpoint: str, trigger: str | None = None, mode: str = "append") -> StreamingQuery:
    """Runs ``sink`` on every micro-batch. The checkpoint is not optional: without it a restart reads and
    stores everything again. No ``trigger`` means: take what is there, in bounded batches, and end."""
    writer = rows.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def await_stop(query: StreamingQuery) -> None:
    """Waits for the query. An interrupt ends the query but not the session, which others may share."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        query.stop()
