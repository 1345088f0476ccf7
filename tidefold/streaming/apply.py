"""Continuous apply with Structured Streaming.

The stream itself is stateless: every micro-batch is folded on its own and handed
to the sinks.  The keyed state lives in the sink (see ``sinks.state``), where it
may grow to the size of the table without a state store to restore or rebalance.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def run_stream(
    changes: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    interval: str = "1 second",
) -> StreamingQuery:
    """Start applying a change stream; ``checkpoint`` keeps its position.

    With ``available_now`` the call returns when all present input is applied.
    """
    writer = changes.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if not available_now:
        return writer.trigger(processingTime=interval).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
