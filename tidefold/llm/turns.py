"""The rows of conversations in their order, without a task for each conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import stored

#: Rows that follow each other in one chunk of a conversation, at most.
CHUNK = 4096


def dealt(rows: DataFrame, *more: str) -> DataFrame:
    """``rows`` dealt by ranges and sorted, so that conversations follow each other.

    Rows of a conversation (``conv_id``, null being one of its own) stand by turn, nulls
    first, then by role, text and ``more``.  Ranges are of (conv_id, turn), so a conversation
    of a third of all rows is many tasks, and only rows of one turn must meet.
    """
    return rows.repartitionByRange("conv_id", "turn").sortWithinPartitions(
        "conv_id", "turn", "role", "text", *more
    )


def in_order(rows: DataFrame, purpose: str, *more: str) -> DataFrame:
    """``rows`` as ``dealt``, written once, with ``ord`` rising along each conversation.

    ``chunk`` numbers runs of at most CHUNK rows of consecutive ``ord``.
    """
    table = stored(dealt(rows, *more).withColumn("ord", F.monotonically_increasing_id()), purpose)
    return table.withColumn("chunk", F.floor(F.col("ord") / F.lit(CHUNK)))
