"""Order-dependent operators without a single ordered partition.

A value that the next rows inherit (the current log file, the last status, the
last insert or delete of a key) is carried inside small buckets of a key, across
the buckets of a block, and across blocks.  No task ever holds more than one bucket
of rows, or a run of one-row bucket summaries, whatever share of the rows belongs
to one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefold.functions.positions import position
from tidefold.model import DEFAULT_LOGFILE, DEFAULT_LOGPOS, ROTATE_EVENT


def carry_forward(
    rows: DataFrame,
    *,
    value: Column,
    into: str,
    order: Sequence[str],
    bucket: Column,
    block: Column | None = None,
    keys: Sequence[str] = (),
    inclusive: bool = True,
) -> DataFrame:
    """Add ``into``: the last non-null ``value`` before each row in ``order``.

    ``bucket`` must not decrease along ``order``, and a bucket must fit one task.
    Give ``block``, which groups whole buckets, when the buckets of one key may
    themselves be too many for one task.  ``inclusive`` counts the row itself.
    Key columns must not be null.

    The plan is the same for every size, and building it starts no job.
    """
    keys, columns = list(keys), rows.columns
    group = [*keys, "_block", "_bucket"] if block is not None else [*keys, "_bucket"]
    cut = {"_bucket": bucket} | ({"_block": block} if block is not None else {})
    rows = rows.withColumn("_value", value).withColumns(cut)
    window = Window.partitionBy(*group).orderBy(*order)
    window = window.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)

    # One row per bucket that exists, summed up on the map side first.
    last = F.max(
        F.when(F.col("_value").isNotNull(), F.struct(*order, F.col("_value").alias("value")))
    )
    per_bucket = rows.groupBy(*group).agg(last["value"].alias("_last"))
    carried = _across_buckets(per_bucket, keys, block is not None)

    # The window and the join share one shuffle of the rows.
    inside = rows.withColumn("_inside", F.last("_value", ignorenulls=True).over(window))
    return inside.join(carried, group, "left").select(
        *columns, F.coalesce("_inside", "_carry").alias(into)
    )


def _across_buckets(per_bucket: DataFrame, keys: list[str], blocks: bool) -> DataFrame:
    """The value each bucket inherits from the buckets before it."""

    def before(column: str, order: str, *partition: str) -> Column:
        window = Window.partitionBy(*partition).orderBy(order)
        return F.last(column, ignorenulls=True).over(
            window.rowsBetween(Window.unboundedPreceding, -1)
        )

    if not blocks:
        return per_bucket.withColumn("_carry", before("_last", "_bucket", *keys)).drop("_last")
    last = F.max(
        F.when(F.col("_last").isNotNull(), F.struct("_bucket", F.col("_last").alias("value")))
    )
    per_block = per_bucket.groupBy(*keys, "_block").agg(last["value"].alias("_block_last"))
    # One short row per block: the only window that spans all of a key's blocks.
    into_block = per_block.withColumn(
        "_into_block", before("_block_last", "_block", *keys)
    ).drop("_block_last")
    return (
        per_bucket.withColumn("_in_block", before("_last", "_bucket", *keys, "_block"))
        .join(into_block, [*keys, "_block"], "left")
        .select(*keys, "_block", "_bucket", F.coalesce("_in_block", "_into_block").alias("_carry"))
    )


def rotate_attribution(
    events: DataFrame,
    start_file: str | None = None,
    ord: str = "ord",
    bucket_size: int = 65536,
    buckets_per_block: int = 4096,
) -> DataFrame:
    """Give each event the file named by the latest rotate event before it.

    Events before the first rotate belong to ``start_file``, the file the stream
    was opened at.
    """
    bucket = F.floor(F.col(ord) / F.lit(bucket_size))
    rows = carry_forward(
        events,
        value=F.when(F.col("kind") == ROTATE_EVENT, F.col("next_log")),
        into="logfile",
        order=[ord],
        bucket=bucket,
        block=F.floor(bucket / F.lit(buckets_per_block)),
    )
    return rows.withColumn("logfile", F.coalesce("logfile", F.lit(start_file)))


def high_water_mark(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Latest position seen, over all events, filtered ones included.

    Nothing seen gives the default position (only without ``by``).
    """
    mark = events.groupBy(*by).agg(F.max(position()).alias("mark"))
    return mark.select(
        *by,
        F.coalesce("mark.logfile", F.lit(DEFAULT_LOGFILE)).alias("logfile"),
        F.coalesce("mark.logpos", F.lit(DEFAULT_LOGPOS).cast("bigint")).alias("logpos"),
    )
