"""Bounded replay and resumption."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.functions.positions import (
    FIRST_NEWER,
    SECOND_NEWER,
    compare_positions,
    file_number,
    position,
)
from tidefold.model import Position
from tidefold.sources.change_log import bounded


def resume_after(
    changes: DataFrame, progress: DataFrame, stream: str = "tbl", all_saved: bool = False
) -> DataFrame:
    """Changes after each stream's saved position; a stream without one starts
    at the beginning.  ``progress`` holds one row per stream.

    With ``all_saved``, which says that every stream has a position, the log is read
    from the smallest of them on.
    """
    saved = progress.select(stream, position().alias("saved"))
    if all_saved:
        lowest = saved.agg(F.coalesce(F.min("saved")["file_no"], F.lit(-1)).alias("n")).scalar()
        changes = changes.where(F.coalesce(file_number(), F.lit(-1)) >= lowest)
    return (
        changes.join(saved, stream, "left")
        .where(F.col("saved").isNull() | (position() > F.col("saved")))
        .drop("saved")
    )


def catchup_range(
    changes: DataFrame,
    start: Position,
    end: Position,
    tables: list[str] | None = None,
    crossing: bool = False,
) -> DataFrame:
    """Changes in (start, end] of some tables; both bounds reach the scan.

    A replay that stops at the first event not before ``end`` applies that event
    too, which matters when ``end`` lies inside an event: ``crossing`` keeps it.
    """
    replayed = bounded(changes, start, end)
    if crossing:
        # Files from the end's on are looked through for the first event there, and
        # that event's file bounds the replay; both bounds are on the file alone too.
        before_end = Position(end.logfile, end.logpos - 1)
        beyond = bounded(changes, max(start, before_end))
        first = beyond.agg(F.min(position()).alias("p"))
        last = first.select(F.coalesce("p.file_no", F.lit(end.file_no).cast("bigint"))).scalar()
        inside = (position() <= _literal(end)) | (position() == first.select("p").scalar())
        replayed = bounded(changes, start).where(inside)
        if end.file_no is not None:
            replayed = replayed.where(F.coalesce(file_number(), F.lit(-1)) <= last)
    return replayed.where(F.col("tbl").isin(tables)) if tables else replayed


def catchup_many(
    events: DataFrame, ranges: DataFrame, on: Sequence[str] = ("tbl",)
) -> DataFrame:
    """Events of many tables, each in its own range, in one scan of the log.

    ``ranges`` has a row for each of ``on``, with from_logfile, from_logpos (exclusive),
    to_logfile and to_logpos (inclusive); its other columns are added to the events.  The
    smallest and largest position bound the scan; ranges are joined by their real size.
    """
    begin, end = position("from_logfile", "from_logpos"), position("to_logfile", "to_logpos")
    file = F.coalesce(file_number(), F.lit(-1))
    lowest = ranges.agg(F.coalesce(F.min(begin)["file_no"], F.lit(-1)).alias("n")).scalar()
    highest = ranges.agg(F.coalesce(F.max(end)["file_no"], F.lit(-1)).alias("n")).scalar()
    some = events.where((file >= lowest) & (file <= highest))
    joined = some.join(ranges, list(on)).where((position() > begin) & (position() <= end))
    return joined.drop("from_logfile", "from_logpos", "to_logfile", "to_logpos")


def _literal(at: Position):
    return position(F.lit(at.logfile), F.lit(at.logpos).cast("bigint"))


def catchup_plan(registry: DataFrame, main: DataFrame) -> DataFrame:
    """Who must catch up over which range.

    ``registry`` holds each table's snapshot position, ``main`` is one row with
    the position the stream has reached.  A main position still at its default
    is first set to the table's.  When the main stream is ahead, the table is
    replayed up to it; when the snapshot is ahead, the tables already syncing are.
    """
    reached = F.coalesce(main.select(position()).scalar(), _default_position())
    fresh = reached == _default_position()
    planned = registry.select(
        "tbl",
        position().alias("own"),
        F.when(fresh, position()).otherwise(reached).alias("main"),
    )
    order = compare_positions(F.col("main"), F.col("own"))
    behind = F.when(order == FIRST_NEWER, F.col("own")).when(order == SECOND_NEWER, F.col("main"))
    ahead = F.when(order == FIRST_NEWER, F.col("main")).when(order == SECOND_NEWER, F.col("own"))
    who = (
        F.when(order == FIRST_NEWER, "table")
        .when(order == SECOND_NEWER, "syncing_tables")
        .otherwise("none")
    )
    return planned.select(
        "tbl",
        who.alias("who"),
        behind["logfile"].alias("from_logfile"),
        behind["logpos"].alias("from_logpos"),
        ahead["logfile"].alias("to_logfile"),
        ahead["logpos"].alias("to_logpos"),
    )


def _default_position():
    return _literal(Position())
