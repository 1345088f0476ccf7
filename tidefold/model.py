"""Schemas and fixed values of the data model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import total_ordering

from pyspark.sql import types as T

# Fixed values.
INSERT, UPDATE, DELETE = "insert", "update", "delete"

STATUSES = ("created", "dumping", "dumped", "initialized", "moving", "moved", "syncing")

ROW_EVENT_OPS = {
    "write_rows_v1": INSERT,
    "write_rows_v2": INSERT,
    "update_rows_v1": UPDATE,
    "update_rows_v2": UPDATE,
    "delete_rows_v1": DELETE,
    "delete_rows_v2": DELETE,
}
ROTATE_EVENT = "rotate"

DEFAULT_LOGFILE = "binlog.000000"
DEFAULT_LOGPOS = 0

NIL = "<nil>"

DATE_FORMAT = "yyyy-MM-dd HH:mm:ss||yyyy-MM-dd||epoch_millis"
# End of fixed values.

# Columns that order a change; one event holds many rows at one log position,
# so the row's index inside its event is part of the order.
SEQ = ("logfile", "logpos", "row_idx")
META = (*SEQ, "op")

# Names that change rows and their folds use beside a table's own columns.
RESERVED = (*META, "present", "boundary", "latest", "_file_no", "split")


@total_ordering
@dataclass(frozen=True)
class Position:
    """A log coordinate, known on the driver; ordered as ``positions.position`` is."""

    logfile: str = DEFAULT_LOGFILE
    logpos: int = DEFAULT_LOGPOS

    @property
    def file_no(self) -> int | None:
        """The number after the last dot of the file's name."""
        number = self.logfile.rpartition(".")[2]
        numeric = number.isascii() and number.isdigit() and len(number) <= 18
        return int(number) if numeric else None

    def __lt__(self, other: Position) -> bool:
        return self._order() < other._order()

    def _order(self) -> tuple[int, str, int]:
        return (-1 if self.file_no is None else self.file_no, self.logfile, self.logpos)


@dataclass(frozen=True)
class Column:
    """One column of a source table; ``position`` counts from 0."""

    name: str
    type: str
    position: int
    is_in_primary_key: bool = False


@dataclass(frozen=True)
class Followed:
    """A table that is loaded or followed: its columns, and where its snapshot was taken."""

    table: str
    columns: Sequence[Column]
    position: Position

    @property
    def key(self) -> list[str]:
        return [c.name for c in self.columns if c.is_in_primary_key]

    @property
    def doc(self) -> list[str]:
        return [c.name for c in self.columns if not c.is_in_primary_key]


POSITION_SCHEMA = T.StructType(
    [T.StructField("logfile", T.StringType()), T.StructField("logpos", T.LongType())]
)

COLUMN_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("is_in_primary_key", T.BooleanType()),
    ]
)

# One appended row per registry write; unset fields are null.
REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("columns", T.ArrayType(COLUMN_SCHEMA)),
        T.StructField("binlog_pos", POSITION_SCHEMA),
        T.StructField("dump_read_progress", T.LongType()),
    ]
)

# A raw log event as it arrives: values are positional text.
ROW_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("schema", T.StringType()),
        T.StructField("tbl", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("logfile", T.StringType()),
        T.StructField("logpos", T.LongType()),
        T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)
