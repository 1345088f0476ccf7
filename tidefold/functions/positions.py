"""Log positions: ordering, comparison and pushable range predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidefold.model import SEQ, Position

FIRST_NEWER, SECOND_NEWER, EQUAL = "first_newer", "second_newer", "equal"


def position(logfile: Column | str = "logfile", logpos: Column | str = "logpos") -> Column:
    """A position struct; struct comparison is log order.

    Files are ordered by number, which stays right when the number gains a digit, and
    by name where the names end in none.
    """
    return F.struct(
        file_number(logfile).alias("file_no"),
        _col(logfile).alias("logfile"),
        _col(logpos).alias("logpos"),
    )


def text_position(
    logfile: Column | str = "logfile", logpos: Column | str = "logpos"
) -> Column:
    """A position struct in text order, where .999999 is after .1000000."""
    return F.struct(_col(logfile).alias("logfile"), _col(logpos).alias("logpos"))


def sequence() -> Column:
    """The total order of change rows."""
    return ordered(*SEQ)


def ordered(*columns: str | Column) -> Column:
    """A struct of columns that begin with the log file's name, in log order."""
    return F.struct(file_number().alias("file_no"), *columns)


def file_number(logfile: Column | str = "logfile") -> Column:
    """The number after the last dot of a log file name; null where there is none.

    The text is looked at before it is cast: a cast that fails costs many times one
    that does not.  More than 18 digits are a name without a number.
    """
    last = F.substring_index(_col(logfile), ".", -1)
    return F.when(last.rlike("^[0-9]{1,18}$"), last.cast("bigint"))


def compare_positions(first: Column, second: Column) -> Column:
    """Three-way comparison of two comparable position structs."""
    return (
        F.when(first < second, SECOND_NEWER).when(first > second, FIRST_NEWER).otherwise(EQUAL)
    )


def after(start: Position) -> Column:
    """Strictly after ``start``.  Spelt with a bound on the file alone, so that it
    prunes the folders of a log kept by file."""
    file, bound = _file_and(start)
    return (file >= bound) & ((file > bound) | (F.col("logpos") > start.logpos))


def until(end: Position) -> Column:
    """Up to and including ``end``."""
    file, bound = _file_and(end)
    return (file <= bound) & ((file < bound) | (F.col("logpos") <= end.logpos))


def _file_and(at: Position) -> tuple[Column, Column]:
    """What to compare log files by, and a position's file as that."""
    if at.file_no is None:
        return F.col("logfile"), F.lit(at.logfile)
    # Names without a number come before all others.
    return F.coalesce(file_number(), F.lit(-1)), F.lit(at.file_no).cast("bigint")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
