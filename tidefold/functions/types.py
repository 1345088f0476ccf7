"""Declared source types: target index types and Spark types."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type -> index type, after lower-casing and dropping one
# plain length such as (11).
TARGET_TYPES = {
    "int": "integer",
    "tinyint": "integer",
    "smallint": "integer",
    "mediumint": "integer",
    "bigint": "long",
    "float": "float",
    "double": "double",
    "real": "double",
    "decimal": "double",
    "numeric": "double",
    "char": "keyword",
    "varchar": "keyword",
    "text": "text",
    "mediumtext": "text",
    "longtext": "text",
    "tinytext": "text",
    "date": "date",
    "datetime": "date",
    "timestamp": "date",
    "boolean": "boolean",
    "bool": "boolean",
}
OTHER_TARGET_TYPE = "text"
# End of fixed values.


def target_type(declared: Column) -> Column:
    """Index type of a declared type.  Anything the table above does not hold
    exactly, such as ``decimal(10,2)`` or ``int unsigned``, is text."""
    bare = F.regexp_replace(F.lower(declared), r"\([0-9]+\)", "")
    known = F.create_map(*[F.lit(x) for pair in TARGET_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, bare), F.lit(OTHER_TARGET_TYPE))


_INTEGERS = {"tinyint": 0, "smallint": 1, "mediumint": 2, "int": 2, "integer": 2, "bigint": 3}
_WIDTHS = (T.IntegerType(), T.IntegerType(), T.IntegerType(), T.LongType())
_PLAIN = {
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "real": T.DoubleType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "binary": T.BinaryType(),
    "varbinary": T.BinaryType(),
    "blob": T.BinaryType(),
    "tinyblob": T.BinaryType(),
    "mediumblob": T.BinaryType(),
    "longblob": T.BinaryType(),
}


# Dates a source may hold that no calendar has; they are read as null.
ZERO_DATE = r"^0000-00-00(?: 00:00:00(?:[.]0+)?)?$"
DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def spark_type(declared: str) -> T.DataType:
    """The Spark type that holds a declared type without loss."""
    text = declared.lower()
    base = re.match(r"[a-z]+", text).group(0)
    sizes = [int(n) for n in re.findall(r"\d+", text.partition("(")[2].partition(")")[0])]
    unsigned = "unsigned" in text
    if base in _INTEGERS:
        rank = _INTEGERS[base]
        if unsigned and rank == 3:
            return T.DecimalType(20, 0)
        return T.LongType() if unsigned and base in ("int", "integer") else _WIDTHS[rank]
    if base in ("decimal", "numeric"):
        precision = sizes[0] if sizes else 10
        scale = sizes[1] if len(sizes) > 1 else 0
        # Wider than Spark's widest decimal: keep the digits as text.
        return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    return _PLAIN.get(base, T.StringType())
