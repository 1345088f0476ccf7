"""Printed forms of values and the lenient equality built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.model import NIL

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
EXACT = (*INTEGRAL, T.DecimalType)
NUMERIC = (*EXACT, T.FloatType, T.DoubleType)


# Shortest float text: 900, 0.5, 1e+06, 1.5e-05.  Digits come from Spark's own text
# of the number, which is plain from 0.001 to ten million and "mEx" elsewhere; here
# numbers are plain from 0.0001 to one million.  Most only lose a trailing ".0".
_WHOLE = "if(endswith({0}, '.0'), substring_index({0}, '.', 1), {0})"
_TEXT = "cast({0} as string)"
_MANTISSA = f"substring_index({_TEXT}, 'E', 1)"
_SHIFT = f"try_cast(substring_index({_TEXT}, 'E', -1) as int)"
_PRINTED_FLOAT = rf"""case
  when abs({{0}}) >= 0.001D and abs({{0}}) < 1e6D then {_WHOLE.replace("{0}", _TEXT)}
  when {{0}} = 0 then '0'
  when isnan({{0}}) then 'NaN'
  when abs({{0}}) = double('Infinity') then if({{0}} > 0, '+Inf', '-Inf')
  when abs({{0}}) >= 0.0001D and abs({{0}}) < 0.001D
    then regexp_replace({_WHOLE.replace("{0}", _MANTISSA)},
                        r'^(-?)(\d)\.?(\d*)$', '$10.000$2$3')
  when abs({{0}}) >= 1e6D and abs({{0}}) < 1e7D
    then concat(regexp_replace(
                  regexp_replace({_TEXT}, r'^(-?\d)(\d{{{{6}}}})\.?(\d*)$', '$1.$2$3'),
                  r'\.?0+$', ''), 'e+06')
  else concat({_WHOLE.replace("{0}", _MANTISSA)}, if({_SHIFT} < 0, 'e-', 'e+'),
              lpad(abs({_SHIFT}), if(abs({_SHIFT}) < 100, 2, 3), '0'))
end"""


def printed_float(name: str) -> Column:
    """Printed form of a float or double column.

    One parsed expression: building it call by call costs more than running it.
    """
    return F.expr(printed_float_sql(f"`{name}`"))


def printed_float_sql(value: str) -> str:
    """SQL for the printed form of a float or double expression."""
    return _PRINTED_FLOAT.format(value)


def printed_bytes(value: Column) -> Column:
    """Byte strings print as a list of numbers: [65 66]."""
    octets = F.regexp_extract_all(F.hex(value), F.lit("(..)"))
    numbers = F.transform(octets, lambda octet: F.conv(octet, 16, 10))
    return F.concat(F.lit("["), F.array_join(numbers, " "), F.lit("]"))


def printed_bytes_sql(value: str) -> str:
    """SQL for the printed form of a byte string expression."""
    octets = f"regexp_extract_all(hex({value}), '(..)')"
    return f"concat('[', array_join(transform({octets}, o -> conv(o, 16, 10)), ' '), ']')"


def printed(df: DataFrame, name: str) -> Column:
    """Printed form of a column, chosen by its type."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        text = printed_float(name)
    elif isinstance(kind, T.BinaryType):
        text = printed_bytes(column)
    else:
        text = column.cast("string")
    return F.when(column.isNull(), NIL).otherwise(text)


def _as_printed(value: Column) -> Column:
    """A float as the double that prints alike, which widening does not give."""
    return value.cast("string").cast("double")


def numeric_side(df: DataFrame, name: str) -> Column:
    """The value as a double: numbers, and byte strings that parse; text is 0."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.FloatType):
        number = _as_printed(column)
    elif isinstance(kind, NUMERIC):
        number = column.cast("double")
    elif isinstance(kind, T.BinaryType):
        number = column.cast("string").try_cast("double")
    else:
        number = F.lit(0.0)
    return F.coalesce(number, F.lit(0.0))


def lenient_equal(df: DataFrame, left: str, right: str) -> Column:
    """Equal printed forms, or equal non-zero numbers.

    Two numbers, and two values of one other type, print alike exactly when they
    are equal, so text is only made where the types differ.
    """
    kinds = [df.schema[name].dataType for name in (left, right)]
    if all(isinstance(k, EXACT) for k in kinds):
        return F.col(left).eqNullSafe(F.col(right))
    if all(isinstance(k, NUMERIC) for k in kinds):
        same = F.col(left).cast("double").eqNullSafe(F.col(right).cast("double"))
        if kinds[0] != kinds[1] and any(isinstance(k, T.FloatType) for k in kinds):
            same = same | (numeric_side(df, left) == numeric_side(df, right)) & (
                F.col(left).isNotNull() & F.col(right).isNotNull()
            )
        return same
    a, b = numeric_side(df, left), numeric_side(df, right)
    same_number = (a != 0) & (b != 0) & (a == b)
    numbers = all(isinstance(k, (*NUMERIC, T.BinaryType)) for k in kinds)
    if kinds[0] == kinds[1]:
        alike = F.col(left).eqNullSafe(F.col(right))
    elif numbers:
        # Bytes print as a list, so they look like a number only if both are null.
        alike = F.col(left).isNull() & F.col(right).isNull()
    else:
        alike = printed(df, left) == printed(df, right)
    return alike | same_number if numbers else alike
