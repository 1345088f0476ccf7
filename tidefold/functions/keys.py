"""Document ids rendered from primary-key values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.functions.values import printed
from tidefold.model import NIL, Column


def render_pk(df: DataFrame, key: Sequence[str]) -> SparkColumn:
    """Id of the load and apply path: each key value in its printed form, joined
    with nothing in between.  Use it for output only; joins use the key columns."""
    return F.concat(*[printed(df, name) for name in key])


def generate_pk(df: DataFrame, columns: Sequence[Column]) -> SparkColumn:
    """Id of the verifier: key columns by position, floats with six decimals."""
    key = [c.name for c in sorted(columns, key=lambda c: c.position) if c.is_in_primary_key]
    absent = [name for name in key if name not in df.columns]
    if absent:
        raise ValueError(f"the rows lack the key column {absent[0]}")
    return F.concat(*[_fixed_form(df, name) for name in key])


def _fixed_form(df: DataFrame, name: str) -> SparkColumn:
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        text = F.format_string("%.6f", column)
    elif isinstance(kind, T.BinaryType):
        text = column.cast("string")
    else:
        text = column.cast("string")
    return F.when(column.isNull(), NIL).otherwise(text)


#: Rows that one task of ``pk_collisions`` brings together, about.
ROWS_PER_TASK = 1 << 20


def pk_collisions(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rendered ids that more than one key tuple maps to.

    Rows are dealt by id before any are kept, into parts whose number follows the rows: each
    task then holds the tuples of one part, however large a file's splits are.  Tuples and
    ids are told apart where they land.
    """
    parts = -(-df.count() // ROWS_PER_TASK)
    return (
        df.select(render_pk(df, key).alias("_id"), *key)
        .repartition(max(parts, 1), "_id")
        .distinct()
        .groupBy("_id")
        .agg(F.count(F.lit(1)).alias("n_keys"))
        .where("n_keys > 1")
    )
